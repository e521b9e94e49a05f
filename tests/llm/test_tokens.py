import gc
import hashlib
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import AWKWARD
from tokenizers import Tokenizer, models

from merchantry.llm import pieces, token_counts, token_files
from merchantry.llm.rows import table
from merchantry.llm.tokens import Cache, escaped, release, space_words

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
byte_library = Tokenizer.from_file(BYTES)
vocabulary = token_counts.vocabulary(PIECES)
unigram = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))

TEXTS = st.text(alphabet=st.one_of(st.sampled_from(list(" \n\tabcdefghinorst'.,!19é▁日本🤗\x1c\x85　")), st.characters(codec="utf-8")), max_size=60)
ODD = ["", " ", "  a  b ", "a▁b", "<s> </s> <unk> <0x41>", "<|endoftext|> x", "aaaaaaaaaaaa", "\x00﻿​", "x  \n y \r\n", "don't won't 'll"]


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_as_the_library(text):
    ids = library.encode(text)
    assert pieces.encode(text, PIECES) == ids
    assert [i for w in space_words(text) for i in pieces.encoder(PIECES).encode(w)] == ids
    assert pieces.decode(ids, PIECES) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_counts_as_the_library(text):
    want = len(unigram.encode(escaped(text), add_special_tokens=False).ids)
    assert token_counts.count_tokens(text, PIECES) == want
    assert sum(map(token_counts.counter(PIECES).count, space_words(text))) == want


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_bytes_as_the_library(text):
    want = byte_library.encode(text, add_special_tokens=False).ids
    assert token_files.encoded([text], BYTES)[0].tolist() == want
    assert token_files.encoded([text], BYTES, RANKS)[0].tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=33, max_codepoint=0x24F), min_size=1, max_size=12), max_size=20))
def test_latin_words_by_ranks(words):
    test_bytes_as_the_library.hypothesis.inner_test(" ".join(words))
    test_bytes_as_the_library.hypothesis.inner_test(" ".join(f"{w}\n{w}" for w in words))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" \n'streadlvm.9²ªßé")), st.characters(min_codepoint=32, max_codepoint=0x24F)), max_size=80))
def test_latin_texts_by_ranks(text):
    test_bytes_as_the_library.hypothesis.inner_test(text)


@pytest.mark.parametrize("text", [" " * 300_000, "x" * 300_000, "\n" * 300_000, "a " * 200_000, ("ab" * 100 + " \n") * 2000, " " * 16 + "x" * 257])
def test_long_runs_by_ranks(text):
    """Gaps and words without end don't reach the ranks' pattern, whose stack they would exceed."""
    test_bytes_as_the_library.hypothesis.inner_test(text)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    test_pieces_as_the_library.hypothesis.inner_test(text)
    test_counts_as_the_library.hypothesis.inner_test(text)
    test_bytes_as_the_library.hypothesis.inner_test(text)


def test_ties_in_counts():
    """Equal scores: the way whose last piece is longest."""
    words = [("<unk>", 0.0), ("a", -2.0), ("aa", -4.0), ("aaa", -6.0), ("b", -1.0), ("ab", -3.0)]
    own, other = token_counts.Counter(words), Tokenizer(models.Unigram(words, unk_id=0, byte_fallback=False))
    for text in ("aaaa", "aab", "abab", "baaab"):
        assert own.count(text) == len(other.encode(text).ids)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded_rows(rows):
    out = []
    for i, t in rows:
        ids = library.encode(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    return sorted(out, key=repr)


def test_round_trips(spark, sf_dir, awkward, nothing):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in pieces.tokenized_documents(docs).collect()), key=repr) == encoded_rows(rows)
    assert sorted((tuple(r) for r in pieces.tokenized_documents(awkward).collect()), key=repr) == encoded_rows([r[:2] for r in AWKWARD])
    assert pieces.tokenized_documents(nothing).count() == 0
    ids = pieces.round_trips(awkward, PIECES, ids=True).filter("doc_id = 7").first().ids
    assert ids == library.encode("word")


def test_token_counts(spark, sf_dir, awkward, nothing):
    docs = table(spark, sf_dir, "documents")
    want = sorted((r.doc_id, len(unigram.encode(escaped(r.text or "")).ids)) for r in docs.collect())
    assert sorted(tuple(r) for r in token_counts.counted_documents(docs).collect()) == want
    got = sorted((tuple(r) for r in token_counts.counted_documents(awkward).collect()), key=repr)
    assert got == sorted(((i, len(unigram.encode(escaped(t or "")).ids)) for i, t, _ in AWKWARD), key=repr)
    assert token_counts.counted_documents(nothing).count() == 0


def stored(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = byte_library.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, sf_dir, awkward, nothing, monkeypatch):
    docs = table(spark, sf_dir, "documents")
    assert [tuple(r) for r in token_files.stored_documents(docs).orderBy("start").collect()] == stored([(r.doc_id, r.text) for r in docs.collect()])
    got = [tuple(r) for r in token_files.stored_documents(awkward).orderBy("start").collect()]
    assert got == stored([r[:2] for r in AWKWARD])
    assert token_files.stored_documents(nothing).count() == 0


def test_blocks():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 1000):
        for high in (1, 2, 50_000, 1 << 32):
            ids = rnd.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            ids[::50] = 0xFFFFFFFF
            reader = token_files.Reader(token_files.pack(np.array([n]), ids))
            assert (reader.ids() == ids).all() and reader.lengths.tolist() == [n]
            assert (reader.ids(n // 3, n // 2) == ids[n // 3 : n // 2]).all()
    with pytest.raises(ValueError):
        token_files.Reader(b"something else, long enough")


def test_small_ids_take_little_room():
    ids = np.arange(100_000, dtype=np.uint32) % 200
    assert len(token_files.pack(np.array([len(ids)]), ids)) < 1.2 * len(ids)


def test_large_blocks_in_slices():
    ids = np.random.default_rng(3).integers(0, 50_000, 3 * token_files.SLICE + 77, dtype=np.uint64).astype(np.uint32)
    reader = token_files.Reader(token_files.pack(np.array([len(ids)]), ids))
    assert (reader.ids() == ids).all() and (reader.ids(5, token_files.SLICE + 99) == ids[5 : token_files.SLICE + 99]).all()


def test_cache_is_bounded():
    """In bytes, whatever the pieces and results are; long pieces are not kept at all."""
    cache = Cache(lambda words: [(len(w), w + "!") for w in words], 100_000)
    for k in range(5000):
        assert cache.of([[f"{k}", "ab", "long" * 20]]) == [[(len(str(k)), f"{k}!"), (2, "ab!"), (80, "long" * 20 + "!")]]
        assert cache.bytes <= 102_000 and "long" * 20 not in cache.now
    assert len(cache.now) + len(cache.before) < 1000
    cache.forget()
    assert not cache.now and not cache.before


def test_texts_without_spaces():
    """20,000 characters without a space are one piece: nothing of it stays."""
    for k in range(20):
        text = "".join(chr(0x4E00 + (k * 7919 + j * j) % 20_000) for j in range(20_000))
        pieces.word_cache(PIECES).of([space_words(text)])
        token_counts.count_cache(PIECES).of([space_words(text)])
    assert all(len(w) <= 64 for w in [*pieces.word_cache(PIECES).now, *token_counts.count_cache(PIECES).now])


def test_release_frees_cyclic_garbage():
    """An idle worker holds no cycles of its last task, also if no collection ran meanwhile."""
    class Node:
        pass

    node = Node()
    node.own, seen = node, weakref.ref(node)
    gc.disable()
    try:
        del node
        assert seen() is not None
        release()
        assert seen() is None
    finally:
        gc.enable()
