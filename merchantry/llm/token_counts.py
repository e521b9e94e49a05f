"""Token counts under a unigram vocabulary without building the tokens."""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from merchantry.llm.rows import per_text
from merchantry.llm.tokens import Cache, escaped, space_words

# no public unigram vocabulary is at hand: the pieces of this file and their scores are read as one
MODEL = "piece_bpe_32k.model"
# what a character outside the vocabulary scores below the worst piece
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores by id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Best score and piece count of every prefix; nothing else is kept.

    An automaton enumerates the pieces that end at a position, the longest first. A later piece replaces
    an earlier one only with a strictly better score, so that of equal ways the one whose last piece is longest
    wins, as in the tokenizer. A character that is no piece costs the worst score less a penalty and
    counts as its bytes.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def count(self, text: str) -> int:
        ending: list[list[tuple[int, float]]] = [[] for _ in text]
        for end, match in self.automaton.iter(text):
            ending[end].append(match)
        best, pieces = [0.0], [0]
        for end, matches in enumerate(ending):
            top, n = None, 0
            for size, score in matches:
                total = best[end + 1 - size] + score
                if top is None or total > top:
                    top, n = total, pieces[end + 1 - size] + 1
            if not matches or matches[-1][0] != 1:
                total = best[end] + self.unknown
                if top is None or total > top:
                    top, n = total, pieces[end] + len(text[end].encode())
            best.append(top)
            pieces.append(n)
        return pieces[-1]


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


@lru_cache(maxsize=2)
def count_cache(path: str) -> Cache:
    own = counter(path)
    return Cache(lambda words: map(own.count, words))


def count_tokens(text: str | None, path: str) -> int:
    return counter(path).count(escaped(text or ""))


def token_counts(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id and ``n_tokens`` of the whole text (null and empty: 0); equal rows stay rows.

    No piece reaches across a space, so counts of words add up; a bounded cache keeps those of frequent ones.
    """
    def run(texts: list[str]) -> dict[str, list]:
        counts = count_cache(path).of([space_words(t) for t in texts])
        return {"n_tokens": pa.array([sum(c) for c in counts], pa.int64())}

    return per_text(df, id_column, text, "n_tokens long", run)


def counted_documents(df: DataFrame) -> DataFrame:
    return token_counts(df, public_tokenizers.path(MODEL))
