"""Encoding with a merge-type piece vocabulary through a table over prefixes, and decoding."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from merchantry.llm.rows import per_text
from merchantry.llm.tokens import SPACE, Cache, escaped, space_words

MODEL = "piece_bpe_32k.model"
UNKNOWN = -1
NEVER = 1 << 60
# pair tests kept per task
PAIRS = 500_000


class Pieces:
    """The pieces of a model file: ids, merge order and byte pieces. The library only reads the file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.text = [model.id_to_piece(i) for i in ids]
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.special = special
        self.byte = {i: int(self.text[i][3:5], 16) for i in ids if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte.items()}
        self.not_text = special | set(self.byte)
        self.digits = [str(i) for i in ids]
        self.ids = {self.text[i]: i for i in ids if i not in special and i not in self.byte}
        # a smaller rank merges earlier
        by_score = sorted(self.ids.values(), key=lambda i: -model.get_score(i))
        self.rank = {i: r for r, i in enumerate(by_score)}


class PrefixEncoder:
    """Encodes as the merges would, without merging.

    Every prefix of a text has exactly one last token: of the tokens that end there it is the one that may
    stand behind the last token of the prefix before it. Two tokens may stand side by side if no merge
    reaches across their border at the time it would be made. Going back through the last tokens gives
    the ids. An automaton enumerates the tokens that end at a position, the longest first.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.split: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in pieces.ids.items():
            if self._reached(i):
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def _reached(self, token: int) -> bool:
        """Whether merging the token's characters gives the token; ``split`` keeps its last merge."""
        parts, ids, rank = list(self.pieces.text[token]), self.pieces.ids, self.pieces.rank
        last = None
        while len(parts) > 1:
            joined = [(rank[ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ids]
            if not joined:
                return False
            _, k = min(joined)
            last = (parts[k], parts[k + 1])
            parts[k : k + 2] = ["".join(last)]
        self.split[token] = None if last is None else tuple(ids.get(p, UNKNOWN) for p in last)
        return last is None or UNKNOWN not in self.split[token]

    def beside(self, left: int, right: int) -> bool:
        """Whether the tokens stay apart: takes back their merges, latest first, and looks for an earlier merge across."""
        text, ids, rank = self.pieces.text, self.pieces.ids, self.pieces.rank
        before = NEVER  # a merge across has to be made before this rank
        while True:
            across = ids.get(text[left] + text[right])
            if across is not None and rank[across] < before:
                return False
            a, b = self.split[left], self.split[right]
            if a is None and b is None:
                return True
            if b is None or a is not None and rank[left] > rank[right]:
                # of equal merges the left one is made first: a merge across must be earlier
                before, left = rank[left], a[1]
            else:
                # a merge across lies left of the right token's own, and wins at equal rank
                before, right = rank[right] + 1, b[0]

    def encode(self, text: str) -> list[int]:
        """The ids of an escaped text; characters outside the vocabulary become their bytes."""
        # per place: the last token of the prefix that ends there, and its length
        last, sizes = [UNKNOWN] * len(text), [1] * len(text)
        pairs, beside, many = self.pairs, self.beside, len(self.pieces.text)
        if len(pairs) > PAIRS:
            pairs.clear()
        for end, (token, size) in self.automaton.iter(text):
            if last[end] >= 0:
                continue
            if size <= end and (previous := last[end - size]) >= 0:
                fits = pairs.get(pair := previous * many + token)
                if fits is None:
                    fits = pairs[pair] = beside(previous, token)
                if not fits:
                    continue
            last[end], sizes[end] = token, size
        out: list[int] = []
        end = len(text) - 1
        while end >= 0:
            token = last[end]
            if token < 0:
                out += [self.pieces.byte_id[b] for b in reversed(text[end].encode())]
            else:
                out.append(token)
            end -= sizes[end]
        out.reverse()
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, still escaped: bytes in a row are UTF-8, control pieces are nothing."""
        if self.pieces.not_text.isdisjoint(ids):
            return "".join([self.pieces.text[i] for i in ids])
        out = b"".join(
            bytes([self.pieces.byte[i]]) if i in self.pieces.byte else b"" if i in self.pieces.special
            else self.pieces.text[i].encode() for i in ids
        )
        return out.decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(Pieces(path))


@lru_cache(maxsize=2)
def word_cache(path: str) -> Cache:
    """Per word: its ids, the ids as text, the text decoded from the ids."""
    own = encoder(path)

    def fill(words: list[str]):
        digits = own.pieces.digits
        for word in words:
            ids = own.encode(word)
            plain = own.decode(ids)
            yield len(ids), ",".join([digits[i] for i in ids]), word if plain == word else plain

    return Cache(fill)


def encode(text: str | None, path: str) -> list[int]:
    """All ids of a text, without begin or end ids."""
    return encoder(path).encode(escaped(text or ""))


def decode(ids: list[int], path: str) -> str:
    """The text of the ids: spaces restored, the one put in front taken away."""
    return encoder(path).decode(ids).replace(SPACE, " ")[1:]


def round_trips(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """Per row: id, ``n_tokens``, hashes of the ids and of the text decoded from them; with ``ids`` the ids as well.

    A null or empty text has no tokens and decodes to the empty text. Rows with equal ids or texts stay
    rows. Each task holds one batch of texts and a bounded cache of encoded words; ``path`` is the vocabulary file.
    """
    def run(texts: list[str]) -> dict[str, list]:
        words = word_cache(path).of([space_words(t) for t in texts])
        # a text's counts, ids and decoded words; none for an empty text
        columns = [tuple(zip(*ws)) or ((), (), ()) for ws in words]
        joined = [",".join(c[1]) for c in columns]
        plain = ["".join(c[2]).replace(SPACE, " ")[1:] for c in columns]
        out = {
            "n_tokens": pa.array([sum(c[0]) for c in columns], pa.int64()),
            "ids_sha256": [hashlib.sha256(j.encode()).hexdigest() for j in joined],
            "decoded_sha256": [hashlib.sha256(p.encode()).hexdigest() for p in plain],
        }
        if ids:
            out["ids"] = pa.array([[int(i) for i in j.split(",") if i] for j in joined], pa.list_(pa.int32()))
        return out

    more = ", ids array<int>" if ids else ""
    return per_text(df, id_column, text, "n_tokens long, ids_sha256 string, decoded_sha256 string" + more, run)


def tokenized_documents(df: DataFrame) -> DataFrame:
    """Every document's token count and the hashes of its ids and of the decoded text."""
    return round_trips(df, public_tokenizers.path(MODEL))
