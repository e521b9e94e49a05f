"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its labels."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.llm.mixing import draw
from merchantry.llm.rows import add_from_text, kept, pick
from merchantry.llm.tokens import Cache, release

# labelled rows that the models are fitted on, about; further ones are left out by a hash of their id
SAMPLE_ROWS = 20_000
# rows of label 1 that a lexicon entry taken from the labelled rows needs
SUPPORT = 5
# initials of words count as entries as well: inflected and compound forms share them
PREFIXES = (4, 5, 6, 7)
ROUNDS = 25
# rounds after which the voters' correlations are estimated again
SHARES_EVERY = 4

# fixed values: insults by language
LEXICON = {
    "en": ["idiot", "moron", "stupid", "dumb", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown",
           "imbecile", "bastard", "filthy", "vermin", "retard", "jerk", "creep", "garbage", "hate"],
    "de": ["idiot", "dumm", "trottel", "abschaum", "wertlos", "ekelhaft", "arschloch", "schwein", "versager", "depp"],
    "fr": ["idiot", "imbécile", "stupide", "crétin", "ordure", "salaud", "débile", "minable", "nul", "connard"],
    "es": ["idiota", "imbécil", "estúpido", "basura", "escoria", "asqueroso", "inútil", "tonto", "payaso", "patético"],
}
# fixed values: signs that stand for letters
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "@": "a", "!": "i"})

_LETTERS = re.compile(r"[^\W\d_]+")
_PERSON = re.compile(r"\b(?:you|your|du|ihr|tu|vous|eres|usted)\b")
_ADDRESS = re.compile(_PERSON.pattern + r"(?:\W+\w+){0,3}\W*$")
# a word with what stands before it since the white space
_TOKEN = re.compile(r"\S+")
_SHOUT = re.compile(r"\b[A-Z]{3,}\b")


def _known() -> list[str]:
    return sorted({w for words in LEXICON.values() for w in words})


def keys_of(token: str) -> set[str]:
    """What a token (lower case, between white space) offers to the lexicons: words, their initials, unmasked spellings."""
    words = _LETTERS.findall(token)
    out = {f"w:{w}" for w in words}
    out |= {f"p:{w[:n]}" for w in words for n in PREFIXES if len(w) > n}
    if not token.isalpha():
        plain = "".join(_LETTERS.findall(token.translate(STAND_INS)))
        out |= {f"m:{plain}"} if plain and plain not in words else set()
    return out


def _addressed(lower: str, hits: set[str]) -> bool:
    """Whether any occurrence of a hit, as a whole word between white space, follows an address."""
    if not hits or not _PERSON.search(lower):
        return False
    return any(m[0] in hits and _ADDRESS.search(lower[max(0, m.start() - 60) : m.start()]) for m in _TOKEN.finditer(lower))


@dataclass
class Voters:
    """Lexicon voters (an entry each) and patterns over the whole text; ``votes`` gives those that fire."""

    entries: list[str]
    patterns: tuple[str, ...] = ("address", "shouting", "exclaiming", "repeating", "several")
    _cache: Cache | None = field(default=None, repr=False)

    def __len__(self) -> int:
        return len(self.entries) + len(self.patterns)

    def __getstate__(self) -> dict:
        return {"entries": self.entries, "patterns": self.patterns, "_cache": None}

    def votes(self, texts: list[str]) -> list[list[int]]:
        if self._cache is None:
            place = {e: i for i, e in enumerate(self.entries)}
            self._cache = Cache(lambda tokens: (tuple(place[k] for k in keys_of(t) if k in place) for t in tokens))
        out, first = [], len(self.entries)
        tokens = [t.lower().split() for t in texts]
        for text, words, found in zip(texts, tokens, self._cache.of(tokens)):
            hits = [(word, ids) for word, ids in zip(words, found) if ids]
            fired = {i for _, ids in hits for i in ids}
            distinct = {word for word, _ in hits}
            lower = text.lower() if hits else ""
            rules = (
                _addressed(lower, distinct),
                len(_SHOUT.findall(text)) * 4 > len(words) > 0,
                "!!!" in text,
                len(hits) > len(distinct),
                len(distinct) > 1,
            )
            out.append(sorted(fired | {first + k for k, on in enumerate(rules) if on}))
        return out


class Votes:
    """Who fires on which row: the voters' numbers row after row. Its room and its work grow with the votes, not with rows times voters."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, width: int):
        self.ids, self.starts, self.width = ids.astype(np.int64), starts.astype(np.int64), width
        self.counts = np.diff(self.starts)
        self.rows = np.repeat(np.arange(len(self.counts)), self.counts)

    @classmethod
    def of(cls, fired: Iterable[Iterable[int]], width: int) -> Votes:
        rows = [np.asarray(ids, np.int64) for ids in fired]
        return cls(np.concatenate([*rows, np.empty(0, np.int64)]), np.cumsum([0, *map(len, rows)]), width)

    def __len__(self) -> int:
        return len(self.counts)

    def per_row(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, x[self.ids], len(self))

    def per_voter(self, weight: np.ndarray) -> np.ndarray:
        return np.bincount(self.ids, weight[self.rows], self.width)

    def together(self, voters: np.ndarray, weight: np.ndarray, at_once: int = 1 << 20) -> np.ndarray:
        """The weight of the rows on which each of ``voters`` fires together with each of all."""
        place = np.full(self.width, -1)
        place[voters] = np.arange(len(voters))
        found = np.flatnonzero(place[self.ids] >= 0)
        out = np.zeros(len(voters) * self.width)
        ends = np.cumsum(self.counts[self.rows[found]])
        for some in np.split(found, np.searchsorted(ends, np.arange(at_once, ends[-1] if len(ends) else 0, at_once))):
            counts = self.counts[self.rows[some]]
            skip = self.starts[self.rows[some]] - (np.cumsum(counts) - counts)
            partners = np.repeat(skip, counts) + np.arange(counts.sum())
            key = np.repeat(place[self.ids[some]] * self.width, counts) + self.ids[partners]
            out += np.bincount(key, np.repeat(weight[self.rows[some]], counts), len(out))
        return out.reshape(len(voters), self.width)


def _rates(votes: Votes, weight: np.ndarray) -> np.ndarray:
    return (votes.per_voter(weight) + 0.1) / (weight.sum() + 1.0)


def _shares(votes: Votes, p: np.ndarray, cells: int = 1 << 21) -> np.ndarray:
    """Each voter's part of its evidence: one by one plus its positive correlations, within the labels, with voters that fire with it."""
    labels = []
    for weight in (p, 1 - p):
        part, rate = weight / max(weight.sum(), 1e-9), _rates(votes, weight)
        own = votes.per_voter(part)
        labels.append((part, rate, own, np.sqrt(np.maximum(own - 2 * rate * own + rate * rate, 1e-9))))
    shared = np.zeros(votes.width)
    size = max(1, cells // max(votes.width, 1))
    for k in range(0, votes.width, size):
        block = np.arange(k, min(k + size, votes.width))
        spread, met = np.zeros((len(block), votes.width)), np.zeros((len(block), votes.width), bool)
        for part, rate, own, scale in labels:
            both = votes.together(block, part)
            met |= both > 0
            covariance = both - rate[block, None] * own - own[block, None] * rate + rate[block, None] * rate
            spread += covariance / (scale[block, None] * scale) / 2
        spread[~met] = 0
        spread[np.arange(len(block)), block] = 0
        shared[block] = np.maximum(spread, 0).sum(axis=1)
    return 1 / (1 + shared)


def label_model(votes: Votes, gold: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The probability of label 1 per row, from voters of unknown accuracy and the given label as one more voter.

    Each voter fires with one probability under label 1 and another under label 0; expectation maximization
    estimates both. Voters that fire together more than the labels explain (initials and the words that have
    them) share their weight, see ``_shares``; what voters share with the given label is their accuracy.
    """
    gold = gold.astype(np.float64)
    p = np.clip(gold, 0.05, 0.95)
    share = np.ones(votes.width)
    for k in range(rounds):
        if k % SHARES_EVERY == 0:
            share = _shares(votes, p)
        prior = np.clip(p.mean(), 1e-3, 1 - 1e-3)
        one, zero = (np.clip(_rates(votes, w), 1e-5, 1 - 1e-5) for w in (p, 1 - p))
        given_one, given_zero = (np.clip((w @ gold + 0.1) / (w.sum() + 1.0), 1e-5, 1 - 1e-5) for w in (p, 1 - p))
        fired, silent = share * np.log(one / zero), share * np.log((1 - one) / (1 - zero))
        odds = votes.per_row(fired - silent) + silent.sum() + np.log(prior / (1 - prior))
        odds += np.where(gold > 0, np.log(given_one / given_zero), np.log((1 - given_one) / (1 - given_zero)))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p


def linear_fit(votes: Votes, p: np.ndarray, penalty: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Weights, the constant last, of a logistic regression on labels that are probabilities.

    Newton's method; each step is solved by conjugate gradients, which need products with the votes only.
    """
    ridge = np.append(np.full(votes.width, penalty), 1e-3)
    w = np.zeros(votes.width + 1)
    turned = lambda y: np.append(votes.per_voter(y), y.sum())
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(votes.per_row(w[:-1]) + w[-1], -30, 30)))
        curve = q * (1 - q) + 1e-6
        step, rest = np.zeros_like(w), turned(q - p) + ridge * w
        scale = turned(curve) + ridge
        way = ahead = rest / scale
        size, goal = rest @ ahead, 1e-12 * max(rest @ ahead, 1e-12)
        for _ in range(500):
            if size <= goal:
                break
            bent = turned(curve * (votes.per_row(way[:-1]) + way[-1])) + ridge * way
            far = size / (way @ bent)
            step, rest = step + far * way, rest - far * bent
            ahead = rest / scale
            size, before = rest @ ahead, size
            way = ahead + size / before * way
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray

    def scores(self, texts: list[str]) -> list[float]:
        odds = [self.weights[-1] + self.weights[ids].sum() for ids in self.voters.votes(texts)]
        return (1 / (1 + np.exp(-np.clip(np.array(odds), -30, 30)))).tolist()


def fold(key: Column) -> Column:
    """0 to 4 by the id; labels of fold 0 are held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5, F.lit(1))


def _entry_counts(cache: Cache, batch: pa.RecordBatch) -> pa.RecordBatch:
    """(entry, n, ones): the rows of a batch that offer an entry, and those of label 1 among them."""
    n: Counter = Counter()
    toxic: Counter = Counter()
    tokens = [t.lower().split() for t in batch.column("text").to_pylist()]
    for label, found in zip(batch.column("toxic").to_pylist(), cache.of(tokens)):
        keys = {k for ks in found for k in ks}
        n.update(keys)
        toxic.update(keys if label else ())
    keys = list(n)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), pa.array([n[k] for k in keys], pa.int64()), pa.array([toxic[k] for k in keys], pa.int64())],
        ["entry", "n", "ones"])


def _mined(sample: DataFrame, ones: int, rows: int) -> list[str]:
    """Entries that point to label 1: a lower confidence limit of their share of it far above the base rate."""
    base = ones / rows

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        cache = Cache(lambda tokens: (tuple(keys_of(t)) for t in tokens))
        try:
            yield from map(partial(_entry_counts, cache), batches)
        finally:
            release()

    totals = sample.mapInArrow(counts, "entry string, n long, ones long").groupBy("entry").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    # Wilson's limit at z = 2
    share, z = F.col("ones") / F.col("n"), 2.0
    limit = (share + z * z / 2 / F.col("n") - z * F.sqrt((share * (1 - share) + z * z / 4 / F.col("n")) / F.col("n"))) / (1 + z * z / F.col("n"))
    good = totals.filter(F.col("ones") >= SUPPORT).withColumn("limit", limit).filter(F.col("limit") > min(0.9, max(0.4, 3 * base)))
    return [r.entry for r in good.orderBy((F.col("limit") * F.col("ones")).desc(), "entry").select("entry").collect()]


def fit(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled rows outside the held-out fold, about ``sample_rows`` of them at most.

    Rows of null id, text or label are left out; of several labels of an id the largest holds. Without labelled rows, or with
    one label only, the written lexicon alone decides. Only the mined entries and the
    votes of the sample come to the driver.
    """
    known = pick(labels, id_column, label).toDF("doc_id", "toxic").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(fold(F.col("doc_id")) != 0)
    n = known.count()
    if n > sample_rows:
        known = known.filter(draw(F.col("doc_id"), "toxicity") < sample_rows / n)
    sample = kept(pick(df, id_column, text).toDF("doc_id", "text").dropna().join(known, "doc_id"), "toxicity-sample")
    rows, ones = sample.agg(F.count("*"), F.coalesce(F.sum((F.col("toxic") != 0).cast("long")), F.lit(0))).first()
    written = [f"{kind}:{w}" for w in _known() for kind in "wm"]
    if not 0 < ones < rows:
        voters = Voters(written)
        return Model(voters, np.array([4.0] * len(written) + [0.0] * len(voters.patterns) + [-2.0]))
    voters = Voters(list(dict.fromkeys(written + _mined(sample, ones, rows))))
    fired = add_from_text(sample, "text", "fired array<int>", lambda texts: {
        "fired": pa.array(voters.votes(texts), pa.list_(pa.int32()))})
    got = fired.select("toxic", "fired").toArrow()
    lists = got.column("fired").combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    votes = Votes(lists.flatten().to_numpy(), np.cumsum([0, *lists.value_lengths().to_pylist()]), len(voters))
    posterior = label_model(votes, got.column("toxic").to_numpy() != 0)
    return Model(voters, linear_fit(votes, posterior))


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 of every whole text; null and empty texts get that of no vote at all."""
    return add_from_text(df, text, f"{name} double", lambda texts: {name: pa.array(model.scores(texts), pa.float64())})


def accepted(df: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose score is below one half, with their columns as they were."""
    scored = score(df, fit(df, labels, text=text), text)
    safe = scored.toDF(*[f"in{i}" for i in range(len(df.columns))], "score").filter("score < 0.5").drop("score")
    return safe.toDF(*df.columns)


def scored_documents(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's fold, score and prediction."""
    found = score(pick(df, "doc_id", "text"), fit(df, labels))
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
