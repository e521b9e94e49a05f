"""Near-duplicate texts by an LSH forest over MinHash signatures, confirmed on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.llm.groups import components, forest, in_groups
from merchantry.llm.rows import add_from_text, kept, pick, restored, shielded
from merchantry.llm.tokens import Cache

WORDS = 5
# percent of shared shingles, of all shingles of two texts, that makes a link
PERCENT = 75
# sorted orders of the signature; each starts DEPTH values further along, and a level of the tree is DEPTH values
TREES, DEPTH = 32, 4
SLOTS = TREES * DEPTH
# a region of more rows than this goes one level deeper; at the last level it is dealt by a hash
REGION = 512
LEVELS = 3
# candidates whose signatures agree less are no links: four standard deviations below the limit
LEAST_ALIKE = 0.58

_MIX = np.uint64(0x9E3779B97F4A7C15)
_drawn = np.random.default_rng(2)
_FACTORS = _drawn.integers(1, 1 << 32, SLOTS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_OFFSETS = _drawn.integers(0, 1 << 32, SLOTS, dtype=np.uint64).astype(np.uint32)


def _word_hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


@lru_cache(maxsize=1)
def _word_cache() -> Cache:
    return Cache(lambda words: map(_word_hash, words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Per text its sorted set of shingles as 64-bit hashes: five words in a row, or all words if there are fewer.

    Words are runs without ASCII white space, with A to Z in lower case.
    """
    out = []
    for ids in _word_cache().of([t.encode().lower().split() for t in texts]):
        w = np.array(ids, np.uint64)
        size = min(WORDS, len(w))
        h = np.full(max(0, len(w) - size + 1) if size else 0, size, np.uint64)
        for k in range(size):
            h = _mixed(h * _MIX + w[k : k + len(h)])
        out.append(np.unique(h))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the hash functions."""
    h, least = (shingles >> np.uint64(32)).astype(np.uint32), np.full(SLOTS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(h), 2048):
        np.minimum(least, (h[k : k + 2048, None] * _FACTORS + _OFFSETS).min(axis=0), out=least)
    return least


def _signed(texts: list[str]) -> dict[str, pa.Array]:
    sets = shingle_sets(texts)
    h1, h2, keys, sketch = [], [], [], []
    for s in sets:
        if not len(s):
            h1.append(None), h2.append(None), keys.append(None), sketch.append(None)
            continue
        print_ = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
        h1.append(int(print_[0])), h2.append(int(print_[1]))
        sig = signature(s)
        key = np.zeros(TREES, np.uint64)
        for k in range(DEPTH):
            key = _mixed(key * _MIX + sig[k::DEPTH])
        keys.append(key.astype(np.int64))
        sketch.append((_mixed(sig.astype(np.uint64) * _MIX) >> np.uint64(56)).astype(np.uint8).tobytes())
    return {"n_shingles": pa.array([len(s) for s in sets], pa.int64()), "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()),
            "keys": pa.array(keys, pa.list_(pa.int64())), "sketch": pa.array(sketch, pa.binary())}


def _alike(sketches: np.ndarray, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated similarities of signatures by their 8-bit values, without the chance agreement of these."""
    out = np.zeros((len(rows), len(others)), np.float32)
    for k, r in enumerate(rows):
        out[k] = (sketches[others] == sketches[r]).sum(axis=1, dtype=np.int32)
    return (out / SLOTS - 1 / 256) / (1 - 1 / 256)


def _sketches(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, SLOTS)


PAIR = "a long, b long"


def _pairs(a: np.ndarray, b: np.ndarray) -> list[pa.RecordBatch]:
    if not len(a):
        return []
    return [pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])]


def _regions(classes: DataFrame) -> DataFrame:
    """(tree, key, rep, next keys, n): texts that share the first level of a tree with another, and how many do."""
    turn = [F.concat(F.slice("keys", k + 1, TREES - k), F.slice("keys", 1, k)) if k else F.col("keys") for k in range(LEVELS)]
    rows = classes.select("rep", F.posexplode(F.arrays_zip(*[t.alias(f"k{i}") for i, t in enumerate(turn)])).alias("tree", "level"))
    rows = rows.select("tree", "rep", *[F.col(f"level.k{i}").alias(f"k{i}") for i in range(LEVELS)])
    sizes = rows.groupBy("tree", "k0").agg(F.count("*").alias("n"), F.min("rep").alias("lead")).filter("n > 1")
    return kept(rows.join(sizes, ["tree", "k0"]), "dedup-regions")


def _block(*parts: Column | str) -> Column:
    return F.xxhash64(*parts).alias("block")


def _blocks(regions: DataFrame) -> DataFrame:
    """(block, rep): regions as deep in their tree as it takes to hold at most ``REGION`` rows.

    Deeper blocks of a region all get its smallest id as well, so that they meet. What is alike down to the last level is
    dealt by a hash.
    """
    done = regions.filter(F.col("n") <= REGION).select(_block("tree", "k0"), "rep")
    deep = regions.filter(F.col("n") > REGION)
    found = None
    by = ["tree", "k0"]
    for level in range(1, LEVELS):
        by = [*by, f"k{level}"]
        sizes = deep.groupBy(*by).agg(F.count("*").alias("m"))
        sized = deep.join(sizes, by)
        fits = sized.filter(F.col("m") <= REGION).select(_block(*by), "rep", "lead")
        found = fits if found is None else found.union(fits)
        deep = sized.filter(F.col("m") > REGION).drop("m") if level < LEVELS - 1 else sized.filter(F.col("m") > REGION)
    salt = F.pmod(F.xxhash64("rep"), F.ceil(F.col("m") / REGION))
    found = kept(found.union(deep.select(_block(*by, salt), "rep", "lead")), "dedup-blocks")
    leads = found.select("block", F.col("lead").alias("rep")).distinct()
    return done.union(found.select("block", "rep").union(leads).distinct())


def _first_pairs(blocks: DataFrame, sketches: DataFrame) -> DataFrame:
    """Per block the fewest candidates that join what may be linked: neighbours with the longest agreement first."""
    def run(group: pa.Table) -> list[pa.RecordBatch]:
        reps, s = group.column("rep").to_numpy(), _sketches(group)
        n = len(reps)
        if n < 2:
            return []
        alike = _alike(s, np.arange(n), np.arange(n))
        a, b = np.triu_indices(n, 1)
        good = alike[a, b] >= LEAST_ALIKE
        a, b = a[good], b[good]
        order = np.argsort(-alike[a, b], kind="stable")
        a, b = a[order], b[order]
        chosen = forest(a, b, n)
        return _pairs(reps[a[chosen]], reps[b[chosen]])

    return in_groups(blocks.join(sketches, "rep"), ["block"], PAIR, run).filter("a <> b").distinct()


def _other_links(regions: DataFrame, sketches: DataFrame, comps: DataFrame, texts: DataFrame) -> DataFrame:
    """The links between rows of one region of the first level that are in different components so far.

    In a region only rows outside its largest component are compared with the others. Both sides are dealt into blocks of about
    ``REGION`` rows, and a task compares two blocks on whole shingle sets where the signatures are alike: what leaves it are links,
    one per row and component, not pairs.
    """
    rows = regions.select("tree", "k0", "rep").join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    rows = rows.withColumn("component", F.coalesce("component", "rep"))
    per = rows.groupBy("tree", "k0", "component").agg(F.count("*").alias("m"))
    main = per.groupBy("tree", "k0").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.sum("m").alias("n"),
                                         F.max("m").alias("most")).filter("n > most")
    rows = rows.join(main, ["tree", "k0"]).withColumn("odd", F.col("component") != F.col("main"))
    parts, odd_parts = (F.ceil(c / REGION).cast("int") for c in (F.col("n"), F.col("n") - F.col("most")))
    at = F.xxhash64("rep")
    sides = F.array(F.struct(F.lit(False).alias("guest"), F.pmod(at, parts).cast("int").alias("own"), odd_parts.alias("others")),
                    F.struct(F.lit(True).alias("guest"), F.pmod(at, odd_parts).cast("int").alias("own"), parts.alias("others")))
    dealt = rows.withColumn("side", F.explode(F.when(F.col("odd"), sides).otherwise(F.slice(sides, 1, 1))))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("side.others") - 1)))
    pair = [F.when(F.col("side.guest"), a).otherwise(b) for a, b in ((F.col("side.own"), F.col("other")), (F.col("other"), F.col("side.own")))]
    dealt = kept(dealt.select(_block("tree", "k0", *pair), "rep", "component", F.col("side.guest").alias("guest")), "dedup-others")
    needed = dealt.select(F.col("rep").alias("doc_id")).distinct()
    own = texts.join(needed.hint("merge"), "doc_id", "left_semi")
    sets = kept(add_from_text(own, "text", "shingles binary", lambda ts: {
        "shingles": pa.array([x.tobytes() for x in shingle_sets(ts)], pa.binary())}).select(F.col("doc_id").alias("rep"), "shingles"), "dedup-sets")

    def run(group: pa.Table) -> Iterator[pa.RecordBatch]:
        reps, comp = group.column("rep").to_numpy(), group.column("component").to_numpy()
        guest = group.column("guest").to_numpy().astype(bool)
        s, here, guests = _sketches(group), np.flatnonzero(~guest), np.flatnonzero(guest)
        if not len(here) or not len(guests):
            return
        members = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        good = (_alike(s, guests, here) >= LEAST_ALIKE) & (comp[guests][:, None] != comp[here][None])
        a, b = [], []
        for k, g in enumerate(guests):
            near = here[good[k]]
            if not len(near):
                continue
            own, others = members[g], [members[x] for x in near]
            sizes = np.array([len(x) for x in others])
            every = np.concatenate(others)
            place = np.minimum(np.searchsorted(own, every), len(own) - 1)
            common = np.add.reduceat((own[place] == every).astype(np.int64), np.cumsum(sizes) - sizes)
            near = near[100 * common >= PERCENT * (len(own) + sizes - common)]
            _, first = np.unique(comp[near], return_index=True)
            a += [reps[g]] * len(first)
            b += reps[near[first]].tolist()
        yield from _pairs(np.array(a, np.int64), np.array(b, np.int64))

    return in_groups(dealt.join(sketches, "rep").join(sets, "rep"), ["block"], PAIR, run).filter("a <> b")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets share enough."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _confirmed(pairs: DataFrame, texts: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs whose whole texts are linked."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    sized = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b").filter(small * 100 >= large * PERCENT)
    needed = kept(sized.select("a", "b").distinct(), "dedup-pairs")
    ids = needed.select(F.col("a").alias("doc_id")).union(needed.select(F.col("b").alias("doc_id"))).distinct()
    own = kept(texts.join(ids.hint("merge"), "doc_id", "left_semi"), "dedup-texts")
    both = needed.join(own.toDF("a", "ta"), "a").join(own.toDF("b", "tb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                sets = [shingle_sets(part.column(c).to_pylist()) for c in (2, 3)]
                good = pa.array([linked(x, y) for x, y in zip(*sets)], pa.bool_())
                yield part.select([0, 1]).filter(good)

    return both.select("a", "b", "ta", "tb").mapInArrow(run, PAIR)


def near_texts(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``df``.

    Two texts are linked if they share at least 75 of 100 of their shingles; ``component_id`` is the smallest id reachable
    by links, and ``kept`` whether it is the row's own. Null and empty texts, those without words, and rows without an id
    link with nothing. Equal shingle sets are one point of the search. Rows of one id are one document, linked by any of its
    texts. An empty table gives an empty one.

    Candidates are texts next to each other in 32 orders of the signature, from four equal values on; a
    pair at the limit is in a common region of one order or more but for 5 in a million. Crowded regions are taken deeper. A first
    round confirms the fewest candidates that could join a region; a second one all the others whose
    components still differ.
    """
    rows = pick(df, id_column, text).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = add_from_text(rows, "text", "n_shingles long, h1 long, h2 long, keys array<long>, sketch binary", _signed)
    signed = kept(signed.drop("text"), "dedup-signatures")
    alone = signed.filter("h1 is not null and doc_id is not null")
    classes = kept(alone.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"),
                                                 F.first("sketch").alias("sketch")), "dedup-classes")
    sketches, sizes = classes.select("rep", "sketch"), classes.select("rep", "n")
    regions = _regions(classes)
    texts = rows.dropna()
    first = kept(_first_pairs(_blocks(regions), sketches), "dedup-candidates")
    # ids with several texts join the classes of all of them
    several = alone.select(F.col("doc_id").alias("a"), "h1", "h2").join(classes.select("h1", "h2", F.col("rep").alias("b")), ["h1", "h2"])
    twice = alone.groupBy("doc_id").agg(F.count("*").alias("m")).filter("m > 1").select(F.col("doc_id").alias("a"))
    links = kept(_confirmed(first, texts, sizes).union(several.join(twice, "a", "left_semi").select("a", "b")), "dedup-links")
    comps = kept(components(links), "dedup-components")
    more = kept(_other_links(regions, sketches, comps, texts), "dedup-links")
    comps = kept(components(links.union(more)), "dedup-components")
    by_class = classes.select("h1", "h2", "rep").join(comps.withColumnRenamed("id", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component"))
    out = signed.select("doc_id", "n_shingles", "h1", "h2").join(by_class, ["h1", "h2"], "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", found.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one document of each component, that of the smallest id; columns as they were."""
    gone = kept(near_texts(df, id_column, text).filter("not kept").select(F.col("doc_id").alias("gone")).distinct(), "dedup-gone")
    safe, (key,) = shielded(df, id_column)
    return restored(safe.join(gone.hint("merge"), F.col(key) == F.col("gone"), "left_anti"), df)


def deduped_documents(df: DataFrame) -> DataFrame:
    return near_texts(df)
