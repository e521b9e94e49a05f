import hashlib
import re

from llm_rows import AWKWARD
from pyspark.sql import functions as F

from merchantry.llm import exact_dedup


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(plain(t), []).append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


ROWS = [
    *AWKWARD, (20, " a b", "s"), (21, "\ta  b", "s"), (22, "a b", "s"), (23, "a b ", "s"), (24, "a\x0bb\r\n", "s"), (25, "a b", "s"), (26, " ", "s"),
    (27, "x" * 30_000, "s"), (28, "x" * 30_000, "s"), (29, "x" * 30_001, "s"), (30, "x" * 8191 + " " + "x" * 100, "s"), (31, "x" * 8191 + "x" * 100, "s"),
    (32, "日本語" * 9_000, "s"), (33, "日本語" * 9_000, "s"), (34, "a b", "s"), (None, "a b", "s"), (None, "a", "s"), (None, "a", "s"), (35, "", "s"),
]


def test_awkward_rows(documents, awkward, nothing):
    assert found(exact_dedup.deduped_documents(awkward)) == expected(AWKWARD)
    assert found(exact_dedup.deduped_documents(documents(ROWS))) == expected(ROWS)
    assert exact_dedup.deduped_documents(nothing).count() == exact_dedup.drop_copies(nothing).count() == 0


def test_rows_that_stay(documents):
    df = documents(ROWS)
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    left = sorted(((r[0], plain(r[1])) for r in out.collect()), key=repr)
    want = {}
    for i, t, _ in ROWS:
        want.setdefault(plain(t), []).append(i)
    assert left == sorted(((min(ids, key=lambda i: (i is None, i)), t) for t, ids in want.items()), key=repr)


def test_large_group(spark):
    """Every third row is one text; every other text is short or shares long passages."""
    passage = " ".join(f"w{k}" for k in range(400))
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, passage).otherwise(
        F.concat(F.lit(passage + " "), (F.col("id") % 1000).cast("string"))).alias("text"))
    rows = [(r.doc_id, r.text, None) for r in df.collect()]
    assert found(exact_dedup.deduped_documents(df)) == expected(rows)


def test_colliding_fingerprints(documents):
    """A fingerprint of four values: only the verified numbers tell chunks apart."""
    rows = [(k, " ".join(f"word{j % (k // 2 + 3)}" for j in range(300)), "s") for k in range(60)]
    weak = exact_dedup.recipes(documents(rows), hashed=lambda c: F.concat(F.lit(b"p"), F.pmod(F.xxhash64(c), F.lit(4)).cast("string").cast("binary")))
    out = exact_dedup.copies(weak).select(F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"), F.col("sha").alias("text_sha256"))
    assert found(out) == expected(rows)


def test_chunks(spark):
    """Chunks are the text, none is long, and a passage has the same chunks wherever it stands."""
    passage = " ".join(f"w{k * k % 977}" for k in range(3000))
    rows = [("a", passage), ("b", "something else first " + passage + " and last"), ("c", "y" * 50_000 + " " + passage)]
    parts = {r[0]: r[1] for r in spark.createDataFrame(rows, "k string, t string").select("k", exact_dedup.chunks(exact_dedup.words_of(F.col("t")))).collect()}
    assert all("".join(parts[k]) == " " + t for k, t in rows) and max(len(p) for ps in parts.values() for p in ps) <= exact_dedup.MOST_CHARS
    inner = set(parts["a"][1:-1])
    assert len(inner) > 10 and inner <= set(parts["b"]) and inner <= set(parts["c"])
