"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.functions.numbering import id_by_order
from merchantry.llm.rows import WORD, kept, restored, shielded

WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix"


def draw(key: Column, seed: str = SEED) -> Column:
    """A number from 0 up to 1, fixed by the seed and the key: the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, size) with ``source_size`` and ``target`` per source.

    Sources in code point order, null last, take the weights in turn and share the whole size. A target
    stops at ``most`` times its source's size; what is over is shared again by weight. So each target is
    min(most * size, level * weight); the level rises until no further source stops, one small
    aggregate per step. The work and the tables are per source, never per document.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = id_by_order(kept(totals.withColumn("last", F.isnull("source")), "mix-totals"), ["last", "source"], "at", 0)
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights)).cast("int") + 1)
    shares = kept(numbered.select("source", "source_size", turn.alias("weight")), "mix-shares")
    limit, level = F.col("source_size") * F.lit(float(most)), None
    while True:
        full = F.lit(False) if level is None else limit <= F.lit(level) * F.col("weight")
        total, stopped, weight = shares.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).cast("double"),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        raised = (total - stopped) / weight if weight else level
        if raised is None or raised == level:
            break
        level = raised
    share = F.lit(0.0 if level is None else level) * F.col("weight")
    return shares.select("source", "source_size", F.least(limit, share).alias("target"))


def planned(df: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
            weights: tuple[int, ...] = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """All rows of ``df`` with ``size``, ``source_size``, ``target`` and ``copies``, the times the mix takes the row.

    The repetition rate of a source is target / source_size: a row is taken floor(rate) times and once more
    if its draw (seed and id) is below the fraction. Reruns and other partitionings agree. A null source is
    a source; null and empty texts have size 0 and the copies of their source; a source of size 0 has target
    0 and no copies; rows with equal ids share one draw; an empty table gives an empty one.
    """
    safe, (key, body, origin) = shielded(df, id_column, text, source)
    sized = safe.withColumn("size", word_count(F.col(body)))
    # written out, so that its size is known: broadcast if small enough, shuffled otherwise
    rates = kept(targets(sized.select(F.col(origin).alias("source"), "size"), weights, most), "mix-rates")
    rate = F.least(F.lit(float(most)), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rows = sized.join(rates, F.col(origin).eqNullSafe(F.col("source")))
    extra = (draw(F.col(key), seed) < rate - F.floor(rate)).cast("int")
    rows = rows.withColumn("copies", (F.floor(rate) + extra).cast("int"))
    return restored(rows, df, "size", "source_size", "target", "copies")


def mix(df: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``df`` as often as ``planned`` says, with the columns of ``df``."""
    rows = planned(df, **options)
    safe = rows.toDF(*[f"in{i}" for i in range(len(df.columns))], "size", "source_size", "target", "copies")
    taken = safe.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return restored(taken, df)


def mixed_documents(df: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, the words the mix takes of it."""
    names = [f"x{i}" for i in range(len(df.columns))]
    rows = planned(df).toDF(*names, "size", "source_size", "target", "copies")
    return rows.select(F.col(names[df.columns.index("doc_id")]).alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))


MIXED_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS turn
  FROM docs GROUP BY source
), weighed AS (
  SELECT *, CAST(turn % 3 + 1 AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS most FROM totals
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, turn) AS place, sum(source_size) OVER () AS total,
    sum(most) OVER (ORDER BY most / weight, turn ROWS UNBOUNDED PRECEDING) - most AS stopped,
    sum(weight) OVER (ORDER BY most / weight DESC, turn DESC ROWS UNBOUNDED PRECEDING) AS open
  FROM weighed
), level AS (
  SELECT coalesce(arg_min((total - stopped) / open, place) FILTER ((total - stopped) / open * weight < most),
    max(most / weight)) AS level FROM ranked
), rates AS (
  SELECT source, source_size, least(most, level * weight) AS target,
    CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, least(most, level * weight) / source_size) ELSE 0 END AS rate
  FROM weighed, level
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
    / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source
"""
