"""Passages of three and more lines that repeat, within a document or across documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.llm.rows import kept, restored, shielded

WINDOW = 3
SALTS = 512


def _line_hashes(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda line: F.md5(line))


def _windows(hashes: Column) -> Column:
    """128-bit hashes of every ``WINDOW`` consecutive lines."""
    return F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
        lambda i: F.unhex(F.md5(F.array_join(F.slice(hashes, i, WINDOW), ""))),
    )


def _blank() -> Column:
    """The hash of a window of nothing but empty lines, which is no passage."""
    return F.unhex(F.md5(F.concat(*[F.md5(F.lit(""))] * WINDOW)))


def covered_lines(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, print, lines): per document the positions, from 0, of lines inside later occurrences of a window.

    The first occurrence of a window is the one with the smallest (id, text hash, position), nulls first. Each window is
    counted in 512 parts, by document, before the parts meet, and looked up in the same parts: no task
    holds all occurrences of a frequent window.
    """
    safe, (key, body) = shielded(df, id_column, text)
    lines = safe.select(F.col(key).alias("id"), F.xxhash64(body).alias("print"), _line_hashes(F.col(body)).alias("hashes"))
    found = lines.filter(F.size("hashes") >= WINDOW).select(
        "id", "print", F.posexplode(_windows(F.col("hashes"))).alias("at", "window")
    ).filter(F.col("window") != _blank())
    place = F.struct("id", "print", "at")
    found = kept(found.withColumn("salt", F.pmod(F.xxhash64("id", "print", "at"), F.lit(SALTS)).cast("int")), "line-windows")
    parts = found.groupBy("window", "salt").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    repeated = (
        parts.groupBy("window").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
        .filter("n > 1").select("window", "first", F.explode("salts").alias("salt"))
    )
    later = found.join(repeated, ["window", "salt"]).filter(~place.eqNullSafe(F.col("first")))
    spans = F.transform(F.collect_list("at"), lambda at: F.sequence(at, at + (WINDOW - 1)))
    return later.groupBy("id", "print").agg(F.array_distinct(F.flatten(spans)).alias("lines"))


def drop_repeated_lines(df: DataFrame, id_column: str = "doc_id", text: str = "text",
                        counts: bool = False) -> DataFrame:
    """``df`` with the lines of repeated passages removed from ``text``, their first occurrence apart.

    A passage is ``WINDOW`` consecutive equal lines, of which one is not empty; longer passages are overlapping windows
    whose covered positions merge. Every removed line keeps an equal one at an earlier place. All rows
    stay: a text may become empty; null texts and texts of fewer than three lines are as they were. Rows
    with equal id and text are one document and fare alike. ``counts`` adds ``n_lines`` and ``n_removed``
    (0 for null texts).
    """
    safe, (key, body) = shielded(df, id_column, text)
    covered = kept(covered_lines(df, id_column, text), "line-covered")
    # texts and lines meet in a shuffle of the texts, at any size
    rows = safe.join(covered.hint("merge"), F.col(key).eqNullSafe(F.col("id")) & (F.xxhash64(body) == F.col("print")), "left")
    whole = F.split(F.col(body), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(whole) - 1), F.col("lines"))
    slim = F.array_join(F.transform(left, lambda i: F.element_at(whole, i + 1)), "\n")
    rows = rows.withColumn("n_removed", F.coalesce(F.size("lines"), F.lit(0)).cast("bigint"))
    rows = rows.withColumn("n_removed", F.greatest("n_removed", F.lit(0)))
    rows = rows.withColumn("n_lines", F.when(F.isnull(body), 0).otherwise(F.size(whole)).cast("bigint") - F.col("n_removed"))
    rows = rows.withColumn(body, F.when(F.isnull("lines"), F.col(body)).otherwise(slim))
    return restored(rows, df, *(["n_lines", "n_removed"] if counts else []))


def deduped_lines(df: DataFrame) -> DataFrame:
    """One row per document: its text without repeated passages, the lines left and the lines removed."""
    rows = drop_repeated_lines(df, counts=True)
    names = [f"x{i}" for i in range(len(df.columns))]
    at = df.columns.index
    return rows.toDF(*names, "n_lines", "n_removed").select(
        F.col(names[at("doc_id")]).alias("doc_id"), F.col(names[at("text")]).alias("text"), "n_lines", "n_removed"
    )


DEDUPED_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL
), windows AS (
  SELECT doc_id, pos, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c FROM lines
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos FROM windows WHERE c IS NOT NULL AND a || b || c <> ''
  QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) > 1
), covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) AS v(k)
), marked AS (
  SELECT lines.*, covered.pos IS NOT NULL AS gone FROM lines LEFT JOIN covered USING (doc_id, pos)
), texts AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
    count(*) FILTER (NOT gone) AS n_lines, count(*) FILTER (gone) AS n_removed
  FROM marked GROUP BY doc_id
)
SELECT doc_id, texts.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN texts USING (doc_id)
"""
