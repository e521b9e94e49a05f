"""Equal documents, found through recipes of content-defined chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantry.llm.rows import kept, restored, shielded, stored_at
from merchantry.sources.store import remove, scratch_path

SPACES = r"[\x20\x09-\x0D]+"
# a chunk ends behind a word whose hash is a multiple of this: about 64 words
CUT = 64
# longer chunks are cut on at this many characters
MOST_CHARS = 8192
SALTS = 512


def words_of(text: Column) -> Column:
    """What lies between runs of ASCII white space; joined by one space each it is the normalised text. Null counts as empty."""
    return F.split(F.coalesce(text, F.lit("")), SPACES, -1)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, also inside other functions of arrays."""
    return F.element_at(F.transform(F.array(value), use), 1)


def chunks(words: Column, cut: int = CUT, most: int = MOST_CHARS) -> Column:
    """The words of a text joined in parts that they decide, so that equal passages give equal chunks wherever they stand.

    The parts one behind the other are a space and the text. A part ends behind a word whose hash says so; one that gets
    longer than ``most`` characters is cut on from its own start, so no chunk is longer.
    """
    def ends(words: Column) -> Column:
        return F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: (i == F.size(words)) | (F.pmod(F.xxhash64(F.element_at(words, i)), F.lit(cut)) == 0))

    def joined(words: Column, stops: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.slice(stops, 1, F.size(stops) - 1))
        return F.zip_with(starts, stops, lambda a, b: F.concat(F.lit(" "), F.array_join(F.slice(words, a + 1, b - a), " ")))

    def short(part: Column) -> Column:
        return F.when(F.length(part) <= most, F.array(part)).otherwise(F.regexp_extract_all(part, F.lit(f"(?s).{{1,{most}}}"), F.lit(0)))

    parts = _with(ends(words), lambda stops: joined(words, stops))
    return F.flatten(F.transform(parts, short))


def fingerprint(chunk: Column) -> Column:
    return F.unhex(F.md5(chunk))


def verified(rows: DataFrame) -> DataFrame | None:
    """(print, chunk, number) of chunks that share a fingerprint with a lesser chunk; None if no two do.

    ``rows`` have ``parts`` and their fingerprints ``recipe``. Chunks are compared as texts: every distinct chunk is moved
    once, whatever its frequency, as equal ones meet on the map side first. A chunk's identifier is its
    fingerprint and ``number``, 0 for all that are not listed here.
    """
    pairs = _pairs(rows).select("print", "chunk")
    shared = kept(pairs.distinct().groupBy("print").agg(F.count("*").alias("n")).filter("n > 1"), "chunk-collisions")
    if shared.isEmpty():
        return None
    number = F.row_number().over(Window.partitionBy("print").orderBy("chunk")) - 1
    return kept(pairs.join(shared, "print").distinct().select("print", "chunk", number.alias("number")).filter("number > 0"), "chunk-numbers")


def _pairs(rows: DataFrame) -> DataFrame:
    each = rows.select("place", F.posexplode(F.arrays_zip("recipe", "parts")).alias("at", "c"))
    return each.select("place", "at", F.col("c.recipe").alias("print"), F.col("c.parts").alias("chunk"))


def _told_apart(rows: DataFrame, odd: DataFrame) -> DataFrame:
    """``rows`` with the number behind the fingerprint of every chunk in ``odd``; others don't change."""
    found = _pairs(rows).join(odd, ["print", "chunk"]).groupBy("place").agg(F.map_from_entries(F.collect_list(F.struct("at", "number"))).alias("numbers"))
    joined = rows.join(found, "place", "left").withColumn("numbers", F.coalesce("numbers", F.expr("map()").cast("map<int,int>")))
    longer = F.zip_with("recipe", F.sequence(F.lit(0), F.size("recipe") - 1), lambda p, i: F.concat(
        p, F.coalesce(F.element_at("numbers", i).cast("string").cast("binary"), F.lit(b""))))
    return joined.select("id", "place", "sha", longer.alias("recipe"))


def recipes(df: DataFrame, id_column: str = "doc_id", text: str = "text", hashed: Callable[[Column], Column] = fingerprint) -> DataFrame:
    """(id, place, sha, recipe): every row of ``df``, its text's hash and its ordered list of verified chunk identifiers.

    ``place`` tells rows of equal id and text apart. Texts are equal when and only when their recipes are. Of the texts
    every distinct chunk is moved, once, for its identifier; the lists have 16 bytes a chunk. The chunks
    are written for that, and deleted when their identifiers are known.
    """
    spark = df.sparkSession
    safe, (key, body) = shielded(df, id_column, text)
    parts = safe.select(F.col(key).alias("id"), _with(words_of(F.col(body)), lambda words: F.struct(
        F.sha2(F.array_join(words, " "), 256).alias("sha"), chunks(words).alias("parts"))).alias("t"))
    path = scratch_path(spark, "chunk-texts")
    rows = stored_at(parts.select("id", F.monotonically_increasing_id().alias("place"), "t.sha", "t.parts").withColumn("recipe", F.transform("parts", hashed)), path)
    odd = verified(rows)
    listed = kept(rows.select("id", "place", "sha", "recipe") if odd is None else _told_apart(rows, odd), "chunk-recipes")
    remove(spark, path)
    return listed


def copies(listed: DataFrame) -> DataFrame:
    """(id, place, sha, keep_id, keep_place, group_size): each row of ``recipes`` with the first row of its group.

    Groups are counted in 512 parts, dealt by place, before the parts meet, and looked up in the same parts: no
    task holds all rows of a large group.
    """
    listed = listed.withColumn("salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int"))
    first = F.struct(F.isnull("id").alias("last"), "id", "place")
    per_id = listed.groupBy("recipe", "salt").agg(F.min(first).alias("first"), F.count("*").alias("n"))
    groups = per_id.groupBy("recipe").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"), F.collect_list("salt").alias("salts"))
    looked = groups.select("recipe", "first", "group_size", F.explode("salts").alias("salt"))
    return listed.join(looked, ["recipe", "salt"]).select(
        "id", "place", "sha", F.col("first.id").alias("keep_id"), F.col("first.place").alias("keep_place"), "group_size")


def deduped_documents(df: DataFrame) -> DataFrame:
    """One row per row of ``df``: the id that stays of its group, the group's size, whether it stays, its text's hash.

    Texts are equal when identical after each run of ASCII white space became one space; null counts as empty, so null and
    empty texts are one group (a text of white space only is another). The smallest id stays, null only if all ids
    are; of rows with equal id and text exactly one stays. An empty table gives an empty one; other columns don't matter.
    """
    found = copies(recipes(df))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: see ``deduped_documents``.

    Rows are found again by id and hash of the text, in a shuffle of no text where the list of those that stay is small; only
    rows that are repeated with id and text are reduced to one by a further shuffle.
    """
    found = copies(recipes(df, id_column, text))
    same = F.col("id").eqNullSafe(F.col("keep_id"))
    stay = kept(found.filter(same).groupBy("id", "sha").agg(F.count("*").alias("n")), "copies-kept")
    safe, (key, body) = shielded(df, id_column, text)
    marked = safe.withColumn("own", F.sha2(F.array_join(words_of(F.col(body)), " "), 256))
    rows = marked.join(stay, F.col(key).eqNullSafe(F.col("id")) & (F.col("own") == F.col("sha")))
    single, several = rows.filter("n = 1"), rows.filter("n > 1").dropDuplicates(["id", "sha"])
    return restored(single.unionByName(several), df)


DEDUPED_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM docs WINDOW w AS (PARTITION BY norm ORDER BY doc_id NULLS LAST)
"""
