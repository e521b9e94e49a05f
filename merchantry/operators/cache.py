"""Keyed snapshot: JSON values by ``entity:id`` with expiry. Every read takes ``as_of``, never the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Seconds to live.
TTL_SECONDS = {"user": 3600, "product": 86400, "order": 1800}
OTHER_TTL = 3600

SCHEMA = """key STRING, entity STRING, id BIGINT, value STRING, written_at TIMESTAMP_NTZ, expires_at TIMESTAMP_NTZ"""


def moment(ts: str | Column) -> Column:
    return F.lit(ts).cast("timestamp_ntz") if isinstance(ts, str) else ts.cast("timestamp_ntz")


def record_id(df: DataFrame) -> Column:
    """The record's ``id`` or else ``_id``; 0, null and empty do not count."""
    found = [F.nullif(F.col(c).cast("bigint"), F.lit(0).cast("bigint")) for c in ("id", "_id") if c in df.columns]
    return F.coalesce(*found, F.lit(None).cast("bigint"))


def entries(df: DataFrame, entity: str, written_at: str | Column, position: str | None = None) -> DataFrame:
    """Cache rows for the records of one entity; records without an id are skipped, the last of a key wins."""
    ttl = TTL_SECONDS.get(entity, OTHER_TTL)
    fields = [c for c in df.columns if c != position]
    at = moment(written_at)
    rows = df.select(
        record_id(df).alias("id"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
        at.alias("written_at"), *([F.col(position).alias("_pos")] if position else []),
    ).filter(F.col("id").isNotNull())
    if position:
        rows = rows.groupBy("id").agg(F.max_by(F.struct("value", "written_at"), "_pos").alias("_last")).select("id", "_last.*")
    return rows.select(
        F.concat(F.lit(f"{entity}:"), F.col("id").cast("string")).alias("key"), F.lit(entity).alias("entity"), "id",
        "value", "written_at",
        (F.col("written_at") + F.make_dt_interval(secs=F.lit(ttl))).cast("timestamp_ntz").alias("expires_at"),
    )


def put(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache after writing ``new``, later than all of it: new entries replace those of their keys. Keys of ``new`` are unique.

    Only the keys of the old entries are compared; their values stay where they are if the new ones are few.
    """
    return cache.join(new.select("key"), "key", "left_anti").select(*cache.columns).unionByName(new)


def put_report(df: DataFrame, entity: str) -> DataFrame:
    """How many records came in and how many had an id to be cached under."""
    return df.agg(F.count("*").alias("total"), F.count(record_id(df)).alias("cached")).select(
        F.lit(entity).alias("entity"), "total", "cached"
    )


def live(cache: DataFrame, as_of: str | Column) -> DataFrame:
    return cache.filter(F.col("expires_at") > moment(as_of))


def get(cache: DataFrame, key: str, as_of: str | Column) -> DataFrame:
    """The live entry of one key, or no row."""
    return live(cache, as_of).filter(F.col("key") == key)


def get_many(cache: DataFrame, keys: DataFrame, as_of: str | Column) -> DataFrame:
    """The live entries of the given keys."""
    return live(cache, as_of).join(keys.select("key").distinct(), "key", "left_semi")


def parsed(found: DataFrame, schema: T.StructType) -> DataFrame:
    """The records behind the entries."""
    return found.select(F.from_json("value", schema).alias("r")).select("r.*")


def delete(cache: DataFrame, keys: DataFrame) -> DataFrame:
    return cache.join(keys.select("key"), "key", "left_anti").select(*cache.columns)


def existed(cache: DataFrame, keys: DataFrame, as_of: str | Column) -> DataFrame:
    """Per key whether a delete removes something."""
    there = live(cache, as_of).select("key", F.lit(True).alias("_there"))
    return keys.select("key").distinct().join(there, "key", "left").select("key", F.coalesce("_there", F.lit(False)).alias("existed"))


def remaining_ttl(cache: DataFrame, as_of: str | Column) -> DataFrame:
    """Seconds left for every live entry."""
    left = F.timestamp_diff("SECOND", moment(as_of), F.col("expires_at"))
    return live(cache, as_of).select("key", left.cast("bigint").alias("ttl_seconds"))


def key_counts(cache: DataFrame, as_of: str | Column) -> DataFrame:
    return live(cache, as_of).groupBy("entity").agg(F.count("*").alias("keys"))


def load(tables: dict[str, DataFrame | None], written_at: str | Column) -> DataFrame:
    """A cache of several entities; an entity without a table is skipped."""
    parts = [entries(df, entity, written_at) for entity, df in tables.items() if df is not None]
    if not parts:
        raise ValueError("no table to load")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
