"""Writers and table-loading operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry import schemas
from merchantry.functions.numbering import id_by_key
from merchantry.sources.files import CSV_OPTIONS
from merchantry.sources.store import at_once, remove

PARQUET_CODECS = ["snappy", "gzip", "lz4", "zstd", "none"]
# large JSON lines: names of fields are in every line, which the fastest level takes out already. Readers open .json.gz as .json
PACKED_JSON = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _written(df: DataFrame, path: str, mode: str, write) -> bool:
    """Write in one run of the input; without rows the empty files are removed again (not what was appended to), and False returned."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    if seen.get["rows"]:
        return True
    if mode != "append":
        remove(df.sparkSession, path)
    return False


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """CSV with a header row. No rows leave no files, and give False."""
    return _written(df, path, mode, lambda rows: rows.write.mode(mode).options(**CSV_OPTIONS).csv(path))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> bool:
    """One JSON record per line, null fields included. No rows leave no files, and give False."""
    return _written(df, path, mode, lambda rows: rows.write.mode(mode).options(ignoreNullFields=False, **options).json(path))


def write_parquet(df: DataFrame, path: str, codec: str | None = "snappy", mode: str = "overwrite") -> bool:
    """Parquet with the given codec. No rows leave no files, and give False."""
    codec = codec or "none"
    if codec not in PARQUET_CODECS:
        raise ValueError(f"codec {codec!r} is not available; use one of {', '.join(PARQUET_CODECS)}")
    return _written(df, path, mode, lambda rows: rows.write.mode(mode).option("compression", codec).parquet(path))


def save_tables(tables: dict[str, DataFrame], folder: str, mode: str = "overwrite", fmt: str = "parquet", **options: str) -> dict[str, str]:
    """Every table in its own folder, replacing what was there."""
    paths = {name: f"{folder}/{name}" for name in tables}
    at_once([lambda n=name, d=df: d.write.mode(mode).format(fmt).options(**options).save(paths[n]) for name, df in tables.items()])
    return paths


def append_tables(tables: dict[str, DataFrame], folder: str, order: list[str] | None = None) -> list[str]:
    """Append rows table by table, parents before children; returns the order used."""
    order = [name for name in (order or schemas.LOAD_ORDER) if name in tables]
    for name in order:
        tables[name].write.mode("append").parquet(f"{folder}/{name}")
    return order


def insert_ignore(existing: DataFrame, new: DataFrame, key: list[str], position: str) -> DataFrame:
    """The rows of ``new`` to add: none whose key exists, and the first by ``position`` of each key.

    Duplicates are reduced before the shuffle; the anti join leaves existing rows as they are.
    """
    others = [c for c in new.columns if c not in key]
    firsts = new.groupBy(*key).agg(F.min_by(F.struct(*others), position).alias("_row")).select(*key, "_row.*")
    return firsts.join(existing.select(*key), key, "left_anti").select(*new.columns)


def upsert_ignore(existing: DataFrame, new: DataFrame, key: list[str], position: str) -> DataFrame:
    """``existing`` with the rows of ``insert_ignore`` added."""
    return existing.unionByName(insert_ignore(existing, new, key, position).select(*existing.columns))


def with_generated_ids(new: DataFrame, existing: DataFrame, id_column: str, position: str) -> DataFrame:
    """``new`` with ids that go on from the largest existing id, in ``position`` order."""
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top"))
    numbered = id_by_key(new, position, "_n")
    return numbered.withColumn(id_column, F.col("_n") + top.scalar()).drop("_n")


def write_collections(collections: dict[str, DataFrame], folder: str, codec: str = "gzip") -> dict[str, str]:
    """Nested documents, one folder of JSON lines per collection, compressed: names of fields are in every line."""
    paths = {name: f"{folder}/{name}" for name in collections}
    at_once([
        lambda n=name, d=df: d.write.mode("overwrite").options(ignoreNullFields=False, compression=codec).json(paths[n])
        for name, df in collections.items()
    ])
    return paths


def export_ready(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO texts, decimals as doubles."""
    def plain(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            micros = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            c = F.when(micros.endswith(".000000"), F.substring(micros, 1, 19)).otherwise(micros)
        return c.alias(f.name)
    return df.select(*[plain(f) for f in df.schema.fields])


def export_fact(fact: DataFrame, folder: str, name: str = "star_fact_orders") -> dict[str, str]:
    """The fact table as compressed JSON lines and as snappy Parquet; nothing when it is empty."""
    ready = export_ready(fact)
    paths = {"json": f"{folder}/{name}.json", "parquet": f"{folder}/{name}.parquet"}
    if not write_json_lines(ready, paths["json"], **PACKED_JSON):
        return {}
    write_parquet(ready, paths["parquet"])
    return paths
