"""Scaled-up synthetic tables: copies of source rows with reproducible changes."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry.functions.numbering import id_by_key
from merchantry.functions.seeded import choice, randint, uniform
from merchantry.sources import files, sinks

# Fixed values here and below: the first new id, and the texts and ranges of generated records.
FIRST_ID = 10_000


def _text(c: Column) -> Column:
    return c.cast("string")


def replicate(source: DataFrame, count: int) -> DataFrame:
    """``count`` rows cycling through the source in id order, with new ids and the replication number.

    The new ids are generated in parallel and meet their source row in an equi-join, so a handful of
    source rows does not limit the parallelism.
    """
    spark = source.sparkSession
    size = source.count()
    if size == 0:
        return source.withColumn("_replication", F.lit(0).cast("bigint"))
    rows = id_by_key(source, "id", "_pos", first=0).drop("id")
    ordinals = spark.range(count).select(
        (F.col("id") + FIRST_ID).alias("id"), F.pmod("id", F.lit(size)).alias("_pos"),
        F.call_function("div", "id", F.lit(size).cast("bigint")).alias("_replication"),
    )
    return ordinals.join(rows, "_pos").drop("_pos")


def _if_set(name: str, value: Column) -> Column:
    return F.when(F.coalesce(F.col(name) != 0, F.lit(False)), value).otherwise(F.col(name))


def users(source: DataFrame, count: int = 10_000) -> DataFrame:
    """Copied users with own user names, addresses, phone and social security numbers."""
    digits = lambda salt, low, high: _text(randint("id", salt, low, high))
    key = _text(F.col("id"))
    copies = replicate(source, count)
    return copies.withColumns({
        "username": F.concat(F.coalesce("username", F.lit("user")), F.lit("_"), key),
        "email": F.concat(F.lit("test_user_"), key, F.lit("@example.com")),
        "phone": F.concat(F.lit("+1-555-"), digits("phone-a", 1000, 9999), F.lit("-"), digits("phone-b", 1000, 9999)),
        "ssn": F.concat_ws("-", digits("ssn-a", 100, 999), digits("ssn-b", 10, 99), digits("ssn-c", 1000, 9999)),
        "age": _if_set("age", randint("id", "age", 18, 75).cast("int")),
    }).select(*source.columns)


def _scaled(name: str, salt: str, low: float, high: float) -> Column:
    return F.round(F.col(name).cast("double") * uniform("id", salt, low, high), 2).cast("decimal(12,2)")


def products(source: DataFrame, count: int = 10_000) -> DataFrame:
    """Copied products with a version in the title and new sku, barcode, price, stock and rating."""
    copies = replicate(source, count)
    low, high = F.lit(1_000_000_000_000), F.lit(9_999_999_999_999)
    return copies.withColumns({
        "title": F.concat(F.coalesce("title", F.lit("Product")), F.lit(" v"), _text(F.col("_replication") + 1)),
        "sku": F.format_string("SKU-%06d", "id"),
        "barcode": _text(randint("id", "barcode", low, high)),
        "price": _if_set("price", _scaled("price", "price", 0.8, 1.2)),
        "stock": randint("id", "stock", 0, 500).cast("int"),
        "rating": _if_set("rating", F.round(uniform("id", "rating", 3.0, 5.0), 2).cast("decimal(3,2)")),
    }).select(*source.columns)


def orders(source: DataFrame, count: int = 10_000) -> DataFrame:
    """Copied orders of random copied users; the range of user ids ends one beyond the copied users."""
    copies = replicate(source, count).withColumn("_had_total", F.coalesce(F.col("total") != 0, F.lit(False)))
    copies = copies.withColumns({
        "user_id": randint("id", "user", FIRST_ID, FIRST_ID + count),
        "total": _if_set("total", _scaled("total", "total", 0.9, 1.1)),
    })
    discounted = F.round(F.col("total") * F.lit(Decimal("0.85")), 2).cast("decimal(12,2)")
    return copies.withColumn(
        "discounted_total", F.when(F.col("_had_total"), discounted).otherwise(F.col("discounted_total"))
    ).select(*source.columns)


def simple_records(spark: SparkSession, count: int = 10_000, anchor: str = "2025-12-01") -> DataFrame:
    """Flat records with nine columns."""
    key = _text(F.col("id"))
    day = F.date_sub(F.lit(anchor).cast("date"), randint("id", "day", 0, 365).cast("int"))
    return spark.range(1, count + 1).select(
        "id", F.concat(F.lit("Test Record "), key).alias("name"),
        F.concat(F.lit("This is test record number "), key, F.lit(" for performance benchmarking")).alias("description"),
        F.round(uniform("id", "value", 10.0, 1000.0), 2).alias("value"),
        choice("id", "status", ["active", "inactive", "pending"]).alias("status"),
        choice("id", "category", ["A", "B", "C", "D", "E"]).alias("category"),
        day.cast("timestamp_ntz").alias("created_at"),
        choice("id", "is_active", [True, False]).alias("is_active"),
        randint("id", "priority", 1, 10).cast("int").alias("priority"),
    )


def generate_all(t: dict[str, DataFrame], count: int = 10_000) -> dict[str, DataFrame]:
    return {
        "test_users": users(t["users"], count), "test_products": products(t["products"], count),
        "test_orders": orders(t["orders"], count), "test_records": simple_records(t["users"].sparkSession, count),
    }


def generate_files(t: dict[str, DataFrame], folder: str, count: int = 10_000) -> DataFrame:
    """Write the four tables as compressed JSON lines; returns name, rows, bytes of the lines as read back, and bytes of the files."""
    spark = t["users"].sparkSession
    made = generate_all(t, count)
    paths = sinks.save_tables(made, folder, fmt="json", **sinks.PACKED_JSON)
    facts = [
        spark.read.text(path).agg(
            F.count("*").alias("row_count"), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("size_bytes")
        ).select(F.lit(name).alias("table_name"), "row_count", "size_bytes",
            files.file_sizes(spark, path, "*.json.gz").agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).scalar().alias("stored_bytes"))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, facts)
