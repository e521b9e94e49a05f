"""Filter, aggregate, sort and flatten any table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}


def filter_rows(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.filter(condition)


def filter_by_function(df: DataFrame, predicate: Callable) -> DataFrame:
    """Rows for which a Python function of a record (a dict) is true; use ``filter_rows`` where an expression will do."""
    names = df.columns

    def keep(batches: Iterator) -> Iterator:
        for batch in batches:
            yield batch.filter([bool(predicate(r)) for r in batch.to_pylist()])

    return df.mapInArrow(keep, df.schema).select(*names)


def aggregate(df: DataFrame, column: str, operation: str = "sum") -> DataFrame:
    """One row with ``value``: nulls are skipped, and no values at all give 0."""
    if operation not in AGGREGATES:
        raise ValueError(f"unknown operation: {operation}")
    return df.agg(F.coalesce(AGGREGATES[operation](column), F.lit(0)).alias("value"))


def aggregate_all(df: DataFrame, column: str) -> DataFrame:
    """One row with a column per operation, in one scan."""
    return df.agg(*[F.coalesce(f(column), F.lit(0)).alias(name) for name, f in AGGREGATES.items()])


def sort_rows(df: DataFrame, column: str, reverse: bool = False, position: str | None = None) -> DataFrame:
    """Sorted by ``column``, missing values counting as 0; ``position`` keeps equal rows in their order."""
    key = F.coalesce(F.col(column), F.lit(0).cast(df.schema[column].dataType))
    keys = [key.desc() if reverse else key.asc()]
    if position:
        keys.append(F.col(position).asc())
    return df.orderBy(*keys)


def by_ids(df: DataFrame, ids: DataFrame | list, column: str = "id") -> DataFrame:
    """Point lookup of one or many ids."""
    if isinstance(ids, list):
        return df.filter(F.col(column).isin(ids))
    return df.join(ids.select(column).distinct(), column, "left_semi")


def flat_products(products: DataFrame) -> DataFrame:
    """Twelve columns of a nested product; rows without one of the first five are an error of the source."""
    return products.select(
        "id", "title", "description", "category", "price", "discountPercentage", "rating", "stock", "brand", "sku",
        "weight", "thumbnail",
    )


def flat_users(users: DataFrame) -> DataFrame:
    """Sixteen columns of a nested user, four of them from the address."""
    return users.select(
        "id", "firstName", "lastName", "maidenName", "age", "gender", "email", "phone", "username", "password",
        "birthDate", "image", F.col("address.city").alias("address_city"),
        F.col("address.address").alias("address_street"), F.col("address.state").alias("address_state"),
        F.col("address.postalCode").alias("address_postalCode"),
    )


def land_raw(entities: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Raw entities as JSON lines, products and users also flattened to CSV."""
    from merchantry.sources import sinks

    paths = {}
    for name, df in entities.items():
        paths[f"{name}.json"] = f"{folder}/{name}.json"
        sinks.write_json_lines(df, paths[f"{name}.json"])
    for name, flat in (("products", flat_products), ("users", flat_users)):
        if name in entities:
            paths[f"{name}.csv"] = f"{folder}/{name}.csv"
            sinks.write_csv(flat(entities[name]), paths[f"{name}.csv"])
    return paths
