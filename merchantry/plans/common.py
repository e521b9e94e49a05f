"""Building blocks of the analytic queries."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.functions.money import mean_money
from merchantry.sources.store import MONTH

# the stored table of orders beside the fact rows of a model
ORDER_SUMS = "order_sums"
# the stored fact rows without ids and places, in no order, for questions about products
SOLD_LINES = "sold_lines"


def total(column: str, name: str) -> Column:
    return F.sum(column).alias(name)


def distinct(column: str, name: str) -> Column:
    return F.count_distinct(column).alias(name)


def mean_parts(column: str) -> list[Column]:
    """Sum and count behind an exact average, for ``mean_of``."""
    return [F.sum(column).alias(f"_sum_{column}"), F.count(column).alias(f"_n_{column}")]


def mean_of(column: str, name: str) -> Column:
    return mean_money(f"_sum_{column}", f"_n_{column}").alias(name)


def top(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest ``measure``, nulls first, ties in ascending order."""
    return df.orderBy(F.col(measure).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties]).limit(n)


def ranked(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties])


def best_label(label: str, measure: str) -> Column:
    """Aggregate: the label with the largest measure, ties to the first label. A group is never sorted."""
    return F.min_by(label, F.struct(-F.col(measure), F.col(label)))


def best_known_label(label: str, measure: str) -> Column:
    """``best_label`` among the rows that have a label."""
    return F.min_by(label, F.when(F.col(label).isNotNull(), F.struct(-F.col(measure), F.col(label))))


def best(group: str, label: str, measure: str, df: DataFrame, name: str) -> DataFrame:
    """Per group the label with the largest measure."""
    return df.groupBy(group).agg(best_label(label, measure).alias(name))


def per_order(fact: DataFrame, *attributes: str) -> DataFrame:
    """Fact rows summed per order, with attributes that an order has one value of (user, day, location).

    Counting orders is then counting rows, so no distinct count has to expand the fact rows.
    """
    return fact.groupBy("order_id", *attributes).agg(
        F.sum("quantity").alias("_quantity"), F.sum("total_amount").alias("_amount"),
        F.count("total_amount").alias("_lines"), F.sum("discount_amount").alias("_discounts"),
    )


def order_sums(m: dict[str, DataFrame]) -> DataFrame:
    """The orders of a model: stored with it, or summed from the fact rows of a model that is not stored."""
    if ORDER_SUMS in m:
        return m[ORDER_SUMS]
    attributes = [c for c in ("user_id", "date_id", "location_id", MONTH) if c in m["fact_orders"].columns]
    return per_order(m["fact_orders"], *attributes)


def sold_lines(m: dict[str, DataFrame]) -> DataFrame:
    """What was sold per line, for questions that ask for no fact id: the fact rows if they are there, else lines that were never
    numbered or laid out by month."""
    return m[SOLD_LINES] if SOLD_LINES in m and not m.built("fact_orders") else m["fact_orders"]


def mean_line(total_name: str, name: str) -> Column:
    """Average line amount from rows that carry the line count."""
    return mean_money(total_name, "_line_count").alias(name)


def calendar(dates: DataFrame, *columns: str) -> DataFrame:
    """Calendar columns for a map-side join: at most 366 rows per year of the calendar."""
    return F.broadcast(dates.select("date_id", *columns))


def among(dimension: DataFrame, key: str, rows: DataFrame) -> DataFrame:
    """What a few settled ``rows`` refer to in a dimension: their keys are broadcast, not the dimension."""
    return dimension.join(F.broadcast(rows.select(key).distinct()), key, "left_semi")


def months_of(df: DataFrame) -> list[int]:
    """The months that a stored table has files of, newest first, from the names of the files."""
    found = {m.group(1) for m in (re.search(rf"/{MONTH}=(\d+)/", name) for name in df.inputFiles()) if m}
    return sorted(map(int, found), reverse=True)
