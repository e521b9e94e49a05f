"""Parquet files that a range of any of several columns, or one key, can skip most of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# each column is cut into 2^BITS ranges of about as many rows
BITS = 8


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise TypeError(f"{column}: rows are laid out by numbers, days and moments, not by {kind.simpleString()}")


def _place(number: Column, bounds: list[float]) -> Column:
    """How many of the ascending ``bounds`` lie below the number, by halving; 0 for null."""
    limits, steps = F.array(*[F.lit(b) for b in bounds]), F.array(*[F.lit(1 << k) for k in reversed(range(BITS))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(number > F.get(limits, at + step - 1), step).otherwise(0))
    return F.when(number.isNull(), 0).otherwise(found)


def interleaved(df: DataFrame, *columns: str) -> Column:
    """The place of a row on a curve that takes the bits of all columns in turn, so that rows near in all of them are near.

    One pass finds the ranges of all columns (255 bounds each): they hold about as many rows however the values are spread.
    """
    numbers = {c: _number(df, c) for c in columns}
    shares = [(k + 1) / (1 << BITS) for k in range((1 << BITS) - 1)]
    bounds = df.agg(*[F.percentile_approx(number, shares).alias(f"_b{k}") for k, number in enumerate(numbers.values())]).first()
    curve = F.lit(0).cast("bigint")
    for k, number in enumerate(numbers.values()):
        place = _place(number, list(bounds[k] or [0.0] * len(shares)))
        for bit in range(BITS):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("bigint")
            curve = curve + F.shiftleft(one, bit * len(numbers) + k)
    return curve


def write_clustered(df: DataFrame, path: str, columns: list[str], lookup: list[str] | None = None, row_group: int | None = None) -> None:
    """Write ``df`` along the curve of ``columns``, with Bloom filters of the ``lookup`` columns (plain names without dots).

    Row groups then hold a box of values each, so filters on any of the columns skip the others, and a lookup of a key
    skips groups whose filter lacks it. Rows of one place (a hot value) are split over tasks by their position in ``df``, which
    should read stored rows. Spark hands ranges of numbers and days to the files, but not of moments: lay those out by a column of
    their day and filter it. ``row_group`` is the size of a row group in bytes, and files keep the columns as they were.
    """
    if not 1 <= len(columns) <= 7:
        raise ValueError("lay out by one to seven columns")
    curve, at = "_curve", "_at"
    while {curve, at} & set(df.columns):
        curve, at = f"_{curve}", f"_{at}"
    placed = df.withColumns({curve: interleaved(df, *columns), at: F.monotonically_increasing_id()})
    writer = placed.repartitionByRange(curve, at).sortWithinPartitions(curve, at).drop(curve, at).write
    for name in lookup or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", True)
    if row_group:
        writer = writer.option("parquet.block.size", row_group)
    writer.parquet(path)
