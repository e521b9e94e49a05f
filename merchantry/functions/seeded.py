"""Reproducible pseudo-random columns: a hash of the row key, so they do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchantry.functions.text import col

STEPS = 1 << 31


def randint(key: Column | str, salt: str, low: int | Column, high: int | Column) -> Column:
    """A whole number in ``low..high``, both ends included."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return low + F.pmod(F.xxhash64(col(key), F.lit(salt)), (high - low + 1).cast("bigint"))


def uniform(key: Column | str, salt: str, low: float, high: float) -> Column:
    unit = F.pmod(F.xxhash64(col(key), F.lit(salt)), F.lit(STEPS).cast("bigint")) / F.lit(float(STEPS))
    return F.lit(low) + unit * F.lit(high - low)


def choice(key: Column | str, salt: str, values: list) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, randint(key, salt, 1, len(values)).cast("int"))
