"""Text, default and truthiness expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_default(c: Column | str, default) -> Column:
    """``default`` where the value is missing; an absent field and a null are the same thing here."""
    return F.coalesce(col(c), F.lit(default))


def concat_skip_nulls(*parts: Column | str) -> Column:
    """SQL CONCAT as PostgreSQL defines it: null arguments count as empty text."""
    return F.concat(*[or_default(p, "") for p in parts])


def display_name(first: Column | str, last: Column | str) -> Column:
    """First and last name joined by one space, without outer blanks."""
    return F.trim(concat_skip_nulls(first, F.lit(" "), last))


def slug(c: Column | str) -> Column:
    return F.replace(F.lower(col(c)), F.lit(" "), F.lit("-"))


def non_empty(c: Column | str) -> Column:
    """True for a text that is neither null nor empty."""
    return F.coalesce(col(c) != "", F.lit(False))


def is_set(c: Column | str, dtype: T.DataType) -> Column:
    """True unless the value is null, zero or the empty text."""
    if isinstance(dtype, T.StringType):
        return non_empty(c)
    if isinstance(dtype, T.NumericType):
        return F.coalesce(col(c) != 0, F.lit(False))
    return col(c).isNotNull()
