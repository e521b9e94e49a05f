"""Exact money arithmetic: decimals in, decimals out, half away from zero."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchantry.functions.text import col

WIDE = "decimal(38,0)"


def as_money(c: Column | str, precision: int = 12, scale: int = 2) -> Column:
    return col(c).cast(f"decimal({precision},{scale})")


def cents(c: Column | str) -> Column:
    """Two-place decimal as a whole number of cents."""
    return (col(c) * 100).cast(WIDE)


def half_up(numerator: Column, denominator: Column) -> Column:
    """Whole-number quotient, rounded half away from zero; null for a zero denominator."""
    n = F.abs(numerator).cast(WIDE)
    d = F.nullif(denominator.cast(WIDE), F.lit(0).cast(WIDE))
    magnitude = F.call_function("div", n * 2 + d, d * 2)
    return F.when(numerator < 0, -magnitude).otherwise(magnitude)


def from_cents(c: Column) -> Column:
    return (c.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")


def mean_money(total: Column | str, count: Column | str) -> Column:
    """Average of a two-place money column from its sum and its count, to two places."""
    return from_cents(half_up(cents(total), col(count)))


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole to two places, for two-place money columns."""
    return from_cents(half_up(cents(part) * 10000, cents(whole)))


def line_amounts(price: Column | str, quantity: Column | str, pct: Column | str) -> dict[str, Column]:
    """Subtotal, discount and total of an order line, each rounded from the unrounded value."""
    subtotal = col(price).cast("decimal(12,2)") * col(quantity).cast("decimal(10,0)")
    discount = subtotal * F.coalesce(col(pct), F.lit(0)).cast("decimal(5,2)") * F.lit(Decimal("0.01"))
    return {
        "discount_amount": F.round(discount, 2).cast("decimal(18,2)"),
        "subtotal": F.round(subtotal, 2).cast("decimal(18,2)"),
        "total_amount": F.round(subtotal - discount, 2).cast("decimal(18,2)"),
    }
