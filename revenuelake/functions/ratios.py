"""Arithmetic on money and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL when the denominator is zero (ANSI mode would raise).

    Decimal division is avoided because Spark truncates its scale.
    """
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def pct_change(value: Column, base: Column) -> Column:
    """Change against ``base`` in percent; NULL without a base."""
    return (value.cast("double") - base.cast("double")) / F.nullif(base.cast("double"), F.lit(0.0)) * 100


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def clamp(value: Column, low: float, high: float) -> Column:
    """NULL becomes ``high``: ``least`` skips NULL, as the reference's LEAST does."""
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def one_decimal(value: Column) -> Column:
    """Text with one decimal and no exponent."""
    return F.round(value, 1).cast("decimal(20,1)").cast("string")


def two_decimals(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(20,2)").cast("string")


def join_text(*parts: Column | str) -> Column:
    """Concatenation that skips NULL parts (``concat`` would return NULL)."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
