"""Ratios over money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(28,2)"


def money_total(value: Column) -> Column:
    """Sum of money (or of money sub-totals) in the width of a sum over decimal(18,2)."""
    return F.sum(value).cast(TOTAL)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole * 100, NULL when the whole is zero."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, digits)


def mean(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean of money from its sum and count, with the six extra digits a decimal average keeps."""
    return F.round((total / F.nullif(count, F.lit(0))).cast("decimal(22,6)"), digits)


def guarded(part: Column, whole: Column, otherwise: float | None = None) -> Column:
    """part / whole as a double where the whole is positive, else ``otherwise``."""
    return F.when(whole > 0, (part / whole).cast("double")).otherwise(F.lit(otherwise).cast("double"))
