"""Safe and strict casts, dates in several spellings, injectable clocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"
# Tried in order; the first pattern that fits wins.
DATE_PATTERNS = (ISO_DATE, "yyyy/MM/dd", "MM/dd/yyyy")

PERMISSIVE = "permissive"
STRICT = "strict"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_date(value: str | Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """A date from text in any of the patterns, else whatever a plain cast accepts, else NULL.

    When the ISO pattern comes first the plain cast is tried before all: it reads the same texts without a
    formatter, and no text it accepts fits a slashed pattern.
    """
    text = as_column(value)
    if patterns and patterns[0] == ISO_DATE:
        return F.coalesce(text.try_cast("date"), *[F.try_to_date(text, pattern) for pattern in patterns[1:]])
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in patterns], text.try_cast("date"))


def safe_double(value: str | Column) -> Column:
    """The number in a text column, NULL when it is not one."""
    return as_column(value).try_cast("double")


def retype(value: str | Column, kind: str, mode: str = PERMISSIVE) -> Column:
    """Cast to ``kind``: bad text becomes NULL (permissive) or fails the job (strict)."""
    source = as_column(value)
    if mode == STRICT:
        return F.to_date(source) if kind == "date" else source.cast(kind)
    if mode != PERMISSIVE:
        raise ValueError(f"unknown typing mode {mode!r}")
    return source.try_cast(kind)


def now_or(clock: Column | None) -> Column:
    """The injected instant, else the time of the run."""
    return F.current_timestamp() if clock is None else clock


def today_or(as_of: Column | None) -> Column:
    return F.current_date() if as_of is None else as_of
