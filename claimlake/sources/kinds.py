"""Types told from text, and how they widen: int, bigint, decimal, double; date, timestamp; and text above all.

A value has a kind if a cast takes it. The kind of a column is the narrowest that all its values have; the kind of two batches is
the narrowest that holds both (``wider``). A column without a value has no kind yet and stays open.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT = "string"
OPEN = "void"
DIGITS = {"int": 10, "bigint": 19}
MOST = 38  # digits of a decimal

# fixed values: what a text of each kind looks like
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)$"
SCIENTIFIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHOLE = r"^[+-]?\d+$"
DAY = r"^\d{4}-\d{2}-\d{2}$"
INSTANT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"


def _tests(text: Column) -> dict[str, Column]:
    def is_one(pattern: str, kind: str) -> Column:
        return text.rlike(pattern) & text.try_cast(kind).isNotNull()

    return {
        "int": is_one(WHOLE, "int"),
        "bigint": is_one(WHOLE, "bigint"),
        "number": text.rlike(NUMBER),
        "double": is_one(SCIENTIFIC, "double"),
        "date": is_one(DAY, "date"),
        "timestamp": is_one(INSTANT, "timestamp"),
    }


def kinds_of(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The kind of every text column, from one aggregate over all of them; the driver sees one row."""
    measures = []
    for number, name in enumerate(columns):
        text = F.trim(F.col(f"`{name}`"))
        measures += [F.bool_and(F.when(text.isNotNull(), test)).alias(f"{kind}_{number}") for kind, test in _tests(text).items()]
        digits = F.regexp_replace(text, r"^[+-]?0*", "")
        measures += [
            F.max(F.length(F.regexp_extract(digits, r"^\d*", 0))).alias(f"before_{number}"),
            F.max(F.length(F.regexp_extract(digits, r"\.(\d*)$", 1))).alias(f"after_{number}"),
        ]
    if not columns:
        return {}
    found = df.agg(*measures).first()
    return {name: _narrowest({k: found[f"{k}_{n}"] for k in ("int", "bigint", "number", "double", "date", "timestamp", "before", "after")}) for n, name in enumerate(columns)}


def _narrowest(found: dict) -> str:
    if found["double"] is None:
        return OPEN
    for kind in ("int", "bigint"):
        if found[kind]:
            return kind
    if found["number"] and (decimal := _decimal(found["before"], found["after"])):
        return decimal
    return next((kind for kind in ("double", "date", "timestamp") if found[kind]), TEXT)


def _decimal(before: int, after: int) -> str:
    """The decimal of so many digits, or nothing if there is none so wide."""
    return f"decimal({max(before + after, 1)},{after})" if before + after <= MOST else ""


def _parts(kind: str) -> tuple[int, int] | None:
    """Digits before and after the point; None for kinds that are no exact numbers."""
    if kind in DIGITS:
        return DIGITS[kind], 0
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return (int(found[1]) - int(found[2]), int(found[2])) if found else None


def wider(one: str, other: str) -> str:
    """The narrowest kind that holds the values of both."""
    if one == other or other == OPEN:
        return one
    if one == OPEN:
        return other
    if {one, other} == {"date", "timestamp"}:
        return "timestamp"
    if {one, other} == {"int", "bigint"}:
        return "bigint"
    a, b = _parts(one), _parts(other)
    if a and b:
        return _decimal(max(a[0], b[0]), max(a[1], b[1])) or "double"
    numbers = [k for k in (one, other) if k == "double" or _parts(k)]
    return "double" if len(numbers) == 2 else TEXT
