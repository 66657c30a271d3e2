"""Typed columns from text rows, with everything that did not fit kept in one rescue column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
MALFORMED = "_malformed_line"


def _misfit(name: str, kind: T.DataType) -> Column:
    """The text of a value that is there but is no ``kind``."""
    text = F.col(f"`{name}`")
    return F.when(text.isNotNull() & text.try_cast(kind).isNull(), text)


def apply_hints(df: DataFrame, hints: str | T.StructType, *, surplus: Sequence[str] = ()) -> DataFrame:
    """Cast hinted columns; misfits become NULL and reappear in ``_rescued_data`` as JSON.

    Columns without a hint stay text. ``surplus`` names text columns that move into the rescue JSON as
    they are. The JSON is NULL for rows that fit.
    """
    schema = T.StructType.fromDDL(hints) if isinstance(hints, str) else hints
    hinted = {field.name: field.dataType for field in schema.fields if field.name in df.columns}
    texts = {name: kind for name, kind in hinted.items() if kind != T.StringType()}
    extra = [name for name in surplus if name in df.columns]
    suspects = [*[_misfit(n, k).alias(n) for n, k in texts.items()], *[F.col(f"`{n}`") for n in extra]]
    rescued = F.lit(None).cast("string")
    if suspects:
        rescued = F.nullif(F.to_json(F.struct(*suspects)), F.lit("{}"))
    columns = [
        (F.col(f"`{n}`").try_cast(texts[n]).alias(n) if n in texts else F.col(f"`{n}`"))
        for n in df.columns
        if n not in extra
    ]
    return df.select(*columns, rescued.alias(RESCUED))
