"""Latest, first and only rows per key, with total tie-breaks so that reruns agree.

A ``row_number() = 1`` filter is planned with a group limit on both sides of the shuffle, so a key that
holds a large share of the rows leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tie_break(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Every other orderable column, descending."""
    taken = set(used)
    skip = ("map", "variant")
    return [
        F.col(f"`{name}`").desc_nulls_last()
        for name, kind in df.dtypes
        if name not in taken and not kind.startswith(skip)
    ]


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest_by(df: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The row with the greatest sequence per key; NULL sequences lose, ties go to the greatest content."""
    order = [F.col(name).desc_nulls_last() for name in sequence]
    return pick_one(df, keys, [*order, *tie_break(df, [*keys, *sequence])])


def claims_current(snapshots: DataFrame) -> DataFrame:
    """The latest snapshot of every claim."""
    return latest_by(snapshots, ["claim_id"], ["snapshot_date"])


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the preferred one, then the greatest content."""
    return pick_one(df, keys, [*prefer, *tie_break(df, keys)])


def unique_zones(zones: DataFrame, *, drop_nulls: bool = True) -> DataFrame:
    """One row per postcode, the alphabetically lowest region.

    With ``drop_nulls`` rows lacking a postcode, region or band leave first; without it a NULL postcode
    is a group of its own.
    """
    if drop_nulls:
        zones = zones.dropna(subset=["postcode", "region_name", "wind_risk_band"])
    return keep_one(zones, ["postcode"], [F.col("region_name").asc_nulls_first()])


def first_and_last(
    df: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    first: Sequence[str],
    last: Sequence[str],
) -> DataFrame:
    """Columns of the earliest row (``first_*``) and of the latest row (``last_*``) per key in one shuffle.

    Both rows come from one aggregate whose partial results shrink each key to two structs per map task.
    """
    rest = [name for name in df.columns if name not in {*keys, *sequence}]
    row = F.struct(*sequence, *rest)
    ends = df.groupBy(*keys).agg(F.min(row).alias("_first"), F.max(row).alias("_last"))
    return ends.select(
        *keys,
        *[F.col(f"_first.{name}").alias(f"first_{name}") for name in first],
        *[F.col(f"_last.{name}").alias(f"last_{name}") for name in last],
    )
