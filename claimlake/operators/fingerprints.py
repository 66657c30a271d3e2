"""Equal rows found by fingerprint first.

Grouping wide rows by all their columns moves every row. Here 128 bits of each move instead, added up on the map side; only rows
whose fingerprint was seen more than once are fetched and grouped by content. Few rows repeat as a rule, and what is fetched
grows with them. The content decides, so rows that share a fingerprint by chance are not taken for equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.operators.projection import business_columns
from claimlake.operators.report import duplicate_groups

ONE, OTHER, ROWS = "_fingerprint_1", "_fingerprint_2", "_rows"


def fingerprint(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row; which columns are NULL is part of it, as the hash function passes them over."""
    values = [F.col(f"`{c}`") for c in columns]
    empty = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return [F.xxhash64(empty, *values).alias(ONE), F.xxhash64(F.lit("other"), *values, empty).alias(OTHER)]


def fingerprint_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*fingerprint(columns)).groupBy(ONE, OTHER).agg(F.count(F.lit(1)).alias(ROWS))


def candidates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose fingerprint is not their own."""
    repeated = fingerprint_counts(df, columns).where(F.col(ROWS) > 1).drop(ROWS)
    return df.select("*", *fingerprint(columns)).join(repeated, [ONE, OTHER], "left_semi").drop(ONE, OTHER)


def duplicate_groups_by_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """As ``duplicate_groups``: rows that are there more than once, with their number; NULLs are equal."""
    keys = list(columns or business_columns(df))
    return duplicate_groups(candidates(df.select(*keys), keys), keys)


def duplicate_summary_by_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """As ``duplicate_summary``: dupe_groups, dupe_rows, rows_to_drop and total_rows in one row."""
    keys = list(columns or business_columns(df))
    n = F.col("duplicate_count")
    groups = duplicate_groups_by_fingerprint(df, keys).select(F.lit(1).alias("groups"), n.alias("in_groups"), F.lit(0).alias("all"))
    every = df.agg(F.lit(0).alias("groups"), F.lit(0).alias("in_groups"), F.count(F.lit(1)).alias("all"))
    return groups.union(every).agg(
        F.sum("groups").cast("bigint").alias("dupe_groups"),
        F.sum("in_groups").cast("bigint").alias("dupe_rows"),
        F.sum(F.col("in_groups") - F.col("groups")).cast("bigint").alias("rows_to_drop"),
        F.sum("all").cast("bigint").alias("total_rows"),
    )
