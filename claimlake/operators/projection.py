"""Typed projections from raw bronze rows and the lineage stamps that go with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.casting import DATE_PATTERNS, PERMISSIVE, now_or, parse_date, retype, today_or
from claimlake.schemas import BATCH_AUDIT, CLAIMS, CYCLONE_EVENTS, PREMIUMS, RISK_ZONES, AuditColumns, Entity


def business_columns(df: DataFrame, audit: Sequence[str] = BATCH_AUDIT.names) -> list[str]:
    """All columns but the audit ones, in order."""
    hidden = set(audit)
    return [name for name in df.columns if name not in hidden]


def lineage(df: DataFrame, audit: AuditColumns) -> list[Column]:
    """Source file and bronze time under their silver names, where the input has them."""
    renames = {audit.source_file: "source_file_name", audit.ingested_at: "bronze_ingestion_timestamp"}
    return [F.col(old).alias(new) for old, new in renames.items() if old in df.columns]


def stamp(df: DataFrame, column: str, clock: Column | None = None) -> DataFrame:
    """Add the layer's own time column."""
    return df.withColumn(column, now_or(clock))


def _typed(name: str, kind: str, mode: str) -> Column:
    """A cast; in permissive mode dates may come in several spellings."""
    return parse_date(name) if kind == "date" and mode == PERMISSIVE else retype(name, kind, mode)


def project_typed(
    df: DataFrame,
    entity: Entity,
    *,
    audit: AuditColumns = BATCH_AUDIT,
    mode: str = PERMISSIVE,
    overrides: Mapping[str, Column] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """One narrow select: each entity column cast to its type, then the lineage columns.

    ``overrides`` replaces single expressions, ``types`` single target types (a postcode kept as text).
    """
    overrides, types = overrides or {}, types or {}
    columns = [
        overrides.get(name, _typed(name, types.get(name, kind), mode)).alias(name)
        for name, kind in entity.fields.items()
    ]
    return df.select(*columns, *lineage(df, audit))


def typed_claims(df: DataFrame, audit: AuditColumns = BATCH_AUDIT, mode: str = PERMISSIVE) -> DataFrame:
    return project_typed(df, CLAIMS, audit=audit, mode=mode)


def typed_premiums(
    df: DataFrame, audit: AuditColumns = BATCH_AUDIT, mode: str = PERMISSIVE, postcode: str = "int"
) -> DataFrame:
    return project_typed(df, PREMIUMS, audit=audit, mode=mode, types={"postcode": postcode})


def typed_events(
    df: DataFrame,
    audit: AuditColumns = BATCH_AUDIT,
    mode: str = PERMISSIVE,
    patterns: Sequence[str] = DATE_PATTERNS,
) -> DataFrame:
    """Event windows; in permissive mode both dates may come in several spellings."""
    dates = (
        {name: parse_date(name, patterns) for name in ("start_date", "end_date")} if mode == PERMISSIVE else {}
    )
    return project_typed(df, CYCLONE_EVENTS, audit=audit, mode=mode, overrides=dates)


def typed_zones(
    df: DataFrame, audit: AuditColumns = BATCH_AUDIT, mode: str = PERMISSIVE, postcode: str = "int"
) -> DataFrame:
    return project_typed(df, RISK_ZONES, audit=audit, mode=mode, types={"postcode": postcode})


def with_active_flag(policies: DataFrame, as_of: Column | None = None) -> DataFrame:
    """A policy is active while its end date is open or not yet past."""
    end = F.col("policy_end_date")
    return policies.withColumn("is_active", end.isNull() | (end >= today_or(as_of)))


def select_expressions(df: DataFrame, expressions: Sequence[str]) -> DataFrame:
    """A declared projection list."""
    return df.selectExpr(*expressions)


def substitute(text: str, tokens: Mapping[str, str]) -> str:
    """Fill ``{token}`` placeholders; an unknown token is an error rather than a silent gap."""
    return text.format_map(dict(tokens))
