"""Report-only data-quality checks on bronze tables.

Every check is a DataFrame; counts over one table share one scan, and orphan checks count rows per key
before the anti join, so a key that many rows repeat is looked up once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.casting import DATE_PATTERNS, parse_date, safe_double
from claimlake.operators.projection import business_columns
from claimlake.schemas import BATCH_AUDIT

HIGH_NULL_PERCENT = 10.0


def find_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Groups of equal business rows seen more than once, most frequent first, ties by content; NULLs are equal.

    Most groups share a count, so the order goes on with the content: a range of one count can be cut.
    """
    keys = list(columns or business_columns(df))
    return duplicate_groups(df, keys).orderBy(F.col("duplicate_count").desc(), *keys)


def top_duplicates(df: DataFrame, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The n most frequent duplicate groups, ties by content."""
    keys = list(columns or business_columns(df))
    return duplicate_groups(df, keys).orderBy(F.col("duplicate_count").desc(), *keys).limit(n)


def duplicate_groups(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    keys = list(columns or business_columns(df))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).filter("duplicate_count > 1")


def duplicate_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """dupe_groups, dupe_rows, rows_to_drop and total_rows in one row, from one grouping."""
    keys = list(columns or business_columns(df))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.col("n") > 1
    return sizes.agg(
        F.count_if(repeated).alias("dupe_groups"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("dupe_rows"),
        F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("rows_to_drop"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
    )


def null_severity(percent: Column, threshold: float = HIGH_NULL_PERCENT) -> Column:
    """HIGH strictly above the threshold, else MEDIUM."""
    return F.when(percent > threshold, "HIGH").otherwise("MEDIUM")


def null_analysis(
    df: DataFrame, *, threshold: float = HIGH_NULL_PERCENT, audit: Sequence[str] = BATCH_AUDIT.names
) -> DataFrame:
    """(column, null_count, null_pct, severity, total_rows) for the business columns that have NULLs."""
    columns = business_columns(df, audit)
    totals = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"n_{i}").alias("null_count")) for i, c in enumerate(columns)]
    )
    percent = F.round(F.col("null_count") / F.col("total_rows") * 100, 1)
    return (
        totals.select("total_rows", F.inline(rows))
        .filter("null_count > 0")
        .select("column", "null_count", percent.alias("null_pct"), null_severity(percent, threshold).alias("severity"), "total_rows")
    )


@dataclass(frozen=True)
class BusinessRule:
    """A named violation test on one bronze table, with what the issue table says about it."""

    name: str
    table: str
    column: str
    says: str

    def violated(self, patterns: Sequence[str]) -> Column:
        return VIOLATIONS[self.name](lambda c: parse_date(c, patterns), safe_double)


VIOLATIONS = {
    "claims_loss_after_reported": lambda day, num: day("date_of_loss") > day("reported_date"),
    "claims_negative_incurred": lambda day, num: num("incurred_amount") < 0,
    "claims_paid_exceeds_incurred": lambda day, num: num("paid_to_date") > num("incurred_amount"),
    "premiums_bad_dates": lambda day, num: day("policy_start_date") >= day("policy_end_date"),
    "premiums_non_positive_sum_insured": lambda day, num: num("sum_insured") <= 0,
    "premiums_non_positive_annual_premium": lambda day, num: num("annual_premium") <= 0,
    "events_start_after_end": lambda day, num: day("start_date") > day("end_date"),
}

# Rule names, the table and columns they concern, and the words of the issue report.
RULES = (
    BusinessRule("claims_loss_after_reported", "claims", "date_of_loss / reported_date", "claims where loss date is after reported date"),
    BusinessRule("claims_negative_incurred", "claims", "incurred_amount", "claims with negative incurred amount"),
    BusinessRule("claims_paid_exceeds_incurred", "claims", "paid_to_date", "claims where amount paid exceeds amount incurred"),
    BusinessRule("premiums_bad_dates", "premiums", "policy_start_date / policy_end_date", "policies with start date on or after end date"),
    BusinessRule("premiums_non_positive_sum_insured", "premiums", "sum_insured", "policies with zero or negative sum insured"),
    BusinessRule("premiums_non_positive_annual_premium", "premiums", "annual_premium", "policies with zero or negative annual premium"),
    BusinessRule("events_start_after_end", "events", "start_date / end_date", "events where start date is after end date"),
)
ORPHANS = (
    BusinessRule("orphan_claim_policies", "claims", "policy_id", "claims reference a policy_id missing from premium_bordereau"),
    BusinessRule("orphan_claim_events", "claims", "event_id", "claims reference an event_id missing from cyclone_events"),
    BusinessRule("orphan_premium_postcodes", "premiums", "postcode", "premiums reference a postcode missing from risk_zone_lookup"),
)
TABLE_NAMES = {
    "claims": "bronze_claims_bordereau",
    "premiums": "bronze_premium_bordereau",
    "events": "bronze_cyclone_events",
    "zones": "bronze_risk_zone_lookup",
}


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rule_violations(df: DataFrame, table: str, patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """(rule, violations) for the rules of one table, all counted in one scan."""
    rules = [rule for rule in RULES if rule.table == table]
    totals = df.agg(*[F.count_if(rule.violated(patterns)).alias(rule.name) for rule in rules])
    rows = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("violations")) for r in rules])
    return totals.select(F.inline(rows))


def business_rule_violations(
    claims: DataFrame, events: DataFrame, premiums: DataFrame, patterns: Sequence[str] = DATE_PATTERNS
) -> DataFrame:
    """(rule, violations) over the three tables that carry rules: one scan each."""
    tables = {"claims": claims, "premiums": premiums, "events": events}
    return _stack([rule_violations(df, name, patterns) for name, df in tables.items()])


def orphan_rows(df: DataFrame, key: str, parent: DataFrame, name: str, *, null_is_orphan: bool = True) -> DataFrame:
    """(rule, violations): rows whose key the parent does not have; a NULL key counts unless told otherwise."""
    rows = df if null_is_orphan else df.filter(F.col(key).isNotNull())
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = per_key.join(parent.select(key).distinct(), key, "left_anti")
    return missing.agg(F.lit(name).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))


def referential_violations(
    claims: DataFrame, events: DataFrame, premiums: DataFrame, zones: DataFrame
) -> DataFrame:
    """(rule, violations) for the three references between the bordereaux."""
    as_number = F.col("postcode").try_cast("int")
    return _stack(
        [
            orphan_rows(claims, "policy_id", premiums, "orphan_claim_policies"),
            orphan_rows(claims, "event_id", events, "orphan_claim_events", null_is_orphan=False),
            orphan_rows(
                premiums.withColumn("postcode", as_number),
                "postcode",
                zones.withColumn("postcode", as_number),
                "orphan_premium_postcodes",
            ),
        ]
    )


def key_uniqueness(df: DataFrame, key: str = "postcode") -> DataFrame:
    """total_rows, unique keys (NULL is one key), is_unique, extra_rows."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return sizes.agg(
        total.alias("total_rows"),
        unique.alias("unique_keys"),
        (total == unique).alias("is_unique"),
        (total - unique).alias("extra_rows"),
    )


def exact_repeats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lookup rows that appear more than once, most frequent first, ties by content."""
    found = duplicate_groups(df, columns).withColumnRenamed("duplicate_count", "row_count")
    return found.orderBy(F.col("row_count").desc(), *columns)


def repeated_keys(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys with several rows and how many different values each attribute takes.

    Equal rows are counted first, so a key with very many copies reaches the second grouping as one row
    per distinct content.
    """
    contents = df.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("n"))
    return (
        contents.groupBy(key)
        .agg(F.sum("n").alias("row_count"), *[F.count_distinct(a).alias(f"distinct_{a}") for a in attributes])
        .filter("row_count > 1")
    )


def conflicting_rows(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """All rows of the keys that appear more than once, ordered by key and content; NULL keys match nothing."""
    rest = [c for c in df.columns if c != key]
    return df.join(repeated_keys(df, key, attributes).select(key), key, "left_semi").orderBy(key, *rest)


def null_issues(df: DataFrame, table: str, threshold: float = HIGH_NULL_PERCENT) -> DataFrame:
    return null_analysis(df, threshold=threshold).select(
        F.lit(table).alias("table"),
        F.lit("NULL values").alias("check_type"),
        "column",
        "severity",
        F.concat(
            F.format_number("null_count", 0), F.lit(" nulls ("), F.format_string("%.1f", "null_pct"), F.lit("% of "),
            F.format_number("total_rows", 0), F.lit(" rows)"),
        ).alias("details"),
    )


def count_issues(counts: DataFrame, rules: Sequence[BusinessRule]) -> DataFrame:
    """Issue rows for the rules that fired; the wording comes from the rule, by a constant lookup."""
    def told(part) -> Column:
        pairs = [x for rule in rules for x in (F.lit(rule.name), F.lit(part(rule)))]
        return F.element_at(F.create_map(*pairs), F.col("rule"))

    return counts.filter("violations > 0").select(
        told(lambda r: TABLE_NAMES[r.table]).alias("table"),
        F.lit("Business rule").alias("check_type"),
        told(lambda r: r.column).alias("column"),
        F.lit("HIGH").alias("severity"),
        F.concat(F.format_number("violations", 0), F.lit(" "), told(lambda r: r.says)).alias("details"),
    )


def issue_table(tables: Mapping[str, DataFrame], threshold: float = HIGH_NULL_PERCENT) -> DataFrame:
    """(table, check_type, column, severity, details) for all NULL, rule and reference findings.

    ``tables`` maps claims, premiums, events and zones to their bronze rows.
    """
    claims, premiums, events, zones = (tables[n] for n in ("claims", "premiums", "events", "zones"))
    parts = [null_issues(tables[name], TABLE_NAMES[name], threshold) for name in ("claims", "events", "premiums", "zones")]
    parts.append(count_issues(business_rule_violations(claims, events, premiums), RULES))
    parts.append(count_issues(referential_violations(claims, events, premiums, zones), ORPHANS))
    return _stack(parts).orderBy("severity", "table", "check_type")
