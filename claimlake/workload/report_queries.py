"""Data-quality reports, rule metrics, quarantine and message parsing over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlake.operators import quality as q
from claimlake.operators import fingerprints as fp
from claimlake.operators import report as r
from claimlake.operators import rulesets
from claimlake.operators.projection import business_columns, typed_claims, typed_events, typed_premiums, typed_zones
from claimlake.schemas import CLAIMS, RISK_ZONES
from claimlake.sources.messages import parse_json
from claimlake.sources.rescue import apply_hints
from claimlake.workload import mart_queries as m
from claimlake.workload import tables as t
from claimlake.workload.oracle import half_up, with_raw, with_silver
from claimlake.workload.registry import SQL, query

DUPLICATE_KEYS = ["policy_id", "peril_type", "claim_status", "date_of_loss"]


@query(
    "report_find_duplicates",
    with_raw(
        """SELECT postcode_text AS postcode, region_name, wind_risk_band, count(*) AS duplicate_count
        FROM (SELECT *, lpad(CAST(postcode AS VARCHAR), 4, '0') AS postcode_text FROM raw_zones)
        GROUP BY ALL HAVING count(*) > 1"""
    ),
)
def _(spark, folder):
    return r.find_duplicates(t.raw_zones(spark, folder))


@query(
    "report_find_duplicate_claims",
    with_raw(
        """SELECT policy_id, peril_type, claim_status, count(*) AS duplicate_count,
        CASE WHEN bad_loss_text THEN 'not-a-date' ELSE CAST(date_of_loss AS VARCHAR) END AS date_of_loss
        FROM raw_claims GROUP BY ALL HAVING count(*) > 1"""
    ),
)
def _(spark, folder):
    return r.find_duplicates(t.raw_claims(spark, folder), DUPLICATE_KEYS)


@query(
    "report_top_duplicates",
    with_raw(
        """SELECT policy_id, peril_type, claim_status, count(*) AS duplicate_count FROM raw_claims
        GROUP BY policy_id, peril_type, claim_status HAVING count(*) > 1
        ORDER BY duplicate_count DESC, policy_id NULLS FIRST, peril_type NULLS FIRST, claim_status NULLS FIRST LIMIT 20"""
    ),
)
def _(spark, folder):
    return r.top_duplicates(t.raw_claims(spark, folder), 20, ["policy_id", "peril_type", "claim_status"])


@query(
    "report_duplicate_summary",
    with_raw(
        """SELECT count(*) FILTER (n > 1) AS dupe_groups, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS dupe_rows,
        CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS rows_to_drop, CAST(sum(n) AS BIGINT) AS total_rows
        FROM (SELECT policy_id, peril_type, claim_status, date_of_loss, bad_loss_text, count(*) AS n FROM raw_claims GROUP BY ALL)"""
    ),
)
def _(spark, folder):
    return r.duplicate_summary(t.raw_claims(spark, folder), DUPLICATE_KEYS)


@query(
    "report_duplicate_summary_all_columns",
    with_raw(
        """SELECT count(*) FILTER (n > 1) AS dupe_groups, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS dupe_rows,
        CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS rows_to_drop, CAST(sum(n) AS BIGINT) AS total_rows
        FROM (SELECT claim_id, policy_id, event_id, date_of_loss, reported_date, peril_type, claim_status, incurred, paid,
          snapshot_date, count(*) AS n FROM raw_claims GROUP BY ALL)"""
    ),
)
def _(spark, folder):
    return r.duplicate_summary(t.raw_claims(spark, folder))


def _nulls_sql(source: str, columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS total_rows FROM {source}"
        for c in columns
    )
    pct = half_up("null_count * 100", "total_rows", 1)
    return with_raw(
        f"""SELECT "column", null_count, {pct} AS null_pct,
        CASE WHEN {pct} > 10 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, total_rows FROM ({parts}) WHERE null_count > 0"""
    )


@query("report_nulls_claims", _nulls_sql("raw_claims", ["claim_id", "policy_id", "event_id", "peril_type", "claim_status"]))
def _(spark, folder):
    return r.null_analysis(t.raw_claims(spark, folder))


@query("report_nulls_zones", _nulls_sql("raw_zones", ["postcode", "region_name", "wind_risk_band"]))
def _(spark, folder):
    return r.null_analysis(t.raw_zones(spark, folder))


RULE_SQL = {
    "claims_loss_after_reported": ("raw_claims", "date_of_loss > reported_date"),
    "claims_negative_incurred": ("raw_claims", "incurred < 0"),
    "claims_paid_exceeds_incurred": ("raw_claims", "paid > incurred"),
    "premiums_bad_dates": ("raw_premiums", "policy_start_date >= policy_end_date"),
    "premiums_non_positive_sum_insured": ("raw_premiums", "insured <= 0"),
    "premiums_non_positive_annual_premium": ("raw_premiums", "premium <= 0"),
    "events_start_after_end": ("raw_events", "start_date > end_date"),
}
RULES_UNION = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) FILTER ({test}) AS violations FROM {source}" for name, (source, test) in RULE_SQL.items()
)
ORPHANS_UNION = """
  SELECT 'orphan_claim_policies' AS rule, count(*) AS violations FROM raw_claims c
    WHERE NOT EXISTS (SELECT 1 FROM raw_premiums p WHERE p.policy_id = c.policy_id)
  UNION ALL SELECT 'orphan_claim_events', count(*) FROM raw_claims c
    WHERE event_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM raw_events e WHERE e.event_id = c.event_id)
  UNION ALL SELECT 'orphan_premium_postcodes', count(*) FROM raw_premiums p
    WHERE NOT EXISTS (SELECT 1 FROM raw_zones z WHERE z.postcode = p.postcode)"""


@query("report_business_rules", with_raw(RULES_UNION))
def _(spark, folder):
    return r.business_rule_violations(
        t.raw_claims(spark, folder), t.raw_events(spark, folder), t.raw_premiums(spark, folder)
    )


@query("report_referential_integrity", with_raw(ORPHANS_UNION))
def _(spark, folder):
    return r.referential_violations(
        t.raw_claims(spark, folder), t.raw_events(spark, folder), t.raw_premiums(spark, folder), t.raw_zones(spark, folder)
    )


@query(
    "report_zone_uniqueness",
    with_raw(
        """SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS unique_keys, sum(n) = count(*) AS is_unique,
        CAST(sum(n) - count(*) AS BIGINT) AS extra_rows FROM (SELECT postcode, count(*) AS n FROM raw_zones GROUP BY postcode)"""
    ),
)
def _(spark, folder):
    return r.key_uniqueness(t.raw_zones(spark, folder))


@query(
    "report_exact_zone_repeats",
    with_raw(
        """SELECT lpad(CAST(postcode AS VARCHAR), 4, '0') AS postcode, region_name, wind_risk_band, count(*) AS row_count
        FROM raw_zones GROUP BY ALL HAVING count(*) > 1"""
    ),
)
def _(spark, folder):
    return r.exact_repeats(t.raw_zones(spark, folder), RISK_ZONES.columns)


@query(
    "report_repeated_zone_keys",
    with_raw(
        """SELECT lpad(CAST(postcode AS VARCHAR), 4, '0') AS postcode, count(*) AS row_count,
        count(DISTINCT region_name) AS distinct_region_name, count(DISTINCT wind_risk_band) AS distinct_wind_risk_band
        FROM raw_zones GROUP BY postcode HAVING count(*) > 1"""
    ),
)
def _(spark, folder):
    return r.repeated_keys(t.raw_zones(spark, folder), "postcode", ["region_name", "wind_risk_band"])


@query(
    "report_conflicting_zones",
    with_raw(
        """SELECT lpad(CAST(postcode AS VARCHAR), 4, '0') AS postcode, region_name, wind_risk_band, source_file_name
        FROM raw_zones WHERE postcode IN (SELECT postcode FROM raw_zones GROUP BY postcode HAVING count(*) > 1)"""
    ),
)
def _(spark, folder):
    rows = r.conflicting_rows(t.raw_zones(spark, folder), "postcode", ["region_name", "wind_risk_band"])
    return rows.drop("ingestion_timestamp")


def _issues_sql() -> str:
    nulls = " UNION ALL ".join(
        f"SELECT '{table}' AS tbl, '{c}' AS col, count(*) FILTER ({c} IS NULL) AS n, count(*) AS total FROM {source}"
        for table, source, columns in (
            ("bronze_claims_bordereau", "raw_claims", ["claim_id", "policy_id", "event_id", "peril_type"]),
            ("bronze_risk_zone_lookup", "raw_zones", ["postcode", "region_name"]),
            ("bronze_cyclone_events", "raw_events", ["event_id", "event_name"]),
        )
        for c in columns
    )
    pct = half_up("n * 100", "total", 1)
    cases = {
        part: " ".join(f"WHEN '{rule.name}' THEN '{getattr(rule, part)}'" for rule in (*r.RULES, *r.ORPHANS))
        for part in ("table", "column", "says")
    }
    tables = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in r.TABLE_NAMES.items())
    return with_raw(
        f"""SELECT tbl AS "table", 'NULL values' AS check_type, col AS "column",
          CASE WHEN {pct} > 10 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
          concat(format('{{:,}}', n), ' nulls (', format('{{:.1f}}', {pct}), '% of ', format('{{:,}}', total), ' rows)') AS details
        FROM ({nulls}) WHERE n > 0
        UNION ALL
        SELECT CASE (CASE rule {cases['table']} END) {tables} END, 'Business rule', CASE rule {cases['column']} END, 'HIGH',
          concat(format('{{:,}}', violations), ' ', CASE rule {cases['says']} END)
        FROM ({RULES_UNION} UNION ALL {ORPHANS_UNION}) WHERE violations > 0"""
    )


@query("report_issue_table", _issues_sql())
def _(spark, folder):
    return r.issue_table(
        {
            "claims": t.raw_claims(spark, folder),
            "premiums": t.raw_premiums(spark, folder),
            "events": t.raw_events(spark, folder),
            "zones": t.raw_zones(spark, folder),
        }
    )


# ---- rule metrics and splits ----

# How predicates over the Spark columns read over the SQL twins' columns.
BRONZE_CLAIMS = {
    "date_of_loss_not_empty": "bad_loss_text OR date_of_loss IS NOT NULL",
    "snapshot_date_not_null": "snapshot_date IS NOT NULL",
}
CENTS = {
    "incurred_amount": "incurred", "paid_to_date": "paid", "sum_insured": "insured", "annual_premium": "premium",
}


def _predicate(rule: q.Rule, special: dict[str, str]) -> str:
    text = special.get(rule.name, rule.predicate)
    for spark_name, cents in CENTS.items():
        text = text.replace(spark_name, cents)
    return f"coalesce({text}, FALSE)"


def _metrics_sql(source: str, dataset: str, rules: list[q.Rule], special: dict[str, str] | None = None) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, '{rule.name}' AS expectation, '{rule.action}' AS action, '{rule.tag}' AS tag,
        count(*) FILTER ({_predicate(rule, special or {})}) AS passed_records,
        count(*) FILTER (NOT {_predicate(rule, special or {})}) AS failed_records FROM {source}"""
        for rule in rules
    )


@query("rules_bronze_claims", with_raw(_metrics_sql("raw_claims", "claims_bordereau", rulesets.BRONZE["claims_bordereau"], BRONZE_CLAIMS)))
def _(spark, folder):
    return q.rule_metrics(t.raw_claims(spark, folder), rulesets.BRONZE["claims_bordereau"], "claims_bordereau")


@query("rules_silver_claims", with_raw(_metrics_sql("raw_claims", "claims_snapshots", rulesets.SILVER["claims_snapshots"])))
def _(spark, folder):
    typed = typed_claims(t.raw_claims(spark, folder))
    return q.rule_metrics(typed, rulesets.SILVER["claims_snapshots"], "claims_snapshots")


@query("rules_silver_policies", with_raw(_metrics_sql("raw_premiums", "policies", rulesets.SILVER["policies"])))
def _(spark, folder):
    return q.rule_metrics(typed_premiums(t.raw_premiums(spark, folder)), rulesets.SILVER["policies"], "policies")


@query("rules_silver_zones", with_raw(_metrics_sql("raw_zones", "risk_zones", rulesets.SILVER["risk_zones"])))
def _(spark, folder):
    return q.rule_metrics(typed_zones(t.raw_zones(spark, folder)), rulesets.SILVER["risk_zones"], "risk_zones")


@query("rules_silver_events", with_raw(_metrics_sql("raw_events", "cyclone_events", rulesets.SILVER["cyclone_events"])))
def _(spark, folder):
    return q.rule_metrics(typed_events(t.raw_events(spark, folder)), rulesets.SILVER["cyclone_events"], "cyclone_events")


@query(
    "rules_gold_claims_summary",
    with_silver(
        _metrics_sql("mart", "claims_summary", rulesets.GOLD["claims_summary"]),
        """mart AS (SELECT peril_type, count(*) AS claim_count, sum(incurred) AS total_incurred, sum(paid) AS total_paid
        FROM current_claims c LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id
        GROUP BY peril_type, claim_status, region_name, wind_risk_band, building_type)""",
    ),
)
def _(spark, folder):
    return q.rule_metrics(m.claims_summary_current(spark, folder), rulesets.GOLD["claims_summary"], "claims_summary")


SILVER_RULES = rulesets.SILVER["claims_snapshots"]
HARD = " AND ".join(_predicate(rule, {}) for rule in SILVER_RULES if rule.action == q.DROP)
REASON = "concat_ws(',', " + ", ".join(f"CASE WHEN NOT {_predicate(rule, {})} THEN '{rule.name}' END" for rule in SILVER_RULES) + ")"


@query("rules_kept_claims", with_raw(f"SELECT {m.CLAIM_COLUMNS} FROM raw_claims WHERE {HARD}"))
def _(spark, folder):
    kept, _ = q.split(typed_claims(t.derived_once(t.raw_claims(spark, folder))), SILVER_RULES)
    return kept.select(*CLAIMS.columns)


@query(
    "rules_quarantined_claims",
    with_raw(f"SELECT {m.CLAIM_COLUMNS}, {REASON} AS quarantine_reason FROM raw_claims WHERE {REASON} <> ''"),
)
def _(spark, folder):
    _, bad = q.split(typed_claims(t.derived_once(t.raw_claims(spark, folder))), SILVER_RULES)
    return bad.select(*CLAIMS.columns, "quarantine_reason")


RESCUED_SQL = """CASE WHEN bad_loss_text AND incurred IS NULL THEN '{"date_of_loss":"not-a-date","incurred_amount":"N/A"}'
  WHEN bad_loss_text THEN '{"date_of_loss":"not-a-date"}' WHEN incurred IS NULL THEN '{"incurred_amount":"N/A"}' END"""


@query("rescued_claims", with_raw(f"SELECT {m.CLAIM_COLUMNS}, {RESCUED_SQL} AS _rescued_data FROM raw_claims"))
def _(spark, folder):
    return apply_hints(t.derived_once(t.raw_claims(spark, folder)), CLAIMS.hints).select(*CLAIMS.columns, "_rescued_data")


@query(
    "quarantine_from_raw_claims",
    with_raw(
        f"""SELECT claim_id, policy_id, snapshot_date,
        concat_ws(',', CASE WHEN rescued IS NOT NULL THEN 'rescued_data' END, CASE WHEN claim_id IS NULL THEN 'claim_id_null' END)
          AS quarantine_reason
        FROM (SELECT *, {RESCUED_SQL} AS rescued FROM raw_claims) WHERE rescued IS NOT NULL OR claim_id IS NULL"""
    ),
)
def _(spark, folder):
    bad = q.quarantine_from_raw(apply_hints(t.derived_once(t.raw_claims(spark, folder)), CLAIMS.hints), "claim_id")
    return bad.select("claim_id", "policy_id", "snapshot_date", "quarantine_reason")


@query(
    "clean_claims",
    with_raw("SELECT claim_id, policy_id, snapshot_date FROM raw_claims WHERE claim_id IS NOT NULL"),
)
def _(spark, folder):
    clean = q.clean_from_raw(apply_hints(t.raw_claims(spark, folder), CLAIMS.hints), "claim_id")
    return clean.select("claim_id", "policy_id", "snapshot_date")


# ---- messages: the claims as JSON text, some broken ----


def claim_messages(spark, folder):
    """One JSON text per claim; amounts paid ending in 7 give broken text, in 3 no text at all."""
    typed = typed_claims(t.raw_claims(spark, folder)).select(*CLAIMS.columns)
    text = F.to_json(F.struct(*CLAIMS.columns))
    paid = F.col("paid_to_date").cast("string")
    return typed.select(F.when(paid.endswith("7"), "{not valid").when(~paid.endswith("3"), text).alias("_raw_value"))


PARSED_SQL = """messages AS (SELECT *, CASE WHEN paid % 10 = 7 THEN 'invalid_json' WHEN paid % 10 = 3 THEN 'null_value' END AS err
  FROM raw_claims)"""


@query(
    "parse_messages",
    with_raw(
        f"""SELECT err AS _parse_error, {", ".join(f"CASE WHEN err IS NULL THEN {c} END AS {a}" for c, a in (
            ("claim_id", "claim_id"), ("policy_id", "policy_id"), ("date_of_loss", "date_of_loss"),
            ("CAST(incurred AS DOUBLE) / 100.0", "incurred_amount")))} FROM messages""",
        PARSED_SQL,
    ),
)
def _(spark, folder):
    parsed = parse_json(t.derived_once(claim_messages(spark, folder)), CLAIMS.typed_schema())
    return parsed.select("_parse_error", "claim_id", "policy_id", "date_of_loss", "incurred_amount")


@query(
    "quarantined_messages",
    with_raw(
        """SELECT concat_ws(',', err, CASE WHEN err IS NOT NULL OR claim_id IS NULL THEN 'claim_id_null' END) AS quarantine_reason,
        count(*) AS rows FROM messages WHERE err IS NOT NULL OR claim_id IS NULL GROUP BY 1""",
        PARSED_SQL,
    ),
)
def _(spark, folder):
    parsed = parse_json(t.derived_once(claim_messages(spark, folder)), CLAIMS.typed_schema())
    return q.message_quarantine(parsed, "claim_id").groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "business_columns_only",
    with_raw("SELECT lpad(CAST(postcode AS VARCHAR), 4, '0') AS postcode, region_name, wind_risk_band FROM raw_zones"),
)
def _(spark, folder):
    zones = t.raw_zones(spark, folder)
    return zones.select(*business_columns(zones))


@query("report_duplicate_summary_by_fingerprint", SQL["report_duplicate_summary"])
def _(spark, folder):
    return fp.duplicate_summary_by_fingerprint(t.raw_claims(spark, folder), DUPLICATE_KEYS)


@query("report_exact_zone_repeats_by_fingerprint", SQL["report_exact_zone_repeats"])
def _(spark, folder):
    found = fp.duplicate_groups_by_fingerprint(t.raw_zones(spark, folder), RISK_ZONES.columns)
    return found.withColumnRenamed("duplicate_count", "row_count")
