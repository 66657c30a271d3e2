"""Silver tables and marts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlake.functions.casting import STRICT
from claimlake.operators import changing, marts
from claimlake.operators.latest import first_and_last, keep_one, unique_zones
from claimlake.operators.projection import typed_claims, typed_premiums, typed_zones, with_active_flag
from claimlake.session import work_path
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert
from claimlake.workload import tables as t
from claimlake.workload.oracle import (
    coarse_percent, coarse_ratio, half_up, mean, money, percent, with_raw, with_silver,
)
from claimlake.workload.registry import SQL, query

CLAIM_COLUMNS = f"""claim_id, policy_id, event_id, date_of_loss, reported_date, peril_type, claim_status,
  {money('incurred')} AS incurred_amount, {money('paid')} AS paid_to_date, snapshot_date"""
PREMIUM_COLUMNS = f"""policy_id, insurer_name, CAST(postcode AS INTEGER) AS postcode, region_name, wind_risk_band, building_type,
  {money('insured')} AS sum_insured, mitigation_flag, {money('premium')} AS annual_premium, policy_start_date, policy_end_date"""
LINEAGE = "source_file_name, ingested AS bronze_ingestion_timestamp"
RISK = "insurer_name, region_name, wind_risk_band, building_type, mitigation_flag"


@query("typed_claims", with_raw(f"SELECT {CLAIM_COLUMNS}, {LINEAGE} FROM raw_claims"))
def _(spark, folder):
    return typed_claims(t.raw_claims(spark, folder))


@query("typed_premiums", with_raw(f"SELECT {PREMIUM_COLUMNS}, {LINEAGE} FROM raw_premiums"))
def _(spark, folder):
    return typed_premiums(t.raw_premiums(spark, folder))


@query(
    "typed_claims_strict",
    with_raw(
        f"""SELECT {CLAIM_COLUMNS}, {LINEAGE},
        CASE WHEN NOT bad_loss_text AND incurred IS NOT NULL THEN 'strict' ELSE 'quarantine' END AS outcome FROM raw_claims"""
    ),
)
def _(spark, folder):
    # Strict typing fails the job on bad text, so rows are judged first and only those that fit are typed strictly.
    raw = t.raw_claims(spark, folder)
    fits = F.expr("try_to_date(date_of_loss) IS NOT NULL AND try_cast(incurred_amount AS DOUBLE) IS NOT NULL")
    strict = typed_claims(raw.filter(fits), mode=STRICT).withColumn("outcome", F.lit("strict"))
    return strict.unionByName(typed_claims(raw.filter(~fits)).withColumn("outcome", F.lit("quarantine")))


@query(
    "policies_with_text_postcode_and_activity",
    with_raw(
        """SELECT policy_id, CASE WHEN CAST(policy_id AS BIGINT) % 37 = 0 THEN '9999' WHEN CAST(policy_id AS BIGINT) % 43 = 0 THEN 'n/a'
           ELSE lpad(CAST(postcode AS VARCHAR), 4, '0') END AS postcode,
           policy_end_date, policy_end_date >= DATE '1996-01-01' AS is_active FROM raw_premiums"""
    ),
)
def _(spark, folder):
    typed = typed_premiums(t.raw_premiums(spark, folder), postcode="string")
    active = with_active_flag(typed, F.lit("1996-01-01").cast("date"))
    return active.select("policy_id", "postcode", "policy_end_date", "is_active")


@query("silver_claims", with_silver(f"SELECT {CLAIM_COLUMNS}, {LINEAGE} FROM silver_claims"))
def _(spark, folder):
    return t.silver_claims(spark, folder)


@query("silver_premiums", with_silver(f"SELECT {PREMIUM_COLUMNS}, {LINEAGE} FROM silver_premiums"))
def _(spark, folder):
    return t.silver_premiums(spark, folder)


@query(
    "silver_cyclone_events",
    with_silver(f"SELECT event_id, event_name, start_date, end_date, {LINEAGE} FROM silver_events"),
)
def _(spark, folder):
    return t.silver_events(spark, folder)


@query(
    "silver_risk_zones",
    with_silver(f"SELECT CAST(postcode AS INTEGER) AS postcode, region_name, wind_risk_band, {LINEAGE} FROM silver_zones"),
)
def _(spark, folder):
    return t.silver_zones(spark, folder)


@query(
    "risk_zones_with_null_group",
    with_raw(
        """SELECT CAST(postcode AS INTEGER) AS postcode, region_name, wind_risk_band FROM raw_zones
           QUALIFY row_number() OVER (PARTITION BY postcode ORDER BY region_name NULLS FIRST, wind_risk_band DESC,
             source_file_name DESC, ingested DESC) = 1"""
    ),
)
def _(spark, folder):
    zones = unique_zones(typed_zones(t.raw_zones(spark, folder)), drop_nulls=False)
    return zones.select("postcode", "region_name", "wind_risk_band")


@query("claims_current", with_silver(f"SELECT {CLAIM_COLUMNS}, {LINEAGE} FROM current_claims"))
def _(spark, folder):
    return t.current_claims(spark, folder)


@query(
    "keep_one_snapshot_per_day",
    with_silver(
        f"""SELECT claim_id, snapshot_date, {money('incurred')} AS incurred_amount FROM silver_claims
        QUALIFY row_number() OVER (PARTITION BY claim_id, snapshot_date ORDER BY ingested DESC, policy_id DESC,
          event_id DESC NULLS LAST, date_of_loss DESC, reported_date DESC, peril_type DESC, claim_status DESC,
          incurred DESC, paid DESC, source_file_name DESC) = 1"""
    ),
)
def _(spark, folder):
    kept = keep_one(
        t.silver_claims(spark, folder), ["claim_id", "snapshot_date"], [F.col("bronze_ingestion_timestamp").desc()]
    )
    return kept.select("claim_id", "snapshot_date", "incurred_amount")


@query(
    "first_and_last_snapshot",
    with_silver(
        f"""SELECT claim_id, min(snapshot_date) AS first_snapshot_date, max(snapshot_date) AS last_snapshot_date,
        {money("arg_min(incurred, (snapshot_date, incurred, paid))")} AS first_incurred_amount,
        {money("arg_max(incurred, (snapshot_date, incurred, paid))")} AS last_incurred_amount,
        {money("arg_max(paid, (snapshot_date, incurred, paid))")} AS last_paid_to_date
        FROM silver_claims GROUP BY claim_id"""
    ),
)
def _(spark, folder):
    rows = t.silver_claims(spark, folder).select("claim_id", "snapshot_date", "incurred_amount", "paid_to_date")
    return first_and_last(
        rows, ["claim_id"], ["snapshot_date"],
        first=["snapshot_date", "incurred_amount"], last=["snapshot_date", "incurred_amount", "paid_to_date"],
    )


# ---- claims summary ----

SUMMARY_MEASURES = f"""
  {money('sum(incurred)')} AS total_incurred, {money('sum(paid)')} AS total_paid,
  {money('sum(incurred - paid)')} AS outstanding_reserve,
  {mean('sum(incurred)', 'count(incurred)')} AS avg_claim_severity,
  {percent('sum(paid)', 'sum(incurred)')} AS settlement_pct"""


def _summary_sql(claims: str, count: str) -> str:
    return with_silver(
        f"""SELECT peril_type, claim_status, region_name, wind_risk_band, building_type,
        {count} AS claim_count, {SUMMARY_MEASURES}
        FROM {claims} c LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id
        GROUP BY peril_type, claim_status, region_name, wind_risk_band, building_type"""
    )


@query("mart_claims_summary", _summary_sql("current_claims", "count(c.claim_id)"))
def claims_summary_current(spark, folder):
    return marts.claims_summary(t.current_claims(spark, folder), t.silver_premiums(spark, folder))


@query("mart_claims_summary_snapshots", _summary_sql("silver_claims", "count(c.claim_id)"))
def _(spark, folder):
    return marts.claims_summary(t.silver_claims(spark, folder), t.silver_premiums(spark, folder))


@query("mart_claims_summary_distinct", _summary_sql("silver_claims", "count(DISTINCT c.claim_id)"))
def _(spark, folder):
    return marts.claims_summary(t.silver_claims(spark, folder), t.silver_premiums(spark, folder), distinct=True)


# ---- loss ratios ----


@query(
    "mart_loss_ratio_by_risk",
    with_silver(
        f"""SELECT {RISK}, count(DISTINCT p.policy_id) AS policy_count, {money('sum(premium)')} AS total_premium,
        count(c.claim_id) AS claim_count, {money('coalesce(sum(incurred), 0)')} AS total_incurred,
        {percent('coalesce(sum(incurred), 0)', 'sum(premium)')} AS loss_ratio_pct
        FROM silver_premiums p LEFT JOIN current_claims c ON p.policy_id = c.policy_id GROUP BY {RISK}"""
    ),
)
def loss_ratio_by_risk(spark, folder):
    return marts.loss_ratio_by_risk(t.silver_premiums(spark, folder), t.current_claims(spark, folder))


def _policy_sql(keys: str, claims: str, measures: str) -> str:
    return with_silver(
        f"""SELECT {keys}, count(DISTINCT p.policy_id) AS policy_count, {money('sum(premium)')} AS total_premium,
        CAST(coalesce(sum(n), 0) AS BIGINT) AS claim_count, {money('coalesce(sum(inc), 0)')} AS total_incurred, {measures}
        FROM silver_premiums p LEFT JOIN by_policy c ON p.policy_id = c.policy_id GROUP BY {keys}""",
        f"""by_policy AS (SELECT policy_id, count(DISTINCT claim_id) AS n, sum(incurred) AS inc, sum(paid) AS pd
        FROM {claims} GROUP BY policy_id)""",
    )


POLICY_RATIOS = f"""{money('coalesce(sum(pd), 0)')} AS total_paid,
  CASE WHEN sum(premium) > 0 THEN {coarse_ratio('coalesce(sum(inc), 0)', 'sum(premium)')} END AS loss_ratio,
  CASE WHEN sum(premium) > 0 THEN {coarse_percent('coalesce(sum(inc), 0)', 'sum(premium)')} END AS loss_ratio_pct"""


@query("mart_policy_loss_ratio", _policy_sql(RISK, "current_claims", POLICY_RATIOS))
def policy_loss_ratio(spark, folder):
    return marts.policy_loss_ratio(t.silver_premiums(spark, folder), t.current_claims(spark, folder))


@query(
    "mart_policy_loss_ratio_three_keys",
    _policy_sql("insurer_name, wind_risk_band, building_type", "silver_claims", POLICY_RATIOS),
)
def _(spark, folder):
    return marts.policy_loss_ratio(
        t.silver_premiums(spark, folder), t.silver_claims(spark, folder),
        keys=["insurer_name", "wind_risk_band", "building_type"], distinct=True,
    )


@query(
    "mart_risk_band_performance",
    _policy_sql(
        "wind_risk_band, region_name",
        "current_claims",
        f"""CAST(coalesce(sum(n), 0) AS DOUBLE) / count(DISTINCT p.policy_id) AS claim_frequency,
        CASE WHEN sum(premium) > 0 THEN {coarse_ratio('coalesce(sum(inc), 0)', 'sum(premium)')} END AS loss_ratio""",
    ),
)
def risk_band_performance(spark, folder):
    return marts.risk_band_performance(t.silver_premiums(spark, folder), t.current_claims(spark, folder))


# ---- event losses ----

EVENT_MEASURES = f"""{money('sum(incurred)')} AS total_incurred,
  {mean('sum(incurred)', 'count(incurred)')} AS avg_claim_severity, {money('max(incurred)')} AS max_claim_severity,
  {money('sum(paid)')} AS total_paid, {money('sum(incurred - paid)')} AS outstanding_reserve"""
STATUS_COUNTS = ", ".join(f"count(*) FILTER (claim_status = '{s}') AS {s.lower()}_claims" for s in ("Open", "Closed", "Reopened"))


def _event_sql(claims: str, extra_key: str, name: str, count: str, more: str) -> str:
    return with_silver(
        f"""SELECT CASE WHEN c.event_id IS NOT NULL THEN 'Catastrophe' ELSE 'Non-Catastrophe' END AS claim_category,
        {extra_key} {name} AS event_name, e.start_date AS event_start, e.end_date AS event_end,
        CAST(e.end_date - e.start_date AS INTEGER) AS event_duration_days, region_name, peril_type,
        {count} AS claim_count, {EVENT_MEASURES} {more}
        FROM {claims} c LEFT JOIN silver_events e ON c.event_id = e.event_id
        LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id GROUP BY ALL"""
    )


@query("mart_event_loss_summary", _event_sql("current_claims", "", "e.event_name", "count(c.claim_id)", ""))
def event_loss_summary(spark, folder):
    return marts.event_loss_summary(
        t.current_claims(spark, folder), t.silver_events(spark, folder), t.silver_premiums(spark, folder)
    )


@query(
    "mart_event_loss_summary_extended",
    _event_sql(
        "current_claims", "e.event_id,", "coalesce(e.event_name, 'Non-Catastrophe')", "count(c.claim_id)", ", " + STATUS_COUNTS
    ),
)
def event_loss_summary_extended(spark, folder):
    return marts.event_loss_summary(
        t.current_claims(spark, folder), t.silver_events(spark, folder), t.silver_premiums(spark, folder), extended=True
    )


@query(
    "mart_event_loss_summary_distinct",
    _event_sql("silver_claims", "", "e.event_name", "count(DISTINCT c.claim_id)", ""),
)
def _(spark, folder):
    return marts.event_loss_summary(
        t.silver_claims(spark, folder), t.silver_events(spark, folder), t.silver_premiums(spark, folder), distinct=True
    )


@query(
    "mart_event_losses",
    with_silver(
        f"""SELECT e.event_id, e.event_name, e.start_date, e.end_date, count(DISTINCT c.claim_id) AS claim_count,
        {money('sum(incurred)')} AS total_incurred, {money('sum(paid)')} AS total_paid, {STATUS_COUNTS}
        FROM current_claims c JOIN silver_events e ON c.event_id = e.event_id
        GROUP BY e.event_id, e.event_name, e.start_date, e.end_date"""
    ),
)
def event_losses(spark, folder):
    return marts.event_losses(t.current_claims(spark, folder), t.silver_events(spark, folder))


# ---- exposure and development ----


def _exposure_sql(join: str) -> str:
    return with_silver(
        f"""SELECT insurer_name, p.region_name, p.wind_risk_band, building_type, mitigation_flag,
        count(DISTINCT p.policy_id) AS policy_count, {money('sum(insured)')} AS total_sum_insured,
        {money('sum(premium)')} AS total_annual_premium, {mean('sum(insured)', 'count(insured)')} AS avg_sum_insured,
        {mean('sum(premium)', 'count(premium)')} AS avg_annual_premium,
        {percent('sum(premium)', 'sum(insured)', 4)} AS premium_rate_pct
        FROM silver_premiums p {join} GROUP BY ALL"""
    )


@query("mart_portfolio_exposure", _exposure_sql("JOIN silver_zones z ON p.postcode = z.postcode"))
def portfolio_exposure(spark, folder):
    # Customers are unique, and so are the policies made of them.
    return marts.portfolio_exposure(t.silver_premiums(spark, folder), t.silver_zones(spark, folder), unique_policies=True)


@query("mart_portfolio_exposure_counting_policies", _exposure_sql("JOIN silver_zones z ON p.postcode = z.postcode"))
def _(spark, folder):
    return marts.portfolio_exposure(t.silver_premiums(spark, folder), t.silver_zones(spark, folder))


@query("mart_portfolio_exposure_without_zones", _exposure_sql(""))
def _(spark, folder):
    return marts.portfolio_exposure(t.silver_premiums(spark, folder))


@query(
    "mart_portfolio_exposure_repeated_zones",
    _exposure_sql("JOIN raw_zones z ON p.postcode = z.postcode"),
)
def _(spark, folder):
    zones = typed_zones(t.raw_zones(spark, folder))
    return marts.portfolio_exposure(t.silver_premiums(spark, folder), zones, unique_policies=True)


def _development_sql(claims: str) -> str:
    return with_silver(
        f"""SELECT peril_type, region_name, wind_risk_band, CAST(date_trunc('month', date_of_loss) AS DATE) AS loss_month,
        CAST(date_trunc('month', reported_date) AS DATE) AS reported_month, count(c.claim_id) AS claim_count,
        {half_up('sum(reported_date - date_of_loss)', 'count(*)', 1)} AS avg_reporting_lag_days,
        CAST(max(reported_date - date_of_loss) AS INTEGER) AS max_reporting_lag_days,
        {money('sum(incurred)')} AS total_incurred, {money('sum(paid)')} AS total_paid,
        {money('sum(incurred - paid)')} AS outstanding_reserve,
        {percent('sum(paid)', 'sum(incurred)')} AS payment_progress_pct
        FROM {claims} c LEFT JOIN silver_premiums p ON c.policy_id = p.policy_id GROUP BY ALL"""
    )


@query("mart_claims_development", _development_sql("current_claims"))
def claims_development(spark, folder):
    return marts.claims_development(t.current_claims(spark, folder), t.silver_premiums(spark, folder))


@query("mart_claims_development_snapshots", _development_sql("silver_claims"))
def _(spark, folder):
    return marts.claims_development(t.silver_claims(spark, folder), t.silver_premiums(spark, folder))


@query(
    "total_by_key",
    with_silver(f"SELECT postcode, {money('sum(premium)')} AS total_premium FROM silver_premiums GROUP BY postcode"),
)
def _(spark, folder):
    policies = t.silver_premiums(spark, folder)
    return marts.total_by(policies, "postcode", "annual_premium", "total_premium")


# ---- marts kept up with changes ----

# Three batches: first doctored versions of most rows and rows that are withdrawn later, then true rows in two parts. What is
# true in the end is the silver tables, so the marts' own SQL holds.
HALF = "crc32(CAST({key} AS BINARY)) % 2"


def _claim_batches(spark, folder, root):
    order = F.struct("number", "snapshot_date").alias("at")
    claims = t.current_claims(spark, folder).select(*[c.strip() for c in "claim_id, policy_id, event_id, date_of_loss, reported_date, peril_type, claim_status, incurred_amount, paid_to_date, snapshot_date".split(",")])
    claims.write.parquet(f"{root}/landed")  # once, as the batches are made of the same claims
    claims = spark.read.schema(claims.schema).parquet(f"{root}/landed")
    true = claims.withColumn("number", F.expr(f"1 + {HALF.format(key='claim_id')}").cast("int")).select("*", order).drop("number")
    early = claims.withColumns(
        {
            "incurred_amount": (F.col("incurred_amount") * 3).cast("decimal(18,2)"), "claim_status": F.lit("Open"), "number": F.lit(0),
            "event_id": F.when(F.col("claim_id").endswith("1"), F.col("event_id")),
        }
    ).select("*", order).drop("number").where("NOT claim_id LIKE '%-3'")
    extra = early.where("claim_id LIKE '%-2'").withColumn("claim_id", F.concat(F.lit("X"), "claim_id"))
    withdrawn = extra.withColumns({"claim_status": F.lit("Withdrawn"), "at": F.struct(F.lit(2).alias("number"), "snapshot_date")})
    first = lambda number: true.where(F.col("at.number") == number)
    return early.unionByName(extra), first(1), first(2).unionByName(withdrawn)


def _dimension_batches(rows, key, doctored):
    """The doctored rows of all, then the true rows in two halves."""
    numbered = rows.withColumn("at", F.expr(f"1 + {HALF.format(key=f'CAST({key} AS STRING)')}").cast("int"))
    return rows.withColumns({**doctored, "at": F.lit(0)}), numbered.where("at = 1"), numbered.where("at = 2")


def _changing(spark, folder, name):
    """A mart after three batches of changes in every table it reads, taken in one by one."""
    root = work_path(spark, f"changing-{name}")
    mart = changing.MARTS[name]
    spec = lambda key, **more: Upsert((key,), "at", buckets=8, except_columns=("at",), **more)
    batches = {
        changing.CLAIMS: lambda: (spec("claim_id", deleted="claim_status = 'Withdrawn'"), _claim_batches(spark, folder, root)),
        changing.POLICIES: lambda: (spec("policy_id"), _dimension_batches(t.silver_premiums(spark, folder), "policy_id",
            {"region_name": F.lit("Nowhere"), "annual_premium": (F.col("annual_premium") + 1).cast("decimal(18,2)")})),
        changing.EVENTS: lambda: (spec("event_id"), _dimension_batches(t.silver_events(spark, folder), "event_id", {"event_name": F.lit("unnamed")})),
        changing.ZONES: lambda: (spec("postcode", deleted="region_name = 'gone'"), _dimension_batches(t.silver_zones(spark, folder), "postcode",
            {"region_name": F.when(F.col("postcode") % 3 == 0, "gone").otherwise(F.col("region_name"))})),
    }
    made = {table: batches[table]() for table in mart.tables}
    tables = {table: MergeTable(spark, f"{root}/{table}", layout) for table, (layout, _) in made.items()}
    kept = changing.ChangingMart(spark, f"{root}/mart", mart, tables, buckets=8)
    for number in range(3):
        for table, (_, parts) in made.items():
            tables[table].upsert(parts[number], number, "batches")
        kept.refresh()
    return kept.read()


for _name in (
    "claims_summary", "loss_ratio_by_risk", "policy_loss_ratio", "event_loss_summary_extended", "event_losses", "claims_development",
    "portfolio_exposure",
):
    query(f"changing_{_name}", SQL[f"mart_{_name}"])(lambda spark, folder, name=_name: _changing(spark, folder, name))
