"""Actuarial marts.

Every mart first reduces claims to sub-totals per policy (and the claim attributes it groups by), then
joins the policies, then adds the sub-totals up. The first step combines on the map side, so one policy,
one event or the NULL key holding a large share of the claims never reaches a join as more than a few
rows, and the joins are left to adaptive execution, which broadcasts a side only when its measured size
allows it.

``distinct=True`` counts distinct claim ids, for inputs with several rows per claim; on one row per claim
(the current claims) the plain count is equal and needs no second grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions.ratios import guarded, mean, money_total, percent

RISK_KEYS = ("insurer_name", "region_name", "wind_risk_band", "building_type", "mitigation_flag")
NO_EVENT = "Non-Catastrophe"


SUBTOTALS = {
    "n_rows": "count(1)",
    "n_claims": "count(claim_id)",
    "n_incurred": "count(incurred_amount)",
    "incurred": "sum(incurred_amount)",
    "paid": "sum(paid_to_date)",
    "reserve": "sum(incurred_amount - paid_to_date)",
    "max_incurred": "max(incurred_amount)",
    "n_lags": "count(datediff(reported_date, date_of_loss))",
    "lag_days": "sum(datediff(reported_date, date_of_loss))",
    "max_lag": "max(datediff(reported_date, date_of_loss))",
    "n_open": "count_if(claim_status = 'Open')",
    "n_closed": "count_if(claim_status = 'Closed')",
    "n_reopened": "count_if(claim_status = 'Reopened')",
}
MAXIMA = ("max_incurred", "max_lag")


def claim_subtotals(claims: DataFrame, keys: Sequence[str], distinct: bool = False) -> DataFrame:
    """Additive claim measures per key; with ``distinct`` the claim id joins the key to be counted later.

    A mart uses a few of them; the optimizer prunes the rest.
    """
    keys = [*keys, "claim_id"] if distinct else list(keys)
    return claims.groupBy(*keys).agg(*[F.expr(f"{measure} AS {name}") for name, measure in SUBTOTALS.items()])


def _merge_subtotals(subtotals: DataFrame, keys: Sequence[str], distinct: bool) -> DataFrame:
    """Add sub-totals up to coarser keys, leaving them sub-totals."""
    keys = [*keys, "claim_id"] if distinct else list(keys)
    adders = [F.expr(f"{'max' if name in MAXIMA else 'sum'}({name}) AS {name}") for name in SUBTOTALS]
    return subtotals.groupBy(*keys).agg(*adders)


def _claim_count(distinct: bool) -> Column:
    counted = F.count_distinct("claim_id") if distinct else F.sum("n_claims")
    return counted.alias("claim_count")


def _with_policy(subtotals: DataFrame, policies: DataFrame, attributes: Sequence[str]) -> DataFrame:
    return subtotals.join(policies.select("policy_id", *attributes), "policy_id", "left")


def _money_columns() -> list[Column]:
    return [
        money_total(F.col("incurred")).alias("total_incurred"),
        money_total(F.col("paid")).alias("total_paid"),
        money_total(F.col("reserve")).alias("outstanding_reserve"),
    ]


def _severity() -> Column:
    return mean(money_total(F.col("incurred")), F.sum("n_incurred"))


def _paid_share() -> Column:
    return percent(money_total(F.col("paid")), money_total(F.col("incurred")))


def claims_summary(claims: DataFrame, policies: DataFrame, *, distinct: bool = False) -> DataFrame:
    """Frequency, severity and settlement by peril, status and policy risk; orphans keep NULL risk."""
    by_policy = claim_subtotals(claims, ["policy_id", "peril_type", "claim_status"], distinct)
    return claims_summary_of(_with_policy(by_policy, policies, ["region_name", "wind_risk_band", "building_type"]), distinct)


def claims_summary_of(joined: DataFrame, distinct: bool = False) -> DataFrame:
    """The mart from sub-totals that have their policy's attributes."""
    return joined.groupBy("peril_type", "claim_status", "region_name", "wind_risk_band", "building_type").agg(
        _claim_count(distinct),
        *_money_columns(),
        _severity().alias("avg_claim_severity"),
        _paid_share().alias("settlement_pct"),
    )


def loss_ratio_by_risk(
    policies: DataFrame, claims: DataFrame, *, keys: Sequence[str] = RISK_KEYS
) -> DataFrame:
    """Loss ratio where a policy's premium counts once per claim row, as a raw left join gives it.

    The repetition is a multiplication by the policy's row count, so nothing fans out.
    """
    per_policy = claim_subtotals(claims, ["policy_id"]).select("policy_id", "n_rows", "n_claims", "incurred")
    repeats = F.greatest(F.coalesce("n_rows", F.lit(0)), F.lit(1))
    premium = money_total(F.col("annual_premium") * repeats)
    incurred = F.coalesce(money_total(F.col("incurred")), F.lit(0))
    return (
        policies.select("policy_id", "annual_premium", *keys)
        .join(per_policy, "policy_id", "left")
        .groupBy(*keys)
        .agg(
            F.count_distinct("policy_id").alias("policy_count"),
            premium.alias("total_premium"),
            F.coalesce(F.sum("n_claims"), F.lit(0)).alias("claim_count"),
            incurred.alias("total_incurred"),
            percent(incurred, premium).alias("loss_ratio_pct"),
        )
    )


def _policy_level(
    policies: DataFrame, claims: DataFrame, keys: Sequence[str], distinct: bool
) -> DataFrame:
    """Premium and claims by ``keys`` with claims added up per policy before the join."""
    per_policy = claim_subtotals(claims, ["policy_id"], distinct)
    if distinct:
        per_policy = per_policy.groupBy("policy_id").agg(
            F.count("claim_id").alias("n_claims"), F.sum("incurred").alias("incurred"), F.sum("paid").alias("paid")
        )
    per_policy = per_policy.select("policy_id", "n_claims", "incurred", "paid")
    return (
        policies.select("policy_id", "annual_premium", *keys)
        .join(per_policy, "policy_id", "left")
        .groupBy(*keys)
        .agg(
            F.count_distinct("policy_id").alias("policy_count"),
            F.sum("annual_premium").alias("total_premium"),
            F.coalesce(F.sum("n_claims"), F.lit(0)).alias("claim_count"),
            F.coalesce(F.sum("incurred"), F.lit(0)).alias("total_incurred"),
            F.coalesce(F.sum("paid"), F.lit(0)).alias("total_paid"),
        )
    )


def policy_loss_ratio(
    policies: DataFrame, claims: DataFrame, *, keys: Sequence[str] = RISK_KEYS, distinct: bool = False
) -> DataFrame:
    """Loss ratio with each premium counted once: the default reading."""
    return policy_ratios_of(_policy_level(policies, claims, keys, distinct), keys)


def policy_ratios_of(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Loss ratios from totals by ``keys``."""
    incurred, premium = F.col("total_incurred"), F.col("total_premium")
    return totals.select(
        *keys,
        "policy_count",
        "total_premium",
        "claim_count",
        "total_incurred",
        "total_paid",
        guarded(incurred, premium).alias("loss_ratio"),
        F.when(premium > 0, F.round(incurred / premium * 100, 2).cast("double")).alias("loss_ratio_pct"),
    )


def risk_band_performance(policies: DataFrame, claims: DataFrame, *, distinct: bool = False) -> DataFrame:
    """Claim frequency and loss ratio by risk band and region."""
    return risk_bands_of(_policy_level(policies, claims, BAND_KEYS, distinct))


BAND_KEYS = ("wind_risk_band", "region_name")


def risk_bands_of(totals: DataFrame) -> DataFrame:
    """Frequency and loss ratio from totals by risk band and region."""
    return totals.select(
        *BAND_KEYS,
        "policy_count",
        "total_premium",
        "claim_count",
        "total_incurred",
        guarded(F.col("claim_count"), F.col("policy_count"), 0.0).alias("claim_frequency"),
        guarded(F.col("total_incurred"), F.col("total_premium")).alias("loss_ratio"),
    )


def _event_totals(claims: DataFrame, policies: DataFrame, events: DataFrame, distinct: bool) -> DataFrame:
    """Sub-totals by event, region and peril with the event's attributes.

    Policies are joined first and the result is added up to (event, region, peril), so the event join
    sees one row per combination although one catastrophe, or no event at all, may hold most claims.
    """
    by_policy = claim_subtotals(claims, ["policy_id", "event_id", "peril_type"], distinct)
    placed = _with_policy(by_policy, policies, ["region_name"])
    combined = _merge_subtotals(placed, ["event_id", "region_name", "peril_type"], distinct)
    named = events.select(
        F.col("event_id").alias("known_event_id"),
        "event_name",
        F.col("start_date").alias("event_start"),
        F.col("end_date").alias("event_end"),
    )
    return (
        combined.join(named, combined.event_id == named.known_event_id, "left")
        .withColumn("claim_category", F.when(F.col("event_id").isNotNull(), "Catastrophe").otherwise(NO_EVENT))
        .withColumn("event_duration_days", F.datediff("event_end", "event_start"))
    )


def event_loss_summary(
    claims: DataFrame, events: DataFrame, policies: DataFrame, *, extended: bool = False, distinct: bool = False
) -> DataFrame:
    """Catastrophe and other losses by event, region and peril.

    The category follows from the claim naming an event, known or not. ``extended`` adds the known event
    id and the counts by status, and names claims without a known event.
    """
    return event_summary_of(_event_totals(claims, policies, events, distinct), extended, distinct)


def event_summary_of(totals: DataFrame, extended: bool = False, distinct: bool = False) -> DataFrame:
    """The mart from sub-totals that have their event's and region's attributes."""
    keys = ["claim_category", "event_name", "event_start", "event_end", "event_duration_days", "region_name", "peril_type"]
    status_counts: list[Column] = []
    if extended:
        totals = totals.withColumn("event_name", F.coalesce("event_name", F.lit(NO_EVENT))).drop("event_id")
        totals = totals.withColumnRenamed("known_event_id", "event_id")
        keys.insert(1, "event_id")
        status_counts = [F.sum(f"n_{s}").alias(f"{s}_claims") for s in ("open", "closed", "reopened")]
    incurred, paid, reserve = _money_columns()
    return totals.groupBy(*keys).agg(
        _claim_count(distinct),
        incurred,
        _severity().alias("avg_claim_severity"),
        F.max("max_incurred").alias("max_claim_severity"),
        paid,
        reserve,
        *status_counts,
    )


def event_losses(claims: DataFrame, events: DataFrame, *, distinct: bool = False) -> DataFrame:
    """Losses per known event; claims are added up per event before the inner join."""
    keys = ["event_id", "event_name", "start_date", "end_date"]
    per_event = claim_subtotals(claims.filter("event_id IS NOT NULL"), ["event_id"], distinct)
    if distinct:
        count = F.count("claim_id").alias("n_claims")
        sums = [F.sum(c).alias(c) for c in ("incurred", "paid", "n_open", "n_closed", "n_reopened")]
        per_event = per_event.groupBy("event_id").agg(count, *sums)
    known = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    claim_count = F.col("n_claims") if distinct else F.col("n_claims") * F.col("copies")
    return per_event.join(known, "event_id").select(
        *keys,
        claim_count.alias("claim_count"),
        (F.col("incurred") * F.col("copies")).cast("decimal(28,2)").alias("total_incurred"),
        (F.col("paid") * F.col("copies")).cast("decimal(28,2)").alias("total_paid"),
        *[(F.col(f"n_{s}") * F.col("copies")).alias(f"{s}_claims") for s in ("open", "closed", "reopened")],
    )


SALTS = 32  # parts a postcode's policies are dealt to; the zones, one row a postcode, are repeated so often


def portfolio_exposure(
    policies: DataFrame,
    zones: DataFrame | None = None,
    *,
    keys: Sequence[str] = RISK_KEYS,
    unique_policies: bool = False,
) -> DataFrame:
    """Sums insured and premium rate by risk; with ``zones`` only policies in a known postcode count.

    Zones are counted per postcode before the join. A postcode listed twice then weighs its policies
    twice without fanning out. ``unique_policies`` states that no policy id repeats, which lets the
    policies be added up per postcode before the join as well; otherwise a postcode's policies are dealt to
    ``SALTS`` parts, as a few postcodes hold most of them.
    """
    weight = F.lit(1) if zones is None else F.col("zone_rows")
    insured, premium = F.col("sum_insured"), F.col("annual_premium")
    if unique_policies:
        group = [*keys] if zones is None else [*keys, "postcode"]
        rows = policies.groupBy(*group).agg(
            F.count("policy_id").alias("n_policies"),
            F.count(insured).alias("n_insured"),
            F.count(premium).alias("n_premium"),
            F.sum(insured).alias("sum_insured"),
            F.sum(premium).alias("annual_premium"),
        )
        policy_count = F.sum("n_policies")
    else:
        rows = policies.select("policy_id", "postcode", "sum_insured", "annual_premium", *keys).withColumns(
            {"n_insured": F.when(insured.isNotNull(), 1).otherwise(0), "n_premium": F.when(premium.isNotNull(), 1).otherwise(0)}
        )
        policy_count = F.count_distinct("policy_id")
    if zones is not None:
        listed = zones.groupBy("postcode").agg(F.count(F.lit(1)).alias("zone_rows"))
        if unique_policies:
            rows = rows.join(listed, "postcode")
        else:
            salted = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            rows = rows.withColumn("_salt", F.pmod(F.xxhash64("policy_id"), F.lit(SALTS)).cast("int"))
            rows = rows.join(salted, ["postcode", "_salt"]).drop("_salt")
    total_insured = money_total(insured * weight)
    total_premium = money_total(premium * weight)
    return rows.groupBy(*keys).agg(
        policy_count.alias("policy_count"),
        total_insured.alias("total_sum_insured"),
        total_premium.alias("total_annual_premium"),
        mean(total_insured, F.sum(F.col("n_insured") * weight)).alias("avg_sum_insured"),
        mean(total_premium, F.sum(F.col("n_premium") * weight)).alias("avg_annual_premium"),
        percent(total_premium, total_insured, 4).alias("premium_rate_pct"),
    )


def claims_development(claims: DataFrame, policies: DataFrame, *, distinct: bool = False) -> DataFrame:
    """Reporting lag, reserve and payment progress by peril, place and the months of loss and report."""
    months = {"loss_month": "date_of_loss", "reported_month": "reported_date"}
    dated = claims.withColumns({name: F.date_trunc("month", F.col(day)) for name, day in months.items()})
    by_policy = claim_subtotals(dated, ["policy_id", "peril_type", "loss_month", "reported_month"], distinct)
    return development_of(_with_policy(by_policy, policies, ["region_name", "wind_risk_band"]), distinct)


def development_of(joined: DataFrame, distinct: bool = False) -> DataFrame:
    """The mart from dated sub-totals that have their policy's attributes."""
    return joined.groupBy("peril_type", "region_name", "wind_risk_band", "loss_month", "reported_month").agg(
        _claim_count(distinct),
        F.round(F.sum("lag_days") / F.nullif(F.sum("n_lags"), F.lit(0)), 1).alias("avg_reporting_lag_days"),
        F.max("max_lag").alias("max_reporting_lag_days"),
        *_money_columns(),
        _paid_share().alias("payment_progress_pct"),
    )


def total_by(df: DataFrame, key: str, measure: str, name: str) -> DataFrame:
    """One measure added up per key."""
    return df.groupBy(key).agg(F.sum(measure).alias(name))
