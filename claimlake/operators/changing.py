"""Marts kept up with changes of their tables, without a full run.

A mart is a table of totals by group, kept as a merge table of its own. A run takes the changes since the versions it last saw,
weighs a row that came with 1 and a row that went with -1, adds the weighed measures up per group and adds that to the totals.
Sums, counts and so means and ratios follow; a group without rows is deleted. A maximum grows with what comes; only in groups where
a value as great as the maximum left is it computed anew.

A claim that changes is joined with the policies and events as they are now. A policy or event that changes moves the claims
that named it before: their measures leave the old group and enter the new one. Only those claims are read for it,
added up per policy before the join, so one policy or event that holds many claims leaves each map task as a few rows.

The versions a run has seen are committed with its totals, so a run that is repeated after a crash counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions.ratios import mean, percent
from claimlake.operators import marts
from claimlake.sinks.merge_table import AFTER, CHANGE, COMMIT, INSERT, MergeTable
from claimlake.sinks.upsert import Upsert

WEIGHT = "_weight"
RUN = "_run"
TOTAL = "decimal(38,2)"
CLAIMS, POLICIES, EVENTS, ZONES = "claims", "policies", "events", "zones"
Tables = Mapping[str, DataFrame]

# Measures of a claim; a sum has the count of its values beside it, as a group without any has no sum.
COUNTS = {
    "n_rows": "TRUE",
    "n_claims": "claim_id IS NOT NULL",
    "n_incurred": "incurred_amount IS NOT NULL",
    "n_paid": "paid_to_date IS NOT NULL",
    "n_reserve": "incurred_amount - paid_to_date IS NOT NULL",
    "n_lags": "datediff(reported_date, date_of_loss) IS NOT NULL",
    "n_open": "claim_status <=> 'Open'",
    "n_closed": "claim_status <=> 'Closed'",
    "n_reopened": "claim_status <=> 'Reopened'",
}
SUMS = {"incurred": ("incurred_amount", "n_incurred"), "paid": ("paid_to_date", "n_paid"), "reserve": ("incurred_amount - paid_to_date", "n_reserve")}
LAG = ("datediff(reported_date, date_of_loss)", "n_lags")
MAXIMA = {"max_incurred": "incurred_amount", "max_lag": LAG[0]}


def weighed(changes: DataFrame) -> DataFrame:
    """Changes as rows that come (1) and go (-1)."""
    came = F.col(CHANGE).isin(INSERT, AFTER)
    return changes.withColumn(WEIGHT, F.when(came, 1).otherwise(-1)).drop(CHANGE, COMMIT)


def _whole(rows: DataFrame, weight: int = 1) -> DataFrame:
    return rows.withColumn(WEIGHT, F.lit(weight))


def claim_measures(claims: DataFrame, group: Sequence[str]) -> DataFrame:
    """Weighed measures per group, and the greatest values that came (``in_``) and went (``out_``)."""
    weight = F.col(WEIGHT)
    counts = [F.sum(F.when(F.expr(test), weight).otherwise(0)).alias(n) for n, test in COUNTS.items()]
    sums = [F.sum(weight * F.expr(value)).cast(TOTAL).alias(n) for n, (value, _) in SUMS.items()]
    days = F.sum(weight * F.expr(LAG[0])).alias("lag_days")
    ends = [F.max(F.when(test, F.expr(value))).alias(f"{side}_{n}") for n, value in MAXIMA.items() for side, test in (("in", weight > 0), ("out", weight < 0))]
    return claims.groupBy(*group).agg(*counts, *sums, days, *ends)


def policy_measures(policies: DataFrame, group: Sequence[str]) -> DataFrame:
    weight = F.col(WEIGHT)
    return policies.groupBy(*group).agg(
        F.sum(weight).alias("n_policies"),
        *[F.sum(F.when(F.col(c).isNotNull(), weight).otherwise(0)).alias(f"n_{c}") for c in ("sum_insured", "annual_premium")],
        *[F.sum(weight * F.col(c)).cast(TOTAL).alias(c) for c in ("sum_insured", "annual_premium")],
    )


@dataclass(frozen=True)
class Mart:
    """A mart by what it adds up.

    ``of_claims`` and ``of_policies`` give weighed measures from claims or policies that carry weights and the other tables as
    they stand; both are linear in the weights. ``members`` is the measure that is 0 when a group is gone. ``uses`` names, per
    joined table, its key and the columns that matter here: other changes of it move nothing. Only the ``maxima`` that ``finish``
    reads are kept, as the claims are read anew where one is lost.
    """

    keys: tuple[str, ...]
    members: str
    finish: Callable[[DataFrame], DataFrame]
    of_claims: Callable[[DataFrame, Tables], DataFrame] | None = None
    of_policies: Callable[[DataFrame, Tables], DataFrame] | None = None
    uses: Mapping[str, tuple[str, ...]] = None
    idle_premium: bool = False  # policies without any claim count their premium once
    maxima: tuple[str, ...] = ()

    @property
    def tables(self) -> tuple[str, ...]:
        own = [CLAIMS] if self.of_claims else []
        return tuple(dict.fromkeys([*own, *([POLICIES] if self.of_policies else []), *(self.uses or {})]))


def _grouped_by_policy(attributes: Sequence[str], of_claim: Sequence[str], how: str = "left") -> Callable[[DataFrame, Tables], DataFrame]:
    def of_claims(claims: DataFrame, tables: Tables) -> DataFrame:
        return claim_measures(claims, ["policy_id", *of_claim]).join(tables[POLICIES].select("policy_id", *attributes), "policy_id", how)

    return of_claims


def _dated(claims: DataFrame) -> DataFrame:
    months = {"loss_month": "date_of_loss", "reported_month": "reported_date"}
    return claims.withColumns({name: F.date_trunc("month", F.col(day)) for name, day in months.items()})


def _development(claims: DataFrame, tables: Tables) -> DataFrame:
    return _grouped_by_policy(["region_name", "wind_risk_band"], ["peril_type", "loss_month", "reported_month"])(_dated(claims), tables)


def _named_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("known_event_id"), "event_name", F.col("start_date").alias("event_start"), F.col("end_date").alias("event_end")
    )


def _event_totals(claims: DataFrame, tables: Tables) -> DataFrame:
    placed = _grouped_by_policy(["region_name"], ["event_id", "peril_type"])(claims, tables)
    combined = _added(placed, ["event_id", "region_name", "peril_type"])
    named = _named_events(tables[EVENTS])
    category = F.when(F.col("event_id").isNotNull(), "Catastrophe").otherwise(marts.NO_EVENT)
    joined = combined.join(named, combined.event_id == named.known_event_id, "left").withColumn("claim_category", category)
    return joined.withColumn("event_duration_days", F.datediff("event_end", "event_start"))


def _event_losses(claims: DataFrame, tables: Tables) -> DataFrame:
    events = tables[EVENTS].select("event_id", "event_name", "start_date", "end_date")
    return claim_measures(claims.where("event_id IS NOT NULL"), ["event_id"]).join(events, "event_id")


def _claim_rows(keys: Sequence[str]) -> Callable[[DataFrame, Tables], DataFrame]:
    """Claims of known policies by the policy's attributes, and the premium counted once for each of them."""

    def of_claims(claims: DataFrame, tables: Tables) -> DataFrame:
        joined = claim_measures(claims, ["policy_id"]).join(tables[POLICIES].select("policy_id", "annual_premium", *keys), "policy_id")
        return joined.withColumn("premium_rows", (F.col("n_rows") * F.col("annual_premium")).cast(TOTAL)).drop("annual_premium")

    return of_claims


def _in_zones(policies: DataFrame, tables: Tables) -> DataFrame:
    per_postcode = policy_measures(policies, [*marts.RISK_KEYS, "postcode"])
    return per_postcode.join(tables[ZONES].select("postcode"), "postcode")


def _totals(state: DataFrame) -> DataFrame:
    """Totals under the names the ratios are made from."""
    return state.select(
        "*",
        F.col("n_policies").alias("policy_count"),
        _valued("annual_premium").alias("total_premium"),
        F.col("n_claims").alias("claim_count"),
        F.col("incurred").alias("total_incurred"),
        F.col("paid").alias("total_paid"),
    )


def _valued(name: str) -> Column:
    """A sum of policies' values, NULL where none has one."""
    return F.when(F.col(f"n_{name}") > 0, F.col(name))


def _by_risk(state: DataFrame) -> DataFrame:
    premium = F.when(F.col("n_annual_premium") > 0, F.col("premium_rows") + F.col("idle_premium")).cast("decimal(28,2)")
    incurred = F.col("incurred").cast("decimal(28,2)")
    return state.select(
        *marts.RISK_KEYS,
        F.col("n_policies").alias("policy_count"),
        premium.alias("total_premium"),
        F.col("n_claims").alias("claim_count"),
        incurred.alias("total_incurred"),
        percent(incurred, premium).alias("loss_ratio_pct"),
    )


def _losses(state: DataFrame) -> DataFrame:
    return state.select(
        "event_id", "event_name", "start_date", "end_date",
        F.col("n_claims").alias("claim_count"),
        F.when(F.col("n_incurred") > 0, F.col("incurred")).cast("decimal(28,2)").alias("total_incurred"),
        F.when(F.col("n_paid") > 0, F.col("paid")).cast("decimal(28,2)").alias("total_paid"),
        *[F.col(f"n_{s}").alias(f"{s}_claims") for s in ("open", "closed", "reopened")],
    )


def _exposure(state: DataFrame) -> DataFrame:
    insured, premium = _valued("sum_insured").cast("decimal(28,2)"), _valued("annual_premium").cast("decimal(28,2)")
    return state.select(
        *marts.RISK_KEYS,
        F.col("n_policies").alias("policy_count"),
        insured.alias("total_sum_insured"),
        premium.alias("total_annual_premium"),
        mean(insured, F.col("n_sum_insured")).alias("avg_sum_insured"),
        mean(premium, F.col("n_annual_premium")).alias("avg_annual_premium"),
        percent(premium, insured, 4).alias("premium_rate_pct"),
    )


def _with_nulls(state: DataFrame) -> DataFrame:
    """Claim totals as the marts expect them: a sum without values is NULL."""
    return state.withColumns({n: F.when(F.col(count) > 0, F.col(n)) for n, (_, count) in SUMS.items()} | {"lag_days": F.when(F.col("n_lags") > 0, F.col("lag_days"))})


_RISK_POLICIES = ("policy_id", "annual_premium", *marts.RISK_KEYS)
_EVENT_KEYS = ("claim_category", "known_event_id", "event_name", "event_start", "event_end", "event_duration_days", "region_name", "peril_type")
_EVENT_USES = {POLICIES: ("policy_id", "region_name"), EVENTS: ("event_id", "event_name", "start_date", "end_date")}

MARTS = {
    "claims_summary": Mart(
        ("peril_type", "claim_status", "region_name", "wind_risk_band", "building_type"), "n_rows",
        lambda s: marts.claims_summary_of(_with_nulls(s)),
        of_claims=_grouped_by_policy(["region_name", "wind_risk_band", "building_type"], ["peril_type", "claim_status"]),
        uses={POLICIES: ("policy_id", "region_name", "wind_risk_band", "building_type")},
    ),
    "loss_ratio_by_risk": Mart(
        marts.RISK_KEYS, "n_policies", _by_risk, of_claims=_claim_rows(marts.RISK_KEYS),
        of_policies=lambda p, t: policy_measures(p, marts.RISK_KEYS), uses={POLICIES: _RISK_POLICIES}, idle_premium=True,
    ),
    "policy_loss_ratio": Mart(
        marts.RISK_KEYS, "n_policies", lambda s: marts.policy_ratios_of(_totals(s), marts.RISK_KEYS),
        of_claims=_claim_rows(marts.RISK_KEYS), of_policies=lambda p, t: policy_measures(p, marts.RISK_KEYS), uses={POLICIES: _RISK_POLICIES},
    ),
    "risk_band_performance": Mart(
        marts.BAND_KEYS, "n_policies", lambda s: marts.risk_bands_of(_totals(s)), of_claims=_claim_rows(marts.BAND_KEYS),
        of_policies=lambda p, t: policy_measures(p, marts.BAND_KEYS), uses={POLICIES: ("policy_id", "annual_premium", *marts.BAND_KEYS)},
    ),
    "event_loss_summary": Mart(
        _EVENT_KEYS, "n_rows", lambda s: marts.event_summary_of(_with_nulls(s)), of_claims=_event_totals, uses=_EVENT_USES,
        maxima=("max_incurred",),
    ),
    "event_loss_summary_extended": Mart(
        _EVENT_KEYS, "n_rows", lambda s: marts.event_summary_of(_with_nulls(s).withColumn("event_id", F.lit(None)), True),
        of_claims=_event_totals, uses=_EVENT_USES, maxima=("max_incurred",),
    ),
    "event_losses": Mart(
        ("event_id", "event_name", "start_date", "end_date"), "n_rows", _losses, of_claims=_event_losses, uses={EVENTS: _EVENT_USES[EVENTS]}
    ),
    "portfolio_exposure": Mart(
        marts.RISK_KEYS, "n_policies", _exposure, of_policies=_in_zones, uses={ZONES: ("postcode",)}
    ),
    "portfolio_exposure_without_zones": Mart(
        marts.RISK_KEYS, "n_policies", _exposure, of_policies=lambda p, t: policy_measures(p, marts.RISK_KEYS)
    ),
    "claims_development": Mart(
        ("peril_type", "region_name", "wind_risk_band", "loss_month", "reported_month"), "n_rows",
        lambda s: marts.development_of(_with_nulls(s)), of_claims=_development, uses={POLICIES: ("policy_id", "region_name", "wind_risk_band")},
        maxima=("max_lag",),
    ),
}


def _added(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Measures of finer groups added up; those a part lacks are 0."""
    rest = {c: kind for c, kind in parts.dtypes if c in MEASURES}
    adders = [(F.max(c) if c.startswith(("in_", "out_")) else F.coalesce(F.sum(c), F.lit(0)).cast(kind)).alias(c) for c, kind in rest.items()]
    return parts.groupBy(*keys).agg(*adders)


MEASURES = {
    *COUNTS, *SUMS, "lag_days", "n_policies", "n_sum_insured", "n_annual_premium", "sum_insured", "annual_premium", "premium_rows", "idle_premium",
    *[f"{side}_{n}" for n in MAXIMA for side in ("in", "out")],
}


class ChangingMart:
    """One mart below a folder, over merge tables of claims, policies, events and zones; keys of the last three are unique."""

    def __init__(self, spark: SparkSession, root: str, mart: Mart, tables: Mapping[str, MergeTable], buckets: int = 16) -> None:
        self.spark, self.mart = spark, mart
        self.tables = {name: tables[name] for name in mart.tables}
        spec = Upsert(mart.keys, RUN, buckets=buckets, except_columns=(RUN,), deleted=f"{mart.members} = 0")
        self.state = MergeTable(spark, root, spec)
        self._held: list[DataFrame] = []
        self._standing: set[str] = set()  # tables that a run before has seen

    def read(self) -> DataFrame:
        return self.mart.finish(self.state.read())

    def refresh(self) -> bool:
        """Take in what has changed since the last run; whether there was anything."""
        noted = self.state.manifest().streams.get("changes", {"batch": 0, "counters": {}})
        seen = {name: noted["counters"].get(name, 0) for name in self.tables}
        now = {name: table.manifest().version for name, table in self.tables.items()}
        if seen == now:
            return False
        if missing := [name for name, version in now.items() if version == 0]:
            raise ValueError(f"tables without a version: {missing}")
        new = {name: table.read(now[name]) for name, table in self.tables.items()}
        old = {name: table.read(seen[name]) if seen[name] else new[name].where("FALSE") for name, table in self.tables.items()}
        changes = {
            name: (weighed(table.changes(seen[name], now[name])) if seen[name] else _whole(new[name]))
            for name, table in self.tables.items()
            if seen[name] != now[name]
        }
        changes = {name: self._kept(frame) for name, frame in changes.items()}
        run, self._standing = noted["batch"] + 1, {name for name, version in seen.items() if version}
        try:
            unread = [f"{side}_{n}" for n in MAXIMA if n not in self.mart.maxima for side in ("in", "out")]
            delta = self._kept(_added(self._delta(old, new, changes), self.mart.keys).drop(*unread))
            totals = self._totals(delta, new).withColumn(RUN, F.lit(run))
            self.state.upsert(totals, run, "changes", lambda: now)
            self.state.compact(at_least=8)
        finally:
            for frame in self._held:
                frame.unpersist()
            self._held.clear()
        return True

    def _kept(self, frame: DataFrame) -> DataFrame:
        """Held until the run ends, as several parts of it read the frame."""
        self._held.append(frame.persist())
        return self._held[-1]

    def _delta(self, old: Tables, new: Tables, changes: Tables) -> DataFrame:
        """Weighed measures of everything that moved: changed rows by the tables as they are now, older rows by what joined tables changed."""
        mart, parts = self.mart, []
        for name, build in ((CLAIMS, mart.of_claims), (POLICIES, mart.of_policies)):
            if build is None:
                continue
            if name in changes:
                parts.append(build(changes[name], new))
            joined = [(table, columns) for table, columns in (mart.uses or {}).items() if table in changes and table != name]
            if joined and name in self._standing:
                moved = self._kept(self._naming(old[name], [(_moved(changes[table], columns), columns[0]) for table, columns in joined]))
                parts += [build(_whole(moved, -1), old), build(_whole(moved), new)]
        if mart.idle_premium:
            parts += self._idle(old, new, changes)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    @staticmethod
    def _naming(rows: DataFrame, touched: Sequence[tuple[DataFrame, str]]) -> DataFrame:
        """Rows that name a touched key of any of the tables."""
        flags = []
        for number, (keys, key) in enumerate(touched):
            flag = f"_touched_{number}"
            named = keys.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
            rows = rows.join(named, key, "left")
            flags.append(F.coalesce(F.col(flag), F.lit(False)))
        return rows.where(reduce(Column.__or__, flags)).drop(*[f"_touched_{n}" for n in range(len(touched))])

    def _idle(self, old: Tables, new: Tables, changes: Tables) -> list[DataFrame]:
        """Premium of policies without a claim, of those policies that changed or whose claims did.

        Claims are counted as they were; what came and went since then tells how many there are now.
        """
        parts = []
        touched = reduce(DataFrame.unionByName, [changes[n].select("policy_id") for n in (CLAIMS, POLICIES) if n in changes]).distinct()
        counted = touched.withColumns({"_before": F.lit(0), "_since": F.lit(0)})
        if CLAIMS in self._standing:
            counted = counted.drop("_before").join(old[CLAIMS].groupBy("policy_id").agg(F.count(F.lit(1)).alias("_before")), "policy_id", "left")
        if CLAIMS in changes:
            counted = counted.drop("_since").join(changes[CLAIMS].groupBy("policy_id").agg(F.sum(WEIGHT).alias("_since")), "policy_id", "left")
        before, since = (F.coalesce(n, F.lit(0)) for n in ("_before", "_since"))
        counted = self._kept(counted.select("policy_id", before.alias("_before"), (before + since).alias("_now")))
        for tables, weight, claims in ((old, -1, "_before"), (new, 1, "_now")) if CLAIMS in self._standing else ((new, 1, "_now"),):
            idle = tables[POLICIES].join(counted.where(F.col(claims) == 0), "policy_id", "left_semi")
            premium = F.sum(F.lit(weight) * F.col("annual_premium")).cast(TOTAL).alias("idle_premium")
            parts.append(idle.groupBy(*self.mart.keys).agg(premium))
        return parts

    def _totals(self, delta: DataFrame, new: Tables) -> DataFrame:
        """The totals of the groups that moved, as they are now."""
        keys = self.mart.keys
        moved = [c for c in delta.columns if c in MEASURES and not c.startswith(("in_", "out_"))]
        if not self.state.manifest().version:
            return delta.select(*keys, *moved, *[F.col(f"in_{n}").alias(n) for n in MAXIMA if f"in_{n}" in delta.columns])
        state = self.state.read()
        kinds = dict(state.dtypes)
        measures, maxima = [c for c in state.columns if c in MEASURES], [n for n in MAXIMA if n in kinds]
        # A run that changed some of the tables only has nothing to add to the measures of the others.
        still = {c: F.lit(0) for c in measures if c not in moved}
        still |= {f"{side}_{n}": F.lit(None).cast(kinds[n]) for n in maxima for side in ("in", "out") if f"in_{n}" not in delta.columns}
        joined = delta.withColumns(still).join(self._renamed(state), _equal(keys), "left")
        # What went may have come in the same run, with a policy or event that moved, so it counts against both.
        left = reduce(Column.__or__, [F.col(f"out_{n}") >= F.greatest(f"_old_{n}", f"in_{n}") for n in maxima], F.lit(False))
        joined = joined.withColumn("_left", F.coalesce(left, F.lit(False)))
        sums = [(F.coalesce(f"_old_{c}", F.lit(0)) + F.col(c)).cast(kinds[c]).alias(c) for c in measures]
        grown = self._kept(joined.select(*keys, *sums, *[F.greatest(f"_old_{n}", f"in_{n}").alias(n) for n in maxima], "_left"))
        if not maxima or grown.where("_left").isEmpty():
            return grown.drop("_left")
        lost = self._renamed(grown.where("_left").select(*keys))
        fresh = self.mart.of_claims(_whole(new[CLAIMS]), new)
        fresh = self._renamed(_added(fresh.join(lost, _equal(keys), "left_semi"), keys).select(*keys, *[F.col(f"in_{n}").alias(n) for n in maxima]))
        exact = grown.where("_left").drop(*maxima).join(fresh, _equal(keys), "left")
        exact = exact.select(*keys, *measures, *[F.col(f"_old_{n}").alias(n) for n in maxima])
        return grown.where("NOT _left").drop("_left").unionByName(exact)

    @staticmethod
    def _renamed(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"_old_{c}") for c in rows.columns])


def _equal(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])


def _moved(changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys of joined rows that changed in one of ``columns``."""
    return changes.groupBy(*columns).agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0)
