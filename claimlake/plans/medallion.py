"""The claims medallion in batch: from raw bordereaux to marts, monitored; ``streamed`` has it over streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from claimlake.operators import marts, rulesets
from claimlake.operators.latest import claims_current, unique_zones
from claimlake.operators.monitor import Listed, inventory
from claimlake.operators.projection import stamp, typed_claims, typed_events, typed_premiums, typed_zones
from claimlake.operators.quality import (
    VERDICT, Rule, claims_quality, events_quality, judge, kept_of, premiums_quality, quarantine_of,
)
from claimlake.schemas import BATCH_AUDIT, ENTITIES, AuditColumns


def silver_tables(
    bronze: Mapping[str, DataFrame], audit: AuditColumns = BATCH_AUDIT, clock: Column | None = None
) -> dict[str, DataFrame]:
    """Silver from the four bronze tables, by entity name."""
    def stamped(df: DataFrame) -> DataFrame:
        return stamp(df, "silver_ingestion_timestamp", clock)

    return {
        "silver_claims_bordereau": stamped(claims_quality(typed_claims(bronze["claims"], audit))),
        "silver_premium_bordereau": stamped(premiums_quality(typed_premiums(bronze["premiums"], audit))),
        "silver_cyclone_events": stamped(events_quality(typed_events(bronze["cyclone_events"], audit))),
        "silver_risk_zone_lookup": stamped(unique_zones(typed_zones(bronze["risk_zones"], audit))),
    }


def gold_tables(
    claims: DataFrame,
    premiums: DataFrame,
    events: DataFrame,
    zones: DataFrame,
    *,
    development_claims: DataFrame | None = None,
    clock: Column | None = None,
) -> dict[str, DataFrame]:
    """The marts; ``claims`` are all snapshots or the current ones, development may take the other."""
    tables = {
        "gold_claims_summary": marts.claims_summary(claims, premiums),
        "gold_loss_ratio_by_risk": marts.loss_ratio_by_risk(premiums, claims),
        "gold_policy_loss_ratio": marts.policy_loss_ratio(premiums, claims),
        "gold_event_loss_summary": marts.event_loss_summary(claims, events, premiums),
        "gold_portfolio_exposure": marts.portfolio_exposure(premiums, zones),
        "gold_claims_development": marts.claims_development(claims if development_claims is None else development_claims, premiums),
        "gold_risk_band_performance": marts.risk_band_performance(premiums, claims),
    }
    return {name: stamp(df, "gold_ingestion_timestamp", clock) for name, df in tables.items()}


class TableFolders:
    """Parquet tables below one folder, each written once per run and then read back.

    A table written with rules lies there judged: its kept rows and its quarantine are partitions of it.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.names: list[str] = []
        self._judged: dict[str, T.StructType] = {}

    def write(self, name: str, df: DataFrame, rules: Sequence[Rule] = (), clock: Column | None = None) -> DataFrame:
        rows = judge(df, rules, clock) if rules else df
        writer = rows.write.mode("overwrite")
        if rules:
            writer = writer.partitionBy(VERDICT)
            self._judged[name] = rows.schema
            self.names.append(f"{name}_quarantine")
        writer.option("partitionOverwriteMode", "static").parquet(f"{self.root}/{name}")
        self.names.append(name)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        """A table, or its quarantine by ``<name>_quarantine``."""
        base = name.removesuffix("_quarantine")
        if base not in self._judged:
            return self.spark.read.parquet(f"{self.root}/{name}")
        # the schema is told: a parted folder without a row has no file to take it from
        judged = self.spark.read.schema(self._judged[base]).parquet(f"{self.root}/{base}")
        return kept_of(judged) if name == base else quarantine_of(judged)


def run_batch(
    bronze: Mapping[str, DataFrame], folders: TableFolders, *, current: bool = True, clock: Column | None = None
) -> DataFrame:
    """Write bronze, silver and gold and return the inventory of what was written.

    Every layer is written before the next reads it, so no later stage derives an earlier one again, and
    a lost executor costs at most the stage at work.
    """
    stored = {}
    for name, df in bronze.items():
        table = ENTITIES[name].table
        stored[name] = folders.write(f"bronze_{table}", df, rulesets.BRONZE[table], clock)
    silver = {name: folders.write(name, df) for name, df in silver_tables(stored, clock=clock).items()}
    snapshots = silver["silver_claims_bordereau"]
    silver["silver_claims_current"] = folders.write("silver_claims_current", claims_current(snapshots))
    write_gold(silver, folders, current=current, clock=clock)
    return inventory(listed_tables(folders))


def write_gold(silver: Mapping[str, DataFrame], folders: TableFolders, *, current: bool = True, clock: Column | None = None) -> None:
    """Write the marts of the silver tables, each with the quarantine its rules ask for."""
    snapshots = silver["silver_claims_bordereau"]
    gold = gold_tables(
        silver["silver_claims_current"] if current else snapshots,
        silver["silver_premium_bordereau"],
        silver["silver_cyclone_events"],
        silver["silver_risk_zone_lookup"],
        development_claims=snapshots,
        clock=clock,
    )
    for name, df in gold.items():
        folders.write(name, df, rulesets.GOLD.get(name.removeprefix("gold_"), ()), clock)


def listed_tables(folders: TableFolders) -> list[Listed]:
    """Every written table with its layer, ingest time and source file, where it has them."""
    listed = []
    for name in folders.names:
        df = folders.read(name)
        times = ("ingestion_timestamp", "_ingest_ts", "bronze_ingestion_timestamp")
        quarantine = name.endswith("_quarantine")
        listed.append(
            Listed(
                name.split("_", 1)[0],
                name,
                df,
                None if quarantine else next((c for c in times if c in df.columns), None),
                next((c for c in ("source_file_name", "_source_file") if c in df.columns and name.startswith("bronze")), None),
            )
        )
    return listed
