"""The claims medallion over streams: bronze and silver take what is new, current claims are merged, marts follow.

A run goes layer by layer, each until nothing is left, and may be repeated at any time:

* bronze: landed rows are judged once and appended to one folder a table, parted by verdict, which is the table and its quarantine;
* silver: new bronze rows that were kept are typed, filtered and appended; an input row appears once, however often a run fails;
* current claims: new silver rows are merged by claim into a type-1 table, whose readers see whole versions;
* zones and marts: computed from silver as it stands, like views that are refreshed, so they do not depend on how rows arrived.

Every flow has a checkpoint below the root, so a new process goes on where the last one ended, and after any number of runs the
tables are those that ``run_batch`` writes from all rows at once. One run at a time may work on a root.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimlake.operators import rulesets
from claimlake.operators.latest import unique_zones
from claimlake.operators.monitor import inventory
from claimlake.operators.projection import stamp, typed_claims, typed_events, typed_premiums, typed_zones
from claimlake.operators.quality import VERDICT, claims_quality, events_quality, judge, kept_of, premiums_quality, quarantine_of
from claimlake.plans.medallion import TableFolders, listed_tables, write_gold
from claimlake.schemas import BATCH_AUDIT, ENTITIES, AuditColumns
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert
from claimlake.sources.paths import exists
from claimlake.sources.tables import stream_folder
from claimlake.streaming.runs import append_to_folder, finish, merge_stream

CURRENT = "silver_claims_current"
APPENDED = {
    "claims": lambda bronze, audit: claims_quality(typed_claims(bronze, audit)),
    "premiums": lambda bronze, audit: premiums_quality(typed_premiums(bronze, audit)),
    "cyclone_events": lambda bronze, audit: events_quality(typed_events(bronze, audit)),
}


class StreamedTables(TableFolders):
    """Tables below one root, which all executors must reach: appended by streams, merged, or written whole.

    ``buckets`` is the number of parts that current claims are laid out in. It stays with the table, so choose it for the size
    the table will have: a part is what one compaction task rewrites.
    """

    def __init__(self, spark: SparkSession, root: str, *, buckets: int = 64) -> None:
        super().__init__(spark, root)
        self.current = MergeTable(spark, f"{self.root}/{CURRENT}", Upsert(("claim_id",), "snapshot_date", buckets))
        self.schemas: dict[str, T.StructType] = {}

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def append(self, name: str, stream: DataFrame, parted: tuple[str, ...] = (), trigger: Mapping | None = None) -> StreamingQuery:
        """Start a flow into a table."""
        self.schemas[name] = stream.schema
        return append_to_folder(stream, f"{self.root}/{name}", self.checkpoint(name), trigger=trigger, partition_by=parted)

    def new_rows(self, name: str) -> DataFrame | None:
        """A table's rows as a stream, without those that were judged hard; None as long as nothing was written."""
        path = f"{self.root}/{name}"
        if not exists(self.spark, path):
            return None
        rows = stream_folder(self.spark, path, self.schemas[name])
        return kept_of(rows) if VERDICT in rows.columns else rows

    def read(self, name: str) -> DataFrame:
        base = name.removesuffix("_quarantine")
        schema = self.schemas.get(base)
        if base == CURRENT and self.current.versions():
            return self.current.read()
        if schema is None:
            return super().read(name)
        path = f"{self.root}/{base}"
        found = base != CURRENT and exists(self.spark, path)
        # the schema is told, as a table without a row has no file to take it from
        rows = self.spark.read.schema(schema).parquet(path) if found else self.spark.createDataFrame([], schema)
        if VERDICT not in rows.columns:
            return rows
        return kept_of(rows) if name == base else quarantine_of(rows)


def run_streamed(
    landing: Mapping[str, DataFrame],
    tables: StreamedTables,
    *,
    current: bool = True,
    audit: AuditColumns = BATCH_AUDIT,
    clock: Column | None = None,
    batch: Mapping | None = None,
    compact_after: int = 32,
) -> DataFrame:
    """Take in what has landed since the last run and return the inventory.

    ``landing`` has the raw stream of each of the four entities. ``batch`` is the trigger of a layer and must be one that ends
    (all that is there, in as many batches as the streams' own limits make, by default).
    """
    missing = ENTITIES.keys() - landing.keys()
    if missing:
        raise ValueError(f"no stream for {', '.join(sorted(missing))}")
    tables.names.clear()
    bronze = {name: f"bronze_{ENTITIES[name].table}" for name in landing}
    _finish_all(
        [
            tables.append(table, judge(landing[name], rulesets.BRONZE[ENTITIES[name].table], clock), (VERDICT,), batch)
            for name, table in bronze.items()
        ]
    )
    for table in bronze.values():
        tables.names += [f"{table}_quarantine", table]

    silver, flows = {}, []
    for name, typed in APPENDED.items():
        table = silver[name] = f"silver_{ENTITIES[name].table}"
        stamped = lambda rows, typed=typed: stamp(typed(rows, audit), "silver_ingestion_timestamp", clock)
        tables.schemas[table] = stamped(tables.read(bronze[name])).schema
        rows = tables.new_rows(bronze[name])
        if rows is not None:
            flows.append(tables.append(table, stamped(rows), trigger=batch))
    _finish_all(flows)

    tables.schemas[CURRENT] = tables.schemas[silver["claims"]]
    rows = tables.new_rows(silver["claims"])
    if rows is not None:
        finish(merge_stream(rows, tables.current, tables.checkpoint(CURRENT), trigger=batch, compact_after=compact_after))
    zones = stamp(unique_zones(typed_zones(tables.read(bronze["risk_zones"]), audit)), "silver_ingestion_timestamp", clock)
    tables.write(f"silver_{ENTITIES['risk_zones'].table}", zones)
    tables.names += [*silver.values(), CURRENT]
    write_gold({n: tables.read(n) for n in tables.names if n.startswith("silver_")}, tables, current=current, clock=clock)
    return inventory(listed_tables(tables))


def _finish_all(flows: list[StreamingQuery]) -> None:
    """Wait for flows that run side by side; if one fails, the others are stopped and its failure is raised."""
    try:
        for flow in flows:
            finish(flow)
    finally:
        for flow in flows:
            flow.stop()
