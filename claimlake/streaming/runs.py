"""Running streams: once over what is new, or continuously, into folders, tables and upserts."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from claimlake.operators.eventlog import RunLog, expectation_entries
from claimlake.operators.quality import Rule, clean_from_raw, quarantine_from_raw
from claimlake.sinks.merge_table import CHANGE, COMMIT, INSERT, MergeTable
from claimlake.sinks.upsert import Upsert, upsert

AVAILABLE_NOW = {"availableNow": True}


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream keeps in its checkpoint: the same after a restart, another one with a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a triggered run; its failure is raised."""
    query.awaitTermination()
    return query


def append_to_folder(
    stream: DataFrame, target: str, checkpoint: str, *, trigger: Mapping | None = None, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Append to a Parquet folder whose own log makes every input row appear exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start(target)


def append_to_table(stream: DataFrame, table: str, checkpoint: str, *, trigger: Mapping | None = None) -> StreamingQuery:
    """Append to a catalog table."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).toTable(table)


def continuously(seconds: float) -> dict[str, str]:
    """A trigger for runs that go on until the caller stops them."""
    return {"processingTime": f"{seconds} seconds"}


def upsert_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    spec: Upsert,
    *,
    trigger: Mapping | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge a stream into a type-1 table by key and sequence."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        identity = stream_identity(batch.sparkSession, checkpoint)
        upsert(prepare(batch) if prepare else batch, target, spec, batch_id, identity)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def merge_stream(
    stream: DataFrame,
    table: MergeTable,
    checkpoint: str,
    *,
    trigger: Mapping | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    compact_after: int = 32,
) -> StreamingQuery:
    """Commit every batch of a stream to a merge table; partitions with ``compact_after`` deltas are compacted in between."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        identity = stream_identity(batch.sparkSession, checkpoint)
        table.upsert(prepare(batch) if prepare else batch, batch_id, identity)
        table.compact(compact_after)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


Handler = Callable[[DataFrame, str, int], None]


def change_stream(
    table: MergeTable, checkpoint: str, handle: Handler, *, trigger: Mapping | None = None, versions_per_batch: int = 1000
) -> StreamingQuery:
    """Follow a merge table: its new versions, as a stream of its manifests, and what they changed.

    ``handle`` gets the changes of some consecutive versions, the identity of the stream and the last of the versions. After a
    failure the same versions come again. A stream that begins when older versions are gone first gets the oldest one left as
    inserts.
    """
    commits = table.spark.readStream.schema("version bigint").option("pathGlobFilter", "*.json")
    commits = commits.option("maxFilesPerTrigger", versions_per_batch).json(f"{table.root}/commits")

    def each(batch: DataFrame, batch_id: int) -> None:
        first, last = batch.agg(F.min("version"), F.max("version")).first()
        if first is None:
            return
        known = table.versions()
        if first - 1 in known or known[0] == 1:
            changes = table.changes(first - 1, last)
        else:
            changes = table.read(first).select(F.lit(INSERT).alias(CHANGE), F.lit(first).alias(COMMIT), "*")
            changes = changes.unionByName(table.changes(first, last), allowMissingColumns=True)
        handle(changes, stream_identity(table.spark, checkpoint), last)

    writer = commits.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def split_stream(
    raw: DataFrame, key: str, clean: str, quarantine: str, checkpoint: str, *, error: str = "_rescued_data",
    label: str | None = "rescued_data", trigger: Mapping | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two flows from one raw stream: rows with a key, and bad rows with their reasons.

    A rescued row that has its key goes to both. ``raw`` should read the raw table, so that the landing
    files are parsed once.
    """
    bad = quarantine_from_raw(raw, key, error=error, label=label)
    return (
        append_to_folder(clean_from_raw(raw, key), clean, f"{checkpoint}/clean", trigger=trigger),
        append_to_folder(bad, quarantine, f"{checkpoint}/quarantine", trigger=trigger),
    )


class ProgressTap(StreamingQueryListener):
    """Keeps every progress report of the streams of a session, however many batches they run.

    A query's own list of recent reports holds the last hundred only.
    """

    def __init__(self) -> None:
        self.reports: dict[str, list] = {}
        self.ended: dict[str, threading.Event] = {}

    @classmethod
    def attach(cls, spark: SparkSession) -> ProgressTap:
        tap = cls()
        spark.streams.addListener(tap)
        return tap

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        self.reports.setdefault(str(event.progress.runId), []).append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query: StreamingQuery, timeout: float = 60.0) -> list:
        """All reports of a run that has ended; they arrive a little later than its end."""
        run = str(query.runId)
        if not self._end(run).wait(timeout):
            raise TimeoutError(f"no end of stream {run} was reported")
        return self.reports.get(run, [])


def log_progress(
    query: StreamingQuery, log: RunLog, flow: str, rules: Sequence[Rule], observation: str, tap: ProgressTap | None = None
) -> None:
    """One log entry per micro-batch of a stream whose rules were observed under ``observation``.

    Without a ``tap`` the query's recent reports are used, and a run of more batches than it keeps is refused.
    """
    reports = tap.of(query) if tap else list(query.recentProgress)
    if not tap and len(reports) >= int(log.spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")):
        raise ValueError("the query has dropped older reports: attach a ProgressTap before it starts")
    for progress in reports:
        observed = progress.observedMetrics.get(observation)
        if observed is None:
            continue
        found = observed.asDict()
        entries = expectation_entries(flow, rules, found)
        log.flow(flow, "RUNNING", rows=found["kept"], dropped=found["rows"] - found["kept"], expectations=entries)
    log.flow(flow, "COMPLETED")
