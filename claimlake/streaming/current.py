"""The latest row per key of a stream, kept in Spark's own state.

``latest_rows`` is an aggregate that runs in the JVM: the state of a key is its greatest row by sequence, then by content, so a
late row changes nothing whatever its batch, and ties fall as in ``latest_by``. It keeps every key for good, as a row may come at
any time.

``latest_until_idle`` lets keys go. A key whose rows have stopped for as long as ``idle`` of event time is settled: a timer hands
its row out once more, marked, and clears its state. Rows older than the watermark are dropped, so a settled key is not opened
again by a row it would have beaten. Rows that lose to the state are counted with the key. Timers need a state of our own, so
groups go through Python in Arrow batches; use ``latest_rows`` where keys need not end.

State lies in the checkpoint, in as many parts as the stream had shuffle partitions when it began. A restart goes on from it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from claimlake.sinks.merge_table import MergeTable
from claimlake.streaming.runs import AVAILABLE_NOW, stream_identity

SETTLED, LATE = "_settled", "_late_rows"


def latest_rows(stream: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The latest row of every key; as a stream, to be written in update mode: a batch gives the keys it had rows of."""
    rest = [c for c in stream.columns if c not in {*keys, *sequence}]
    top = stream.groupBy(*keys).agg(F.max(F.struct(*sequence, *rest)).alias("_top"))
    return top.select(*[F.col(c) if c in keys else F.col(f"_top.{c}").alias(c) for c in stream.columns])


def latest_until_idle(stream: DataFrame, keys: Sequence[str], sequence: Sequence[str], time: str, idle: str) -> DataFrame:
    """Changed rows of keys, and every key's row once more when it is settled; to be written in append mode.

    ``time`` is the column of event times and ``idle`` how far the watermark must pass a key's last time (``"7 days"``).
    Columns besides the keys are carried as they are; ``_settled`` marks the last row of a key and ``_late_rows`` counts the
    rows that lost so far.
    """
    names = stream.columns
    spots = [names.index(c) for c in (*sequence, *(c for c in names if c not in {*keys, *sequence}))]
    at_time = names.index(time)
    span = int(pd.Timedelta(idle).total_seconds() * 1000)
    state_schema = T.StructType([*stream.schema.fields, T.StructField(LATE, T.LongType()), T.StructField("_last", T.LongType())])
    output = T.StructType([*stream.schema.fields, T.StructField(SETTLED, T.BooleanType()), T.StructField(LATE, T.LongType())])

    def keep(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            *row, late, _ = state.get
            state.remove()
            yield pd.DataFrame([[*row, True, late]], columns=output.names)
            return
        *best, late, last = state.get if state.exists else (*[None] * len(names), 0, 0)
        best = tuple(best) if state.exists else None
        before = best
        for batch in batches:
            for row in _plain(batch):
                last = max(last, int(pd.Timestamp(row[at_time]).timestamp() * 1000) if row[at_time] is not None else 0)
                if best is None or _order(row, spots) > _order(best, spots):
                    best = row
                else:
                    late += 1
        state.update((*best, late, last))
        state.setTimeoutTimestamp(max(last + span, state.getCurrentWatermarkMs() + 1))
        if best != before:
            yield pd.DataFrame([[*best, False, late]], columns=output.names)

    watched = stream.withWatermark(time, idle)
    return watched.groupBy(*keys).applyInPandasWithState(keep, output, state_schema, "append", GroupStateTimeout.EventTimeTimeout)


def _plain(batch: pd.DataFrame) -> Iterator[tuple]:
    for row in batch.astype(object).where(batch.notna(), None).itertuples(index=False, name=None):
        yield tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in row)


def _order(row: tuple, spots: Sequence[int]) -> tuple:
    """NULL is less than any value, as in Spark's order of structs."""
    return tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in spots)


def keep_latest(
    stream: DataFrame, table: MergeTable, sequence: Sequence[str], checkpoint: str, *, trigger: Mapping | None = None, compact_after: int = 32
) -> StreamingQuery:
    """Commit the latest rows of a stream to a merge table, whose sequence must order as ``sequence`` does."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id, stream_identity(batch.sparkSession, checkpoint))
        table.compact(compact_after)

    latest = latest_rows(stream, table.spec.keys, sequence)
    writer = latest.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()
