"""A run log that a stream writes in its batches, so that it holds every batch once whatever fails.

The entry of a batch is keyed by stream, batch and flow, and lies in a folder of that name. A batch writes its rows, then its
entry; if the driver dies in between, or before the batch counts as done, the same batch comes again and replaces both. A
restart of the stream goes on under the same identity, so its entries are those of one run.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimlake.operators import quality as q
from claimlake.operators.eventlog import FLOW_PROGRESS, LOG_SCHEMA, expectation_entries
from claimlake.sources.paths import exists
from claimlake.streaming.runs import AVAILABLE_NOW, stream_identity

BATCH = "_flow_batch"


class BatchLog:
    """Entries of the batches of one pipeline's streams."""

    def __init__(self, spark: SparkSession, path: str, pipeline_id: str, pipeline_name: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.pipeline_id, self.pipeline_name = pipeline_id, pipeline_name

    def _entry(self, stream: str, batch_id: int, flow: str) -> str:
        return f"{self.path}/entry={flow}-{stream}-{batch_id:012d}"

    def _dropped_before(self, stream: str, batch_id: int, flow: str) -> int:
        """The running count of dropped rows after the batch before, which is done when a batch begins."""
        path = self._entry(stream, batch_id - 1, flow)
        if batch_id == 0 or not exists(self.spark, path):
            return 0
        details = json.loads(self.spark.read.schema(LOG_SCHEMA).parquet(path).first().details)
        return details[FLOW_PROGRESS]["data_quality"]["dropped_records"]

    def write(self, stream: str, batch_id: int, flow: str, rules: Sequence[q.Rule], observed: Mapping[str, int]) -> None:
        """Write the entry of a batch, or replace it."""
        dropped = self._dropped_before(stream, batch_id, flow) + observed["rows"] - observed["kept"]
        progress = {
            "status": "RUNNING",
            "metrics": {"num_output_rows": observed["kept"]},
            "data_quality": {"dropped_records": dropped, "expectations": expectation_entries(flow, rules, observed)},
        }
        origin = (self.pipeline_id, self.pipeline_name, stream, flow)
        now = dt.datetime.now(dt.timezone.utc)
        row = (now, "INFO", FLOW_PROGRESS, f"{flow} is RUNNING", origin, json.dumps({FLOW_PROGRESS: progress}))
        entry = self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("overwrite")
        entry.option("partitionOverwriteMode", "static").parquet(self._entry(stream, batch_id, flow))

    def read(self) -> DataFrame:
        """The entries as a log, as the queries over run logs take it."""
        names = T.StructType.fromDDL(LOG_SCHEMA).names
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path).select(*names)


def logged_stream(
    stream: DataFrame, rules: Sequence[q.Rule], target: str, checkpoint: str, log: BatchLog, flow: str, *, trigger: Mapping | None = None
) -> StreamingQuery:
    """Append judged rows to a folder, a partition a batch, and the batch's counters to the log."""
    spark = log.spark

    def each(batch: DataFrame, batch_id: int) -> None:
        identity = stream_identity(spark, checkpoint)
        seen = Observation()
        judged = q.judge(batch.observe(seen, *q.flow_counts(rules)), rules).withColumn(BATCH, F.lit(f"{identity}-{batch_id}"))
        writer = judged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH, q.VERDICT)
        writer.parquet(target)
        log.write(identity, batch_id, flow, rules, seen.get)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()
