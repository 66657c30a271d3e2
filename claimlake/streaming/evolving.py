"""Landing folders whose CSV files gain columns over time.

Spark's CSV reader matches columns by position, so files with different headers cannot share one schema.
Each run takes the new files from a file stream, finds every file's header in one distributed pass, reads
the files of each distinct header under that header, and stacks them by name: a new column is NULL in the
older files and text until it gets a hint. The columns seen so far are kept in an append-only schema log.
"""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from claimlake.schemas import STREAM_AUDIT
from claimlake.sources.csv import with_audit
from claimlake.sources.landing import DATASETS, LandingDataset
from claimlake.sources.paths import decoded, exists, literal
from claimlake.sources.rescue import MALFORMED, apply_hints
from claimlake.streaming.runs import stream_identity

BATCH = "_batch"


class SchemaLog:
    """The column names of one dataset in the order they appeared; every change appends one entry."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def columns(self) -> list[str]:
        if not exists(self.spark, self.path):
            return []
        entries = self.spark.read.schema("version int, columns string").json(self.path)
        last = entries.orderBy(F.col("version").desc()).first()
        return json.loads(last["columns"]) if last else []

    def extend(self, names: list[str]) -> list[str]:
        """Add unseen names at the end; the full list."""
        known = self.columns()
        merged = known + [n for n in names if n not in known]
        if merged != known:
            entry = self.spark.createDataFrame([(len(merged), json.dumps(merged))], "version int, columns string")
            entry.coalesce(1).write.mode("append").json(self.path)
        return merged


def file_headers(lines: DataFrame) -> DataFrame:
    """(header, files): the distinct first lines of the files and the files that have them.

    Blank lines before a header are skipped, as the reader skips them.
    """
    first = (
        lines.withColumn("_row", F.monotonically_increasing_id())
        .filter(F.length(F.trim("value")) > 0)
        .groupBy("_path")
        .agg(F.min_by("value", F.struct("_start", "_row")).alias("header"))
    )
    return first.groupBy("header").agg(F.collect_list("_path").alias("files"))


def read_by_header(spark: SparkSession, groups: list, columns: list[str], clock: Column | None = None) -> DataFrame:
    """Text rows of the files, each group under its own header, stacked by name."""
    parts = []
    for group in groups:
        names = next(csv.reader(io.StringIO(group["header"])))
        contract = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
        rows = (
            spark.read.schema(contract)
            .option("header", True)
            .option("columnNameOfCorruptRecord", MALFORMED)
            .csv([literal(path) for path in group["files"]])
        )
        parts.append(with_audit(rows, STREAM_AUDIT, clock))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    audit = [STREAM_AUDIT.ingested_at, STREAM_AUDIT.source_file, MALFORMED]
    absent = [n for n in columns if n not in stacked.columns]
    stacked = stacked.withColumns({n: F.lit(None).cast("string") for n in absent}) if absent else stacked
    return stacked.select(*columns, *audit)


def ingest_available_now(
    spark: SparkSession,
    source: str,
    target: str,
    schema_path: str,
    checkpoint: str,
    *,
    hints: str = "",
    files_per_batch: int = 1000,
    clock: Column | None = None,
) -> StreamingQuery:
    """Take the files that are new, append them typed to the target folder, then stop.

    Each batch fills its own ``_batch`` partition, named by the stream's identity and the batch number, and replaces it
    when repeated, so a restart can neither lose nor double a file, and a new checkpoint overwrites nothing. ``files_per_batch`` bounds the list of paths a batch brings to the driver.
    """
    log = SchemaLog(spark, schema_path)

    def append(batch: DataFrame, batch_id: int) -> None:
        groups = file_headers(batch).collect()
        if not groups:
            return
        names = [n for g in sorted(groups, key=lambda g: min(g["files"])) for n in next(csv.reader(io.StringIO(g["header"])))]
        columns = log.extend(list(dict.fromkeys(names)))
        rows = read_by_header(batch.sparkSession, groups, columns, clock)
        typed = apply_hints(rows, hints or T.StructType(), surplus=[MALFORMED])
        (
            typed.withColumn(BATCH, F.lit(f"{stream_identity(batch.sparkSession, checkpoint)}-{batch_id}"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(target)
        )

    lines = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(source)
        .select(
            "value",
            decoded(F.col("_metadata.file_path")).alias("_path"),
            F.col("_metadata.file_block_start").alias("_start"),
        )
    )
    query = lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """All batches, older ones with NULL in columns that came later."""
    return spark.read.option("mergeSchema", True).parquet(target).drop(BATCH)


def ingest_all_datasets(
    spark: SparkSession,
    landing: str,
    bronze: str,
    state: str,
    *,
    datasets: tuple[LandingDataset, ...] = DATASETS,
    clock: Column | None = None,
) -> list[str]:
    """Ingest every dataset of the registry; the table folders written."""
    written = []
    for dataset in datasets:
        target = f"{bronze.rstrip('/')}/{dataset.table}"
        ingest_available_now(
            spark,
            dataset.source_path(landing),
            target,
            dataset.schema_path(state),
            dataset.checkpoint_path(state),
            hints=dataset.entity.hints,
            clock=clock,
        )
        written.append(target)
    return written
