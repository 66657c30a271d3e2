"""Type-1 upserts into partitioned Parquet folders: the latest row per key, late rows lose.

A batch rewrites only the partitions its keys fall into. The partition is a function of the key: a hash
bucket, or a part of the key that arrives in order (the month of a snapshot), which keeps a batch of new
snapshots away from old months. Partitions hold unique keys, so their sizes do not follow hot keys.

The merged partitions are first written to a staging slot and from there moved into the table. A note beside the
slot says whose batch it holds: the stream's identity and the batch number, as numbers alone repeat with every new
checkpoint. Whoever comes next, the same stream or another, first publishes a slot that was left unpublished, so a
half-replaced table is always repaired from whole data. Merging is idempotent: a batch that comes again changes nothing.
One writer at a time may work on a target. A reader that comes while partitions are replaced may see some old and some new, or
miss one; ``merge_table`` has tables whose readers always see a whole version, and whose batches write no more than they hold.
This layout is for consumers that read a plain partitioned folder without the library.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.operators.latest import latest_by
from claimlake.sources.paths import exists, remove

PART = "_part"
SEQUENCE = "_seq_"  # prefix of the columns that keep each column's own sequence


@dataclass(frozen=True)
class Upsert:
    """How one table is keyed, ordered and laid out."""

    keys: tuple[str, ...]
    sequence: str
    buckets: int = 64
    month_of: str | None = None
    ignore_null_updates: bool = False
    except_columns: tuple[str, ...] = ()
    deleted: str = ""  # predicate of the rows that delete their key; merge tables only

    def __post_init__(self) -> None:
        if self.deleted and self.ignore_null_updates:
            raise ValueError("a row that deletes its key stands as a whole, so null updates cannot be ignored beside it")
        if self.month_of and self.month_of not in self.keys:
            raise ValueError("the layout must follow from the key, or one key could sit in two partitions")

    def part(self) -> Column:
        """The layout value; the leading letter keeps it text when partitions are discovered."""
        if self.month_of:
            return F.concat(F.lit("m"), F.coalesce(F.date_format(self.month_of, "yyyy-MM"), F.lit("none")))
        return F.concat(F.lit("b"), F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)))


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.option("mergeSchema", True).parquet(path) if exists(spark, path) else None


def latest_state(changes: DataFrame, spec: Upsert) -> DataFrame:
    """The state a log of changes amounts to.

    With ``ignore_null_updates`` each column keeps its latest value that is not NULL, with the sequence it came at, so
    that the result does not depend on how the changes were batched; otherwise the latest row stands as a whole.
    """
    if not spec.ignore_null_updates:
        return latest_by(changes, spec.keys, [spec.sequence])
    others = [c for c in changes.columns if c not in {*spec.keys, spec.sequence, PART} and not c.startswith(SEQUENCE)]
    known = {c: F.col(f"{SEQUENCE}{c}") if f"{SEQUENCE}{c}" in changes.columns else F.lit(None) for c in others}
    newest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.coalesce(known[c], F.col(spec.sequence)).alias("at"), F.col(c).alias("value")))).alias(c)
        for c in others
    ]
    merged = changes.groupBy(*spec.keys).agg(F.max(spec.sequence).alias(spec.sequence), *newest)
    plain = [c for c in changes.columns if not c.startswith(SEQUENCE) and c != PART]
    values = [F.col(f"{c}.value").alias(c) if c in others else F.col(c) for c in plain]
    return merged.select(*values, *[F.col(f"{c}.at").alias(f"{SEQUENCE}{c}") for c in others])


def upsert(
    batch: DataFrame, target: str, spec: Upsert, batch_id: int, stream: str = "", counters: Callable[[], dict] | None = None
) -> dict:
    """Merge a batch into the table folder; running the same batch again changes nothing.

    ``stream`` is the identity of the stream the batch number belongs to. What ``counters`` gives once the batch has been
    read is noted, and returned again if the batch comes again.
    """
    spark = batch.sparkSession
    slot = f"{target.rstrip('/')}__staging"
    note = _note(spark, slot)
    if note:
        same = (note["stream"], note["batch"]) == (stream, batch_id)
        if same or not exists(spark, f"{slot}_published"):
            _publish(spark, slot, target)
        if same:
            return json.loads(note["counters"])
    return _stage(batch, target, slot, spec, batch_id, stream, counters)


def _publish(spark: SparkSession, slot: str, target: str) -> None:
    rows = spark.read.parquet(slot)
    (
        rows.hint("rebalance", PART)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PART)
        .parquet(target)
    )
    _overwrite(spark.createDataFrame([(True,)], "published boolean"), f"{slot}_published")


def _overwrite(note: DataFrame, path: str) -> None:
    note.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def _stage(batch: DataFrame, target: str, slot: str, spec: Upsert, batch_id: int, stream: str, counters) -> dict:
    """Write the touched partitions as they will be, note whose they are, and publish them; an empty batch leaves no slot."""
    spark = batch.sparkSession
    updates = latest_state(batch, spec).withColumn(PART, spec.part()).persist()
    try:
        # Bounded by the layout (buckets or months), not by the batch; it prunes the table scan.
        touched = [row[0] for row in updates.select(PART).distinct().collect()]
        counted = counters() if counters else {}
        if not touched:
            return counted
        remove(spark, f"{slot}_note")
        remove(spark, f"{slot}_published")
        merged = updates
        existing = _read_or_none(spark, target)
        if existing is not None:
            old = existing.filter(F.col(PART).isin(touched))
            changes = old.unionByName(updates, allowMissingColumns=True).drop(PART)
            merged = latest_state(changes, spec).withColumn(PART, spec.part())
        merged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(slot)
        _overwrite(spark.createDataFrame([(stream, batch_id, json.dumps(counted))], NOTE), f"{slot}_note")
        _publish(spark, slot, target)
        return counted
    finally:
        updates.unpersist()


NOTE = "stream string, batch bigint, counters string"


def _note(spark: SparkSession, slot: str):
    """Whose batch the slot holds; noted only after all its files were committed."""
    return spark.read.schema(NOTE).json(f"{slot}_note").first() if exists(spark, f"{slot}_note") else None


def read_state(spark: SparkSession, target: str, spec: Upsert) -> DataFrame:
    """The table without its layout column and the columns kept only for sequencing."""
    rows = spark.read.option("mergeSchema", True).parquet(target)
    return rows.drop(PART, *[c for c in rows.columns if c.startswith(SEQUENCE)], *spec.except_columns)
