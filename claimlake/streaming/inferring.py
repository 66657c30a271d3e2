"""Incremental CSV whose column types are told from the data and widen as it changes.

Every batch is looked at once for the kinds of its columns; a log keeps the kinds seen so far, a version for each change. A batch
is written typed, below the version it was written under. The reader reads the versions side by side, each under its own schema,
and lifts the older ones to the latest kinds; there are no more versions than columns were added or widened.

Nothing is lost by a type that later proves too narrow: where a value's text is not what its type prints (``007``, ``1.50`` in a
column of three decimals, blanks around it), the text is kept beside it in ``_texts``, and a column that has become text gives
it back. Types that were hinted do not widen: misfits are rescued, as in ``evolving``.
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
from claimlake.sources.kinds import OPEN, TEXT, kinds_of, wider
from claimlake.sources.paths import decoded, exists, remove
from claimlake.sources.rescue import MALFORMED, RESCUED, apply_hints
from claimlake.streaming.evolving import BATCH, file_headers, read_by_header
from claimlake.streaming.runs import stream_identity

VERSION, TEXTS = "_schema", "_texts"


class KindLog:
    """Names and kinds of a dataset's columns in the order they appeared; every change appends a version."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def versions(self) -> list[tuple[int, dict[str, str]]]:
        if not exists(self.spark, self.path):
            return []
        entries = self.spark.read.schema("version int, kinds string").json(self.path).orderBy("version").collect()
        return [(e["version"], dict(json.loads(e["kinds"]))) for e in entries]

    def extend(self, found: dict[str, str]) -> tuple[int, dict[str, str]]:
        """Widen the known kinds by those of a batch; the version that holds both."""
        number, known = (self.versions() or [(0, {})])[-1]
        merged = known | {name: wider(known.get(name, OPEN), kind) for name, kind in found.items()}
        if merged == known and number:
            return number, known
        entry = self.spark.createDataFrame([(number + 1, json.dumps(list(merged.items())))], "version int, kinds string")
        entry.coalesce(1).write.mode("append").json(self.path)
        return number + 1, merged


def _stored(kind: str) -> str:
    return TEXT if kind == OPEN else kind


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Text columns as their kinds, with the texts that the types would not print."""
    columns, differing = [], []
    for name in df.columns:
        text = F.col(f"`{name}`")
        kind = _stored(kinds.get(name, TEXT))
        if kind == TEXT:
            columns.append(text)
            continue
        value = F.trim(text).try_cast(kind)
        columns.append(value.alias(name))
        differing.append(F.when(~text.eqNullSafe(value.cast(TEXT)), F.struct(F.lit(name).alias("key"), text.alias("value"))))
    kept = F.map_from_entries(F.array_compact(F.array(*differing))) if differing else F.lit(None).cast("map<string,string>")
    return df.select(*columns, (F.when(F.size(kept) > 0, kept) if differing else kept).alias(TEXTS))


def ingest_inferred(
    spark: SparkSession, source: str, target: str, schema_path: str, checkpoint: str, *,
    hints: str = "", files_per_batch: int = 1000, clock: Column | None = None,
) -> StreamingQuery:
    """Take the files that are new, append them typed to the target folder, then stop.

    Each batch fills its own ``_batch`` partition, named by the stream's identity and the batch number, and replaces it when it
    is repeated, even if the kinds have widened since. ``files_per_batch`` bounds the list of paths a batch brings to the driver.
    """
    log = KindLog(spark, schema_path)
    hinted = [f.name for f in T.StructType.fromDDL(hints).fields] if hints else []

    def append(batch: DataFrame, batch_id: int) -> None:
        groups = file_headers(batch).collect()
        if not groups:
            return
        headers = [n for g in sorted(groups, key=lambda g: min(g["files"])) for n in next(csv.reader(io.StringIO(g["header"])))]
        names = list(dict.fromkeys(headers))
        rows = apply_hints(read_by_header(batch.sparkSession, groups, names, clock), hints or T.StructType(), surplus=[MALFORMED])
        free = [n for n in names if n not in hinted]
        version, kinds = log.extend(kinds_of(rows, free))
        name = f"{stream_identity(batch.sparkSession, checkpoint)}-{batch_id}"
        for older in range(1, version):
            remove(spark, f"{target}/{VERSION}={older}/{BATCH}={name}")
        laid = typed(rows, {n: kinds[n] for n in free}).withColumns({VERSION: F.lit(version), BATCH: F.lit(name)})
        laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VERSION, BATCH).parquet(target)

    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source)
    lines = lines.select("value", decoded(F.col("_metadata.file_path")).alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    query = lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_inferred(spark: SparkSession, target: str, schema_path: str, hints: str = "") -> DataFrame:
    """All batches under the latest kinds; columns a batch did not have are NULL."""
    versions = KindLog(spark, schema_path).versions()
    if not versions:
        raise FileNotFoundError(f"nothing was ingested: no schema at {schema_path}")
    latest = versions[-1][1]
    own = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(hints).fields} if hints else {}
    extra = {STREAM_AUDIT.ingested_at: "timestamp", STREAM_AUDIT.source_file: TEXT, RESCUED: TEXT}
    lifted = None
    for version, kinds in versions:
        folder = f"{target}/{VERSION}={version}"
        if not exists(spark, folder):
            continue
        fields = {n: _stored(k) for n, k in kinds.items()} | own | extra | {TEXTS: "map<string,string>"}
        rows = spark.read.schema(", ".join(f"`{n}` {k}" for n, k in fields.items())).parquet(folder)
        columns = [_lifted(n, kinds.get(n, OPEN), k) for n, k in latest.items()]
        part = rows.select(*columns, *[F.col(f"`{n}`") if n in fields else F.lit(None).cast(k).alias(n) for n, k in (own | extra).items()])
        lifted = part if lifted is None else lifted.unionByName(part)
    return lifted


def _lifted(name: str, old: str, new: str) -> Column:
    """A column as the kind it has come to have; as text, the text it came as."""
    target = _stored(new)
    if old == OPEN:
        return F.lit(None).cast(target).alias(name)
    value = F.col(f"`{name}`")
    if target == TEXT and _stored(old) != TEXT:
        return F.coalesce(F.col(TEXTS)[name], value.cast(TEXT)).alias(name)
    return value.cast(target).alias(name)
