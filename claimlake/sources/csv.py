"""CSV readers: inferred, text-first, fallback and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.casting import now_or
from claimlake.schemas import BATCH_AUDIT, STREAM_AUDIT, AuditColumns, Entity
from claimlake.sources.paths import exists
from claimlake.sources.rescue import MALFORMED, apply_hints


def with_audit(df: DataFrame, audit: AuditColumns = BATCH_AUDIT, clock: Column | None = None) -> DataFrame:
    """Add the ingest time and the source file: its name in batch tables, its path in streamed ones."""
    file = "_metadata.file_name" if audit is BATCH_AUDIT else "_metadata.file_path"
    return df.withColumns({audit.ingested_at: now_or(clock), audit.source_file: F.col(file)})


def read_csv_with_audit(spark: SparkSession, path: str, clock: Column | None = None) -> DataFrame:
    """Header and inferred types. Inference costs a pass and turns ``0800`` into 800."""
    return with_audit(spark.read.csv(path, header=True, inferSchema=True), BATCH_AUDIT, clock)


def read_csv_text(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    audit: AuditColumns = STREAM_AUDIT,
    clock: Column | None = None,
) -> DataFrame:
    """All columns as text, by the header; a given contract picks its columns by name, absent ones are NULL.

    Files whose headers differ from the first one's fail the read, where Spark would go by position.
    """
    rows = with_audit(spark.read.option("header", True).option("enforceSchema", False).csv(path), audit, clock)
    if schema is None:
        return rows
    known = {n.lower(): n for n in rows.columns}
    picked = [F.col(f"`{known[n.lower()]}`").alias(n) if n.lower() in known else F.lit(None).cast("string").alias(n) for n in schema.names]
    return rows.select(*picked, audit.ingested_at, audit.source_file)


def read_csv_or_fallback(spark: SparkSession, preferred: str, fallback: str) -> DataFrame:
    """Text rows of the preferred location, or of the other one when it is missing or holds no rows."""
    if exists(spark, preferred):
        rows = spark.read.csv(preferred, header=True)
        if rows.columns and not rows.isEmpty():
            return rows
    if not exists(spark, fallback):
        raise FileNotFoundError(f"no CSV rows in {preferred} or {fallback}")
    return spark.read.csv(fallback, header=True)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files without the blank ones."""
    return spark.read.text(path).filter(F.length(F.trim("value")) > 0)


def stream_csv(
    spark: SparkSession,
    path: str,
    entity: Entity,
    *,
    files_per_batch: int | None = None,
    clock: Column | None = None,
) -> DataFrame:
    """A stream of one landing folder under a fixed contract.

    Files are read as text, then cast by the entity's types; text that does not fit, and whole lines with
    too few or too many fields, go to ``_rescued_data``. A file whose header is not the contract's fails the stream; where
    headers vary, ``ingest_available_now`` reads each file under its own.
    """
    contract = T.StructType([*entity.raw_schema().fields, T.StructField(MALFORMED, T.StringType())])
    reader = (
        spark.readStream.schema(contract)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    audited = with_audit(reader.csv(path), STREAM_AUDIT, clock)
    typed = apply_hints(audited, entity.hints, surplus=[MALFORMED])
    return typed
