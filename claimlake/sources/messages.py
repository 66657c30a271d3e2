"""JSON messages: a Kafka reader and the parse step, which also runs on plain rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.functions.casting import now_or
from claimlake.schemas import BROKER_FIELDS, ENTITIES, MESSAGE_AUDIT

BROKEN = "_broken_text"


def settings(spark: SparkSession, *keys: str) -> list[str]:
    """The values of session settings that must all be there; one error names every missing one."""
    found = {key: spark.conf.get(key, "") for key in keys}
    absent = [key for key, value in found.items() if not value]
    if absent:
        raise ValueError(f"the session lacks the settings {', '.join(absent)}")
    return list(found.values())


def kafka_options(servers: str, topic: str, jaas: str | None = None, starting: str = "earliest") -> dict[str, str]:
    """Reader options; a JAAS line switches on SASL over TLS."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if jaas:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas,
        }
    return options


def kafka_rows(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A stream of Kafka rows; needs the connector package on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def read_messages(
    spark: SparkSession, dataset: str, *, starting: str = "earliest", rows: DataFrame | None = None
) -> DataFrame:
    """Parsed messages of one dataset's topic; ``rows`` injects Kafka-shaped rows instead of a broker."""
    entity = ENTITIES.get(dataset)
    if entity is None:
        raise ValueError(f"unknown dataset {dataset!r}: there are {', '.join(sorted(ENTITIES))}")
    if rows is None:
        servers, topic, jaas = settings(spark, "messages.bootstrap.servers", f"messages.topic.{dataset}", "messages.jaas")
        rows = kafka_rows(spark, kafka_options(servers, topic, jaas, starting))
    named = rows.select(*[F.col(theirs).alias(ours) for theirs, ours in BROKER_FIELDS.items()])
    named = named.withColumn("_raw_value", F.col("_raw_value").cast("string"))
    return parse_json(named, entity.typed_schema())


def parse_json(df: DataFrame, schema: T.StructType, clock: Column | None = None) -> DataFrame:
    """Payload fields, message columns, the raw text and ``_parse_error``.

    The error is ``null_value`` without text and ``invalid_json`` for text that is no JSON object. A field
    of the wrong type is only a NULL field; of a name that comes twice the last value stands. Message columns the input lacks are NULL, but for the times, which are now.
    """
    if "_raw_value" not in df.columns:
        raise ValueError("parse_json needs a `_raw_value` column")
    times = {name for name, kind in MESSAGE_AUDIT.items() if kind == "timestamp"}
    missing = {
        name: (now_or(clock) if name in times else F.lit(None)).cast(kind) for name, kind in MESSAGE_AUDIT.items() if name not in df.columns
    }
    raw = F.col("_raw_value")
    fields = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    # Broken text and a field of the wrong type look alike to the parse; only such texts are parsed once more to tell them apart.
    unsure = F.col("_parsed")[BROKEN].isNotNull()
    no_object = F.col("_parsed").isNull() | ~F.ltrim(raw).startswith("{") | F.when(unsure, F.try_parse_json(raw).isNull()).otherwise(False)
    judged = df.withColumns({**missing, "_parsed": F.from_json(raw, fields, {"columnNameOfCorruptRecord": BROKEN})}).withColumn(
        "_parse_error", F.when(raw.isNull(), "null_value").when(no_object, "invalid_json")
    )
    # A filter on what was parsed does not cross a generator; pushed below the parse it would repeat it for every mention.
    once = judged.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in judged.columns]))))
    return (
        once.withColumn("_parsed", F.when(F.col("_parse_error").isNull(), F.col("_parsed")))
        .select(
            *[F.col("_parsed")[name].alias(name) for name in schema.names],
            "_ingest_ts", *[c for c in MESSAGE_AUDIT if c != "_ingest_ts"], "_raw_value", "_parse_error",
        )
    )


def write_messages(lines: DataFrame, options: Mapping[str, str], topic: str) -> None:
    """Send one message per row of ``value``; needs the connector package."""
    lines.selectExpr("CAST(value AS STRING) AS value").write.format("kafka").options(**options).option("topic", topic).save()
