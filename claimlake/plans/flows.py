"""Declared flows: source, projection, rules, quarantine and target in one specification.

A specification is plain data (a mapping, or JSON or YAML text). Running it composes the operators of the
library; nothing is parsed here beyond that mapping, and Spark plans the rest.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimlake.operators import quality as q
from claimlake.operators.eventlog import RunLog, expectation_entries
from claimlake.operators.projection import select_expressions, substitute
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert
from claimlake.sources.paths import exists
from claimlake.streaming.runs import AVAILABLE_NOW, finish, stream_identity

BATCH = "_flow_batch"


@dataclass(frozen=True)
class FlowSpec:
    """One table of a medallion and how it is made.

    The input is a ``source`` folder of CSV or Parquet files, a ``table`` written before in the same run, or
    a ``sql`` query over such tables. ``keys`` with ``sequence`` make the target a type-1 table. ``mode`` is
    ``batch`` or ``stream``.
    """

    name: str
    layer: str = "bronze"
    source: str = ""
    table: str = ""
    source_format: str = "csv"
    schema: str = ""
    select: tuple[str, ...] = ()
    sql: str = ""
    rules: tuple[q.Rule, ...] = ()
    quarantine: bool = True
    mode: str = "batch"
    keys: tuple[str, ...] = ()
    sequence: str = ""
    month_of: str = ""
    buckets: int = 16
    except_columns: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if [bool(self.source), bool(self.table), bool(self.sql)].count(True) != 1:
            raise ValueError(f"{self.name}: give one of source, table and sql")
        if bool(self.keys) != bool(self.sequence):
            raise ValueError(f"{self.name}: keys and sequence belong together")
        if self.mode not in ("batch", "stream") or (self.mode == "stream" and self.sql):
            raise ValueError(f"{self.name}: mode {self.mode!r} does not fit")
        if self.mode == "stream" and self.source and not self.schema and self.source_format != "parquet":
            raise ValueError(f"{self.name}: a stream needs a schema")

    @property
    def view(self) -> str:
        """The name queries and later flows know the table by."""
        return f"{self.layer}_{self.name}"

    @staticmethod
    def from_mapping(values: Mapping, tokens: Mapping[str, str] | None = None) -> FlowSpec:
        """A specification from plain data; ``{token}`` placeholders are filled in every text."""

        def fill(value):
            if isinstance(value, str) and tokens is not None:
                return substitute(value, tokens)
            return [fill(v) for v in value] if isinstance(value, (list, tuple)) else value

        known = {k: fill(v) for k, v in values.items() if k != "rules"}
        for listed in ("select", "keys", "except_columns"):
            if listed in known:
                known[listed] = tuple(known[listed])
        return FlowSpec(**known, rules=tuple(q.rules_from_mapping(values.get("rules", {}))))

    def upsert_spec(self) -> Upsert | None:
        if not self.keys:
            return None
        return Upsert(self.keys, self.sequence, self.buckets, self.month_of or None, except_columns=self.except_columns)


def load_specs(text: str, tokens: Mapping[str, str] | None = None) -> list[FlowSpec]:
    """Specifications from JSON text, or YAML text where PyYAML is installed."""
    try:
        items = json.loads(text)
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError as error:
            raise ValueError("the text is no JSON, and YAML needs PyYAML") from error
        items = yaml.safe_load(text)
    return [FlowSpec.from_mapping(item, tokens) for item in items]


@dataclass
class FlowRunner:
    """Runs specifications in their order below one root folder, which all executors must reach.

    A table ``t`` lies at ``<root>/<layer>/t`` and is known as ``<layer>_t``. Its quarantine is part of its
    folder, or lies beside it when the table is type-1.
    """

    spark: SparkSession
    root: str
    log: RunLog | None = None
    written: dict[str, FlowSpec] = field(default_factory=dict)
    roots: dict[str, str] = field(default_factory=dict)  # of tables that lie below another folder

    def path(self, spec: FlowSpec, suffix: str = "") -> str:
        return f"{self.roots.get(spec.view, self.root).rstrip('/')}/{spec.layer}/{spec.name}{suffix}"

    def adopt(self, spec: FlowSpec) -> None:
        """Know a table that was written, and its quarantine if it has rules, by their names in queries."""
        self.written[spec.view] = spec
        if exists(self.spark, self.path(spec)):
            names = [spec.view, *([f"{spec.view}_quarantine"] if spec.rules and spec.quarantine else [])]
            for name in names:
                self.read(name).createOrReplaceTempView(name)

    def merge_table(self, spec: FlowSpec) -> MergeTable:
        """The table of a type-1 specification."""
        return MergeTable(self.spark, self.path(spec), spec.upsert_spec())

    def run(self, specs: Sequence[FlowSpec]) -> dict[str, FlowSpec]:
        state = "FAILED"
        try:
            for spec in specs:
                self._run_one(spec)
            state = "COMPLETED"
        finally:
            if self.log:
                self.log.finish(state)
        return self.written

    def read(self, name: str) -> DataFrame:
        """A written table by its view name, or its quarantine by ``<view>_quarantine``."""
        base = name.removesuffix("_quarantine") if name not in self.written else name
        spec, quarantine = self.written[base], name != base
        suffix = "_quarantine" if quarantine and spec.keys else ""
        path = self.path(spec, suffix)
        if suffix:
            empty = self._no_quarantine(spec)
            if not exists(self.spark, path):
                return empty
            # The schema is told: a folder without a bad row has no file to take it from.
            judged = q.judge(self.read(base).limit(0), spec.rules).withColumn(BATCH, F.lit(""))
            df = self.spark.read.schema(judged.schema).parquet(path)
        elif spec.keys:
            df = self.merge_table(spec).read()
        else:
            df = self.spark.read.option("mergeSchema", True).parquet(path)
        if spec.rules and (quarantine or not spec.keys):
            df = q.quarantine_of(df) if quarantine else q.kept_of(df)
        return df.drop("_part", BATCH, *spec.except_columns)

    def _no_quarantine(self, spec: FlowSpec) -> DataFrame:
        """An empty quarantine with the columns of the table's rows and of a quarantine."""
        rows = self.read(spec.view).limit(0)
        return q.quarantine_of(q.judge(rows, spec.rules)).drop("_part", BATCH, *spec.except_columns)

    def _run_one(self, spec: FlowSpec) -> None:
        counts: dict[str, int] = {}
        if self.log:
            self.log.flow(spec.name, "RUNNING")
        if spec.mode == "stream":
            counts = self._stream(spec)
        else:
            # A growing number, so that no later run passes for a replay of an earlier one.
            counts = self._write(spec, self._batch_source(spec), time.time_ns(), "batch")
        self.adopt(spec)
        if self.log:
            entries = expectation_entries(spec.name, spec.rules, counts) if counts and spec.rules else ()
            dropped = counts.get("rows", 0) - counts.get("kept", 0)
            self.log.flow(spec.name, "COMPLETED", rows=counts.get("kept", 0), dropped=dropped, expectations=entries)

    def _batch_source(self, spec: FlowSpec) -> DataFrame:
        if spec.sql:
            df = self.spark.sql(spec.sql)
        elif spec.table:
            df = self.read(spec.table)
        else:
            reader = self.spark.read.format(spec.source_format).option("header", True).option("enforceSchema", False)
            df = (reader.schema(spec.schema) if spec.schema else reader).load(spec.source)
        return select_expressions(df, spec.select) if spec.select else df

    def _stream(self, spec: FlowSpec) -> dict[str, int]:
        stream = self._stream_table(self.written[spec.table]) if spec.table else self._stream_files(spec)
        if spec.select:
            stream = select_expressions(stream, spec.select)
        totals: dict[str, int] = {}

        checkpoint = self.path(spec, "__checkpoint")

        def each(batch: DataFrame, batch_id: int) -> None:
            identity = stream_identity(self.spark, checkpoint)
            for name, value in self._write(spec, batch, batch_id, identity).items():
                totals[name] = totals.get(name, 0) + value

        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        finish(query.trigger(**AVAILABLE_NOW).start())
        return totals

    def _stream_files(self, spec: FlowSpec) -> DataFrame:
        # A header in another order than the schema fails, where Spark would go by position.
        reader = self.spark.readStream.format(spec.source_format).option("header", True).option("enforceSchema", False)
        schema = spec.schema or self.spark.read.format(spec.source_format).load(spec.source).schema
        return reader.schema(schema).load(spec.source)

    def _stream_table(self, source: FlowSpec) -> DataFrame:
        """New kept rows of an append-only table of the run."""
        if source.keys:
            raise ValueError(f"{source.name}: a type-1 table is rewritten and cannot be streamed")
        schema = self.spark.read.parquet(self.path(source)).schema
        rows = self.spark.readStream.schema(schema).parquet(self.path(source))
        return (q.kept_of(rows) if source.rules else rows).drop(BATCH)

    def _write(self, spec: FlowSpec, df: DataFrame, batch_id: int, stream: str) -> dict[str, int]:
        """Write rows and verdicts in one pass over the input; the counters come from the write itself.

        A type-1 table takes its kept rows from the judged batch, which is held for the second write. Its counters are noted
        with the batch, so a batch that is only published again still has them.
        """
        seen = Observation()
        observed = df.observe(seen, *q.flow_counts(spec.rules))
        judged = q.judge(observed, spec.rules) if spec.rules else observed
        if not spec.keys:
            self._replace(judged, self.path(spec), spec, batch_id, stream)
            return seen.get
        if not spec.rules:
            return self.merge_table(spec).upsert(judged, batch_id, stream, lambda: seen.get)
        judged = judged.persist()
        try:
            counts = self.merge_table(spec).upsert(q.kept_of(judged), batch_id, stream, lambda: seen.get)
            if spec.quarantine:
                bad = judged.filter(F.col(q.VERDICT) != q.CLEAN)
                self._replace(bad, self.path(spec, "_quarantine"), spec, batch_id, stream)
            return counts
        finally:
            judged.unpersist()

    def _replace(self, df: DataFrame, path: str, spec: FlowSpec, batch_id: int, stream: str) -> None:
        """Replace the whole table in batch mode, only the batch's own partition in stream mode.

        The partition names the stream too: batch numbers start again with every new checkpoint.
        """
        parts = [BATCH, *([q.VERDICT] if q.VERDICT in df.columns else [])]
        overwrite = "dynamic" if spec.mode == "stream" else "static"
        writer = df.withColumn(BATCH, F.lit(f"{stream}-{batch_id}")).write.mode("overwrite").partitionBy(*parts)
        writer.option("partitionOverwriteMode", overwrite).parquet(path)
