"""Type-1 tables merged when they are read: a batch appends its rows, a manifest says what is live, readers see whole versions.

A batch of n rows writes n rows, whatever lies in the table: its latest row per key goes into a folder of its own (a delta),
laid out by the same partitions as ``upsert`` uses, and a manifest of the next version is put in place by one rename. Until then
nobody sees the rows; afterwards everybody does. A crash between any two writes leaves a folder that no manifest names, and
the same batch coming again writes another one. Manifests hold the last batch of every stream, so a batch that was committed is
known and left alone.

A reader merges the live deltas by sequence, and joins the base with the keys they hold: base rows of other keys pass through
without a shuffle of their own, and adaptive execution broadcasts the keys if they are few. ``compact`` rewrites the partitions
that have deltas into a base and commits that as a version; old versions stay readable until ``vacuum``.

The changes between two versions come from the deltas that were committed between them and from the rows their keys had before:
inserts, updates with the row before and after, and deletes, each with the number of the commit. Rows before and after meet in one
shuffle; where the deltas are few beside the table, the rows of other keys leave before it.

Any number of readers may work beside one writer. A second writer of the same version is refused, not merged. The one-step rename
is the file system's; object stores without it need their own committer for the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.sinks.upsert import PART, SEQUENCE, Upsert, latest_state
from claimlake.sources.paths import children, publish_text, read_text, remove, size

DELTA = "_delta"
DELETED = "_deleted"
COMMIT = "_commit_version"
CHANGE = "_change_type"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"
FEW = 8  # a batch of so many times fewer bytes than the table: only rows of its keys are compared with it


class Conflict(RuntimeError):
    """Another writer has committed the version this one was about to commit."""


@dataclass(frozen=True)
class Live:
    """A folder of rows and the partitions of it that count."""

    folder: str
    base: bool
    parts: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    """One version: its live folders, its columns, what it added, and the last batch of every stream with its counters."""

    version: int = 0
    added: str = ""
    schema: T.StructType = field(default_factory=T.StructType)
    live: tuple[Live, ...] = ()
    streams: dict = field(default_factory=dict)

    def text(self) -> str:
        live = [[x.folder, x.base, list(x.parts)] for x in self.live]
        plain = {"version": self.version, "added": self.added, "schema": self.schema.jsonValue(), "live": live, "streams": self.streams}
        return json.dumps(plain)

    @staticmethod
    def of(text: str) -> Manifest:
        values = json.loads(text)
        live = tuple(Live(folder, base, tuple(parts)) for folder, base, parts in values["live"])
        return Manifest(values["version"], values["added"], T.StructType.fromJson(values["schema"]), live, values["streams"])

    def deltas(self) -> list[Live]:
        return [x for x in self.live if not x.base]

    def touched(self) -> list[str]:
        return sorted({part for delta in self.deltas() for part in delta.parts})


class MergeTable:
    """A keyed table below one folder, which all executors must reach."""

    def __init__(self, spark: SparkSession, root: str, spec: Upsert) -> None:
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec

    # ---- versions ----

    def _path(self, version: int) -> str:
        return f"{self.root}/commits/{version:012d}.json"

    def versions(self) -> list[int]:
        names = children(self.spark, f"{self.root}/commits")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]

    def manifest(self, version: int | None = None) -> Manifest:
        """A version's manifest, the latest by default; version 0 is the empty table before the first commit."""
        known = self.versions()
        wanted = (known[-1] if known else 0) if version is None else version
        if wanted == 0 and (not known or known[0] == 1):
            return Manifest()
        if wanted not in known:
            raise ValueError(f"{self.root}: no version {wanted}; there are {known[:1]} to {known[-1:]}")
        return Manifest.of(read_text(self.spark, self._path(wanted)))

    def _commit(self, manifest: Manifest) -> None:
        if not publish_text(self.spark, self._path(manifest.version), manifest.text()):
            raise Conflict(f"{self.root}: version {manifest.version} was committed by another writer")

    # ---- writing ----

    def upsert(self, batch: DataFrame, batch_id: int, stream: str = "", counters: Callable[[], dict] | None = None) -> dict:
        """Commit a batch as the next version; a batch of a stream that was committed before changes nothing.

        What ``counters`` gives once the batch has been written is noted, and returned again if the batch comes again.
        """
        old = self.manifest()
        done = old.streams.get(stream)
        if done and done["batch"] >= batch_id:
            return done["counters"]
        known = [c for c in old.schema.names if c in batch.columns]
        tagged = self._tagged(batch.select(*known, *[c for c in batch.columns if c not in known]))
        rows = latest_state(tagged, self.spec)
        token, parts = self._write(rows, "delta")
        counted = counters() if counters else {}
        live = (*old.live, Live(token, False, parts)) if parts else old.live
        streams = {**old.streams, stream: {"batch": batch_id, "counters": counted}}
        self._commit(Manifest(old.version + 1, token if parts else "", _widened(old.schema, rows.schema), live, streams))
        return counted

    def _tagged(self, batch: DataFrame) -> DataFrame:
        return batch.withColumn(DELETED, F.coalesce(F.expr(self.spec.deleted), F.lit(False))) if self.spec.deleted else batch

    def _write(self, rows: DataFrame, kind: str, rebalance: bool = False) -> tuple[str, tuple[str, ...]]:
        """Write rows into a fresh folder; its name and its partitions, whose number the layout bounds."""
        token = f"{kind}-{uuid.uuid4().hex}"
        laid = rows.withColumn(PART, self.spec.part())
        laid = laid.hint("rebalance", PART) if rebalance else laid
        laid.write.partitionBy(PART).parquet(f"{self.root}/data/{DELTA}={token}")
        names = children(self.spark, f"{self.root}/data/{DELTA}={token}")
        return token, tuple(n.removeprefix(f"{PART}=") for n in names if n.startswith(f"{PART}="))

    def compact(self, at_least: int = 1) -> int:
        """Merge the partitions that ``at_least`` so many deltas touch into a base; the version it is committed as."""
        old = self.manifest()
        counts: dict[str, int] = {}
        for delta in old.deltas():
            for part in delta.parts:
                counts[part] = counts.get(part, 0) + 1
        due = {part for part, n in counts.items() if n >= at_least}
        if not due:
            return old.version
        token, parts = self._write(self._merged(old, due), "base", rebalance=True)
        left = [replace(x, parts=tuple(p for p in x.parts if p not in due)) for x in old.live]
        live = (Live(token, True, parts), *(x for x in left if x.parts))
        self._commit(replace(old, version=old.version + 1, added="", live=live))
        return old.version + 1

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` versions and the folders none of them names; the folders removed.

        No batch may be at work: its folder is not named yet.
        """
        known = self.versions()
        if not known:
            return []
        manifests = [self.manifest(v) for v in known[-keep:]]
        named = {x.folder for m in manifests for x in m.live} | {m.added for m in manifests}
        for version in known[:-keep]:
            remove(self.spark, self._path(version))
        gone = [n for n in children(self.spark, f"{self.root}/data") if n.removeprefix(f"{DELTA}=") not in named]
        for name in gone:
            remove(self.spark, f"{self.root}/data/{name}")
        return gone

    # ---- reading ----

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, without the columns kept only for layout and sequencing."""
        return self._visible(self._merged(self.manifest(version)))

    def _visible(self, rows: DataFrame) -> DataFrame:
        if DELETED in rows.columns:
            rows = rows.where(~F.col(DELETED))
        return rows.select(*self._shown(rows.columns))

    def _shown(self, columns: Sequence[str]) -> list[str]:
        hidden = {PART, DELTA, DELETED, COMMIT, *self.spec.except_columns}
        return [c for c in columns if c not in hidden and not c.startswith(SEQUENCE)]

    def _scan(self, manifest: Manifest, live: Sequence[Live], parts: set[str] | None = None) -> DataFrame:
        """The live rows of some folders; the schema is the manifest's, so no footers are merged."""
        schema = T.StructType([*manifest.schema.fields, T.StructField(DELTA, T.StringType()), T.StructField(PART, T.StringType())])
        wanted = [(x.folder, [p for p in x.parts if parts is None or p in parts]) for x in live]
        wanted = [(folder, names) for folder, names in wanted if names]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/{DELTA}={f}" for f, _ in wanted])
        chosen = [(F.col(DELTA) == folder) & F.col(PART).isin(names) for folder, names in wanted]
        return rows.where(reduce(Column.__or__, chosen))

    def _merged(self, manifest: Manifest, parts: set[str] | None = None) -> DataFrame:
        """The state of a version, rows that delete their key included."""
        deltas, bases = manifest.deltas(), [x for x in manifest.live if x.base]
        old = self._scan(manifest, bases, parts).drop(DELTA)
        touched = [p for p in manifest.touched() if parts is None or p in parts]
        if not touched:
            return old.drop(PART)
        log = self._scan(manifest, deltas, parts).drop(DELTA, PART)
        if len([x for x in deltas if parts is None or parts & set(x.parts)]) > 1:  # one delta alone holds each key once
            log = latest_state(log, self.spec)
        if not bases:
            return log
        beside = old.where(F.col(PART).isin(touched)).drop(PART)
        met = latest_state(self._of_keys(beside, log, "left_semi").unionByName(log), self.spec)
        passed = self._of_keys(beside, log, "left_anti")
        return old.where(~F.col(PART).isin(touched)).drop(PART).unionByName(passed).unionByName(met)

    def _of_keys(self, rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
        """Rows whose key is (not) among the other's; NULL is a key like any other."""
        keys = other.select(*[F.col(k).alias(f"_key_{k}") for k in self.spec.keys]).distinct()
        return rows.join(keys, reduce(Column.__and__, [rows[k].eqNullSafe(keys[f"_key_{k}"]) for k in self.spec.keys]), how)

    # ---- changes ----

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """What the versions after ``since`` up to ``until`` changed: the visible columns, ``_change_type`` and ``_commit_version``.

        A batch whose rows lose to what is there, or that only repeats it, changes nothing.
        """
        first, last = self.manifest(since), self.manifest(until)
        added = self._added(since, last.version)
        first = replace(first, schema=last.schema)
        numbers = F.create_map(*[F.lit(x) for pair in added.items() for x in pair]) if added else None
        if not added:
            empty = self._visible(self.spark.createDataFrame([], last.schema))
            return empty.select(F.lit("").alias(CHANGE), F.lit(0).cast("bigint").alias(COMMIT), "*").where("FALSE")
        parts = {p for x in added for p in self._parts_of(x)}
        batches = self._scan(last, [Live(token, False, self._parts_of(token)) for token in added])
        batches = batches.withColumn(COMMIT, numbers[F.col(DELTA)]).drop(DELTA, PART)
        held = self._held(first, parts, since)
        if self._bytes(added) * FEW < self._bytes([x.folder for x in first.live]):
            held = self._of_keys(held, batches, "left_semi")
        return self._compared(held.unionByName(batches), since)

    def _held(self, manifest: Manifest, parts: set[str], since: int) -> DataFrame:
        """The live rows as they were written, unmerged. A folder has a key once, and a number of its own up to ``since``,
        so that the comparison merges them where it brings the keys together anyway."""
        rows = self._scan(manifest, manifest.live, parts)
        numbers = [x for n, live in enumerate(reversed(manifest.live)) for x in (F.lit(live.folder), F.lit(since - n))]
        return rows.withColumn(COMMIT, F.create_map(*numbers)[F.col(DELTA)] if numbers else F.lit(since)).drop(DELTA, PART)

    def _bytes(self, tokens: Iterable[str]) -> int:
        return sum(size(self.spark, f"{self.root}/data/{DELTA}={token}") for token in tokens)

    def _added(self, since: int, until: int) -> dict[str, int]:
        """The folders that the versions of a range added, with their versions."""
        manifests = [self.manifest(v) for v in range(since + 1, until + 1)]
        return {m.added: m.version for m in manifests if m.added}

    def _parts_of(self, token: str) -> tuple[str, ...]:
        names = children(self.spark, f"{self.root}/data/{DELTA}={token}")
        return tuple(n.removeprefix(f"{PART}=") for n in names if n.startswith(f"{PART}="))

    def _compared(self, log: DataFrame, since: int) -> DataFrame:
        """Each commit's state of a key beside the one before it; a key has one row a commit.

        The rows are dealt by key before states are made of them: left to the window, the shuffle would carry the states besides.
        """
        log = log.repartition(*self.spec.keys)
        by_commit = Window.partitionBy(*self.spec.keys).orderBy(COMMIT)
        so_far = by_commit.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        shown = self._shown(log.columns)
        after = F.struct(*[v.alias(c) for c, v in self._running(log, so_far).items() if c in shown or c == DELETED])
        stated = log.select(*self.spec.keys, COMMIT, after.alias("after"))
        stated = stated.withColumn("before", F.lag("after").over(by_commit)).where(F.col(COMMIT) > since)
        alive = lambda state: F.col(state).isNotNull() & (~F.col(f"{state}.{DELETED}") if self.spec.deleted else F.lit(True))
        image = lambda kind, state: F.struct(F.lit(kind).alias(CHANGE), F.col(state).alias("row"))
        images = (
            F.when(alive("before") & alive("after"), F.when(~self._same(shown), F.array(image(BEFORE, "before"), image(AFTER, "after"))))
            .when(alive("after"), F.array(image(INSERT, "after")))
            .when(alive("before"), F.array(image(DELETE, "before")))
        )
        return stated.select(COMMIT, F.inline(images)).select(CHANGE, COMMIT, *[F.col(f"row.{c}") for c in shown])

    def _same(self, shown: list[str]) -> Column:
        return reduce(Column.__and__, [F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")) for c in shown])

    def _running(self, log: DataFrame, so_far) -> dict[str, Column]:
        """Every column of the state after each commit, by the rules of ``latest_state``."""
        keys, sequence = self.spec.keys, self.spec.sequence
        known = {k: F.col(k) for k in keys}
        if not self.spec.ignore_null_updates:
            others = [c for c in log.columns if c not in {*keys, COMMIT}]
            named = {c: f"_{n}" for n, c in enumerate([sequence, *self._tied(log)], 1)}
            compared = F.struct(*[F.col(c).alias(n) for c, n in named.items()])
            if set(others) <= named.keys():  # what is compared is the whole row
                top = F.max(compared).over(so_far)
                return known | {c: top[named[c]] for c in others}
            top = F.max_by(F.struct(*others), compared).over(so_far)
            return known | {c: top[c] for c in others}
        latest = {sequence: F.max(sequence).over(so_far)}
        for c in self._shown(log.columns):
            if c not in {*keys, sequence}:
                at = F.coalesce(F.col(f"{SEQUENCE}{c}"), F.col(sequence)) if f"{SEQUENCE}{c}" in log.columns else F.col(sequence)
                newest = F.max(F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("value")))).over(so_far)
                latest[c] = newest["value"]
        return known | latest

    def _tied(self, log: DataFrame) -> list[str]:
        """The columns that decide between equal sequences, in the order ``latest_state`` takes them."""
        kept = log.drop(COMMIT)
        return [c for c, kind in kept.dtypes if c not in {*self.spec.keys, self.spec.sequence} and not kind.startswith(("map", "variant"))]


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both; a column may be new, but not of another type."""
    known = {f.name: f.dataType.simpleString() for f in old.fields}
    for f in new.fields:
        if known.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString():
            raise ValueError(f"column {f.name} is {known[f.name]}, not {f.dataType.simpleString()}")
    added = [T.StructField(f.name, T.StructType.fromDDL(f"x {f.dataType.simpleString()}")["x"].dataType) for f in new.fields if f.name not in known]
    return T.StructType([*old.fields, *added])  # every part may be NULL, whatever a batch says of its own
