"""Merge-on-read tables: versions, replays, crashes between any two writes, compaction, changes."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from claimlake.sinks import merge_table
from claimlake.sinks.merge_table import AFTER, BEFORE, DELETE, INSERT, Conflict, MergeTable
from claimlake.sinks.upsert import Upsert
from claimlake.sources.paths import children, publish_text, read_text
from claimlake.sources.tables import stream_folder
from claimlake.streaming import runs

SPEC = Upsert(("k",), "seq", buckets=4)
GONE = Upsert(("k",), "seq", buckets=4, deleted="v = 'gone'")
SCHEMA = "k string, v string, w int, seq int"


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def state(table, version=None):
    return {r.k: (r.v, r.w) for r in table.read(version).collect()}


def files(tmp_path):
    return {p for p in tmp_path.rglob("*.parquet")}


def test_one_file_name_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "c" / "1.json")
    assert publish_text(spark, path, "one é") and not publish_text(spark, path, "two")
    assert read_text(spark, path) == "one é" and children(spark, str(tmp_path / "c")) == ["1.json"] and children(spark, str(tmp_path / "no")) == []


def test_whatever_the_arrival(spark, tmp_path):
    batches = [[("a", "1", 1, 1), ("b", "1", 1, 5)], [("a", "2", None, 2), ("b", "old", 0, 3), (None, "n", 1, 1)], [("c", "1", 1, 1), (None, "m", 1, 2)]]
    for n, order in enumerate(itertools.permutations(range(3))):
        table = MergeTable(spark, str(tmp_path / f"t{n}"), SPEC)
        for number, index in enumerate(order):
            table.upsert(rows(spark, *batches[index]), number)
            if n % 2:
                table.compact()
        assert state(table) == {"a": ("2", None), "b": ("1", 1), "c": ("1", 1), None: ("m", 1)}


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), SPEC)
    table.upsert(rows(spark, *[(f"k{i}", "1", 1, 1) for i in range(200)]), 0)
    table.compact()
    before = files(tmp_path)
    table.upsert(rows(spark, ("k3", "2", 2, 2)), 1)
    new = files(tmp_path) - before
    assert len(new) == 1 and spark.read.parquet(str(new.pop())).count() == 1
    assert state(table)["k3"] == ("2", 2) and state(table, 2)["k3"] == ("1", 1) and len(state(table)) == 200


def test_replays_and_streams_with_equal_numbers(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), SPEC)
    first = table.upsert(rows(spark, ("a", "1", 1, 1)), 4, "s", lambda: {"rows": 1})
    assert first == table.upsert(rows(spark, ("a", "9", 9, 9)), 4, "s", lambda: 1 / 0) == {"rows": 1}
    table.upsert(rows(spark, ("b", "1", 1, 1)), 4, "other")
    assert state(table) == {"a": ("1", 1), "b": ("1", 1)} and table.versions() == [1, 2]


@pytest.mark.parametrize("step", ["_write", "_commit"])
@pytest.mark.parametrize("work", ["upsert", "compact"])
def test_crash_between_any_two_writes(spark, tmp_path, monkeypatch, step, work):
    """After the rows are written but before the manifest is, and before any of both: readers see the old version, a rerun the new."""
    table = MergeTable(spark, str(tmp_path / "t"), SPEC)
    table.upsert(rows(spark, ("a", "1", 1, 1), ("b", "1", 1, 1)), 0)
    table.upsert(rows(spark, ("b", "2", 2, 2)), 1)
    before = state(table)
    run = {"upsert": lambda: table.upsert(rows(spark, ("a", "3", 3, 3)), 2), "compact": table.compact}[work]

    def crash(*args, **more):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(MergeTable, step, crash)
        with pytest.raises(RuntimeError):
            run()
    assert state(table) == before and table.versions() == [1, 2]
    run()
    assert state(table) == ({**before, "a": ("3", 3)} if work == "upsert" else before)
    if step == "_commit":
        assert len(table.vacuum(keep=3)) == 1  # the folder of the lost run
    assert state(table) == ({**before, "a": ("3", 3)} if work == "upsert" else before)


def test_a_second_writer_of_a_version_is_refused(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), SPEC)
    with pytest.raises(Conflict):
        table.upsert(rows(spark, ("a", "1", 1, 1)), 0, "one", lambda: table.upsert(rows(spark, ("b", "1", 1, 1)), 0, "two"))
    assert state(table) == {"b": ("1", 1)}


def test_columns_may_come_later_but_not_change_type(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), SPEC)
    table.upsert(spark.createDataFrame([("a", 1)], "k string, seq int"), 0)
    table.upsert(rows(spark, ("b", "x", 1, 1)), 1)
    assert {r.k: r.v for r in table.read().collect()} == {"a": None, "b": "x"} and table.read(1).columns == ["k", "seq"]
    with pytest.raises(ValueError, match="column w is int"):
        table.upsert(spark.createDataFrame([("c", "x", "y", 1)], "k string, v string, w string, seq int"), 2)


def test_compaction_leaves_untouched_months(spark, tmp_path):
    spec = Upsert(("k", "day"), "seq", month_of="day")
    table = MergeTable(spark, str(tmp_path / "t"), spec)
    frame = lambda *r: spark.createDataFrame(r, "k string, day string, seq int").withColumn("day", F.to_date("day"))
    table.upsert(frame(("a", "2025-01-05", 1), ("a", "2025-02-05", 1), ("a", None, 1)), 0)
    table.compact()
    table.upsert(frame(("b", "2025-02-05", 1)), 1)
    assert table.compact(at_least=2) == 3 and table.compact() == 4
    bases = {x.folder: x.parts for x in table.manifest().live}
    assert sorted(bases.values()) == [("m2025-01", "mnone"), ("m2025-02",)] and table.manifest().deltas() == []
    assert table.read().count() == 4
    gone = table.vacuum(keep=1)
    assert len(gone) == 2 and table.read().count() == 4 and table.versions() == [4]
    with pytest.raises(ValueError):
        table.read(2)


def test_changes_equal_the_difference_of_versions(spark, tmp_path):
    rng = random.Random(8)
    table = MergeTable(spark, str(tmp_path / "t"), GONE)
    for number in range(6):
        batch = [(f"k{rng.randrange(12)}", rng.choice(["1", "2", None, "gone"]), rng.choice([None, 1]), rng.randrange(6)) for _ in range(8)]
        table.upsert(rows(spark, *batch), number)
        if number in (2, 4):
            table.compact()
    row = lambda r: (r.k, r.v, r.w, r.seq)
    states = {0: {}} | {v: {r.k: row(r) for r in table.read(v).collect()} for v in table.versions()}
    for since, until in ((0, 8), (3, 7), (4, 5)):
        expected = []
        for v in range(since + 1, until + 1):
            old, new = states[v - 1], states[v]
            for k in old.keys() | new.keys():
                if k not in old:
                    expected.append((INSERT, v, *new[k]))
                elif k not in new:
                    expected.append((DELETE, v, *old[k]))
                elif old[k] != new[k]:
                    expected += [(BEFORE, v, *old[k]), (AFTER, v, *new[k])]
        found = [(r._change_type, r._commit_version, *row(r)) for r in table.changes(since, until).collect()]
        assert sorted(found, key=str) == sorted(expected, key=str)
    assert table.changes(8).count() == 0


def test_changes_where_empty_updates_are_ignored(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), Upsert(("k",), "seq", buckets=2, ignore_null_updates=True))
    for number, batch in enumerate([[("a", "1", 7, 1)], [("a", None, None, 3)], [("a", "2", None, 2)], [("a", "late", 0, 0)]]):
        table.upsert(rows(spark, *batch), number)
    assert state(table) == {"a": ("2", 7)}
    found = sorted((r._commit_version, r._change_type, r.v, r.w, r.seq) for r in table.changes(0).collect())
    assert found == [(1, INSERT, "1", 7, 1), (2, AFTER, "1", 7, 3), (2, BEFORE, "1", 7, 1), (3, AFTER, "2", 7, 3), (3, BEFORE, "1", 7, 3)]


def test_streams_into_and_out_of_a_table(spark, tmp_path):
    source, table = str(tmp_path / "in"), MergeTable(spark, str(tmp_path / "t"), GONE)
    seen = []

    def push(*batch):
        rows(spark, *batch).write.mode("append").parquet(source)
        stream = stream_folder(spark, source, rows(spark).schema)
        runs.finish(runs.merge_stream(stream, table, str(tmp_path / "c"), compact_after=2))

    def follow(name="f"):
        take = lambda changes, stream, version: seen.extend((r._change_type, r.k, version) for r in changes.collect())
        runs.finish(runs.change_stream(table, str(tmp_path / name), take))

    push(("a", "1", 1, 1))
    follow()
    push(("a", "2", 1, 2))
    push(("a", "gone", 1, 3), ("b", "1", 1, 1))
    follow()
    follow()
    last = table.versions()[-1]
    assert seen[0] == (INSERT, "a", 1) and sorted(seen[1:]) == sorted([(BEFORE, "a", last), (AFTER, "a", last), (DELETE, "a", last), (INSERT, "b", last)])
    assert any(x.base for x in table.manifest().live)
    table.vacuum(keep=1)
    seen.clear()
    follow("late")
    assert seen == [(INSERT, "b", last)]
    assert merge_table.PART not in table.read().columns
