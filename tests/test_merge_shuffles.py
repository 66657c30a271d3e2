"""Merge tables bring a row together with the others of its key once: reads of one delta and change feeds."""

import random

import pytest

from claimlake.sinks import merge_table
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert

SCHEMA = "k string, v string, w int, seq int"


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def filled(spark, path, spec, compacted=()):
    rng, table = random.Random(5), MergeTable(spark, path, spec)
    for number in range(5):
        rows = [(rng.choice([None, *"abcdefgh"]), rng.choice(["1", "2", None, "gone"]), rng.choice([None, 1]), rng.randrange(4)) for _ in range(7)]
        table.upsert(spark.createDataFrame(rows, SCHEMA), number)
        if number in compacted:
            table.compact()
    return table


def test_one_delta_is_read_as_it_lies_and_changes_shuffle_once(spark, tmp_path):
    table = filled(spark, str(tmp_path / "t"), Upsert(("k",), "seq", buckets=2, deleted="v = 'gone'"))
    assert shuffles(table.read(1)) == 0 and shuffles(table.read(2)) == 1
    assert shuffles(table.changes(3, 5)) == 1


@pytest.mark.parametrize("more", [{"deleted": "v = 'gone'"}, {"ignore_null_updates": True}])
@pytest.mark.parametrize("compacted", [(), (1,)])
def test_changes_are_the_same_whether_other_keys_leave_first(spark, tmp_path, monkeypatch, more, compacted):
    table = filled(spark, str(tmp_path / "t"), Upsert(("k",), "seq", buckets=2, **more), compacted)
    last = table.versions()[-1]
    for since in (0, 2, 3):
        found = []
        for few in (0, 10**9):  # rows of other keys leave always, never
            monkeypatch.setattr(merge_table, "FEW", few)
            found.append(sorted((tuple(r) for r in table.changes(since, last).collect()), key=str))
        assert found[0] == found[1] and found[0]
        merge = {r.k: (r.v, r.w, r.seq) for r in table.read(since).collect()} if since else {}
        for r in sorted(table.changes(since, last).collect(), key=lambda r: (r._commit_version, r._change_type != "update_preimage")):
            row = (r.v, r.w, r.seq)
            if r._change_type in ("delete", "update_preimage"):
                assert merge.pop(r.k) == row
            else:
                assert r.k not in merge
                merge[r.k] = row
        assert merge == {r.k: (r.v, r.w, r.seq) for r in table.read(last).collect()}
