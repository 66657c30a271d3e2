"""The latest row per key from Spark's state: late rows, ties, restarts, timers."""

import datetime

from pyspark.sql import functions as F

from claimlake.operators.latest import latest_by
from claimlake.sinks.merge_table import MergeTable
from claimlake.sinks.upsert import Upsert
from claimlake.sources.tables import stream_folder
from claimlake.streaming import current, runs

SCHEMA = "k string, seq int, v string, at timestamp"


def day(n):
    return datetime.datetime(2025, 1, 1) + datetime.timedelta(days=n)


def push(spark, folder, *rows):
    spark.createDataFrame([(k, seq, v, day(n)) for k, seq, v, n in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return stream_folder(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_late_rows_ties_and_a_restart(spark, tmp_path):
    source, spec = str(tmp_path / "in"), Upsert(("k",), "seq", buckets=2)
    table = MergeTable(spark, str(tmp_path / "t"), spec)
    batches = [
        [("a", 2, "x", 1), ("b", 1, "x", 1), (None, 1, "n", 1)],
        [("a", 1, "late", 2), ("b", 1, "y", 2), ("b", None, "z", 2)],
        [("a", 2, None, 3), ("c", 9, "x", 3), (None, 2, "m", 3)],
    ]
    for rows in batches:  # every call is a restart from the checkpoint
        runs.finish(current.keep_latest(push(spark, source, *rows), table, ["seq"], str(tmp_path / "c")))
    found = {r.k: (r.seq, r.v) for r in table.read().collect()}
    assert found == {"a": (2, "x"), "b": (1, "y"), "c": (9, "x"), None: (2, "m")}
    whole = latest_by(spark.read.parquet(source), ["k"], ["seq"])
    assert found == {r.k: (r.seq, r.v) for r in whole.collect()}
    assert current.latest_rows(spark.read.parquet(source), ["k"], ["seq"]).exceptAll(whole).count() == 0


def test_idle_keys_are_settled_and_let_go(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(*rows):
        stream = push(spark, source, *rows)
        latest = current.latest_until_idle(stream, ["k"], ["seq"], "at", "3 days")
        runs.finish(runs.append_to_folder(latest, out, str(tmp_path / "c")))
        return sorted((r.k, r.seq, r.v, r._settled, r._late_rows) for r in spark.read.parquet(out).collect())

    assert run(("a", 2, "x", 0), ("b", 1, "x", 0)) == [("a", 2, "x", False, 0), ("b", 1, "x", False, 0)]
    after = run(("a", 1, "late", 1), ("b", 3, "y", 1))
    assert ("b", 3, "y", False, 0) in after and len(after) == 3
    done = run(("c", 1, "x", 20))
    assert ("a", 2, "x", True, 1) in done and ("b", 3, "y", True, 0) in done and ("c", 1, "x", False, 0) in done
    assert run(("a", 1, "older than the watermark", 2), ("c", 2, "y", 21))[-1] == ("c", 2, "y", False, 0)
    settled = spark.read.parquet(out).where(F.col("_settled"))
    assert settled.count() == 2 and spark.read.parquet(out).where("k = 'a'").count() == 2
