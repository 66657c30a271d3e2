"""Repeated rows by fingerprint equal those by content, and move far fewer bytes."""

from pyspark.sql import functions as F

from claimlake.operators import fingerprints, report


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_groups_and_summary_equal_those_by_content(spark):
    rows = [("a", None, 1), ("a", None, 1), (None, "a", 1), (None, "a", 1), ("b", "", 2), ("b", None, 2), (None, None, None), (None, None, None), ("c", "x", 3)]
    df = spark.createDataFrame(rows, "x string, yz string, m int")
    for columns in (["x", "yz", "m"], ["m"]):
        by_content = report.duplicate_groups(df, columns)
        assert plain(fingerprints.duplicate_groups_by_fingerprint(df, columns)) == plain(by_content)
    assert plain(fingerprints.duplicate_summary_by_fingerprint(df.drop("yz"))) == plain(report.duplicate_summary(df.drop("yz")))
    assert plain(fingerprints.duplicate_summary_by_fingerprint(df.limit(0), ["m"])) == [(0, 0, 0, 0)]


def test_equal_fingerprints_of_different_rows_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "x string")
    monkeypatch.setattr(fingerprints, "fingerprint", lambda columns: [F.lit(1).alias(fingerprints.ONE), F.lit(1).alias(fingerprints.OTHER)])
    assert plain(fingerprints.duplicate_groups_by_fingerprint(df, ["x"])) == [("b", 2)]
    assert plain(fingerprints.duplicate_summary_by_fingerprint(df, ["x"])) == [(1, 2, 1, 3)]


def shuffled(spark, df):
    """Bytes that the shuffles of a run wrote, from its plan's metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    pending, total = [plan], 0
    while pending:
        node = pending.pop()
        metric = node.metrics().get("shuffleBytesWritten")
        total += metric.get().value() if metric.isDefined() else 0
        stage = node.getClass().getSimpleName()
        pending += [node.plan()] if stage.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_wide_rows_move_a_tenth(spark):
    wide = spark.range(5000).select(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(n))), 512).alias(f"c{n}") for n in range(12)])
    df = wide.union(wide.limit(3))
    by_fingerprint, by_content = fingerprints.duplicate_groups_by_fingerprint(df, df.columns), report.duplicate_groups(df, df.columns)
    assert shuffled(spark, by_fingerprint) * 10 < shuffled(spark, by_content)
    assert plain(by_fingerprint) == plain(by_content)
