"""Clustered layouts: equal results from fewer files."""

import datetime

import pytest
from pyspark.sql import functions as F

from claimlake.sinks import clustered


def test_ranges_read_few_files_and_all_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.hash("id") % 500).cast("int"))
    df = spark.range(20_000).select("id", F.when(F.col("id") % 50 > 0, day).alias("day"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).cast("decimal(9,1)").alias("v"))
    clustered.write_clustered(df, path, ["day", "v"], files=36, bits=6)
    total = clustered.files_of(spark, path, {}).count()
    start = datetime.date(2025, 1, 1)
    for bounds, test in (
        ({"day": (start, start + datetime.timedelta(60))}, "day BETWEEN DATE '2025-01-01' AND DATE '2025-01-01' + INTERVAL 60 DAYS"),
        ({"v": (90, None)}, "v >= 90"),
        ({"day": (None, start), "v": (None, 10)}, "day <= DATE '2025-01-01' AND v <= 10"),
        ({"v": (2000, None)}, "FALSE"),
    ):
        found = clustered.read_clustered(spark, path, bounds)
        assert found.exceptAll(df.where(test)).count() == 0 and found.count() == df.where(test).count()
        assert clustered.files_of(spark, path, bounds).count() <= total / 2
    assert clustered.read_clustered(spark, path).count() == 20_000 == clustered.files_of(spark, path, {}).agg(F.sum("rows")).first()[0]
    assert clustered.with_curve(df.limit(0), ["day", "v"]).count() == 0
    with pytest.raises(ValueError, match="string"):
        clustered.with_curve(df.withColumn("day", F.lit("x")), ["day"])
