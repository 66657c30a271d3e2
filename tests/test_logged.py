"""A log written by the batches of a stream: the same after a crash anywhere."""

import json

import pytest
from pyspark.sql import functions as F

from claimlake.operators import quality
from claimlake.operators.eventlog import expectation_metrics, flow_metrics
from claimlake.sources.tables import stream_folder
from claimlake.streaming import logged, runs

RULES = [quality.required("k"), quality.Rule("positive", "v > 0")]


def entries(log):
    rows = log.read().select("origin.flow_name", "details").collect()
    return sorted((r.flow_name, json.dumps(json.loads(r.details), sort_keys=True)) for r in rows)


@pytest.mark.parametrize("lost", [None, "write", "commit"])
def test_log_after_a_crash(spark, tmp_path, monkeypatch, lost):
    source = str(tmp_path / "in")
    for n in range(3):
        spark.createDataFrame([(None, n), ("a", -n), ("b", 5)], "k string, v int").coalesce(1).write.mode("append").parquet(source)
    log = logged.BatchLog(spark, str(tmp_path / "log"), "p", "claims")
    run = lambda: runs.finish(logged.logged_stream(
        stream_folder(spark, source, spark.read.parquet(source).schema, files_per_batch=1), RULES, str(tmp_path / "out"), str(tmp_path / "c"), log, "rows"))
    if lost == "write":
        whole = logged.BatchLog.write

        def crash(self, stream, batch_id, *rest):
            if batch_id == 1:
                raise RuntimeError("lost")
            whole(self, stream, batch_id, *rest)

        with monkeypatch.context() as broken:
            broken.setattr(logged.BatchLog, "write", crash)
            with pytest.raises(Exception, match="lost"):
                run()
    run()
    if lost == "commit":
        for name in ("2", ".2.crc"):
            (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
        run()
    assert len(entries(log)) == 3 and spark.read.parquet(str(tmp_path / "out")).count() == 9
    flow = flow_metrics(log.read()).first()
    assert (flow.total_output_records, flow.total_expectation_dropped_records) == (6, 3)
    rules = expectation_metrics(log.read()).agg(F.sum("passing_records"), F.sum("failing_records")).first()
    assert tuple(rules) == (6 + 5, 3 + 4)
