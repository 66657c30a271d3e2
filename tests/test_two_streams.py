"""Two streams of one derivation read what a first one landed."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimlake.operators.projection import typed_claims
from claimlake.streaming import runs
from claimlake.workload import QUERIES, tables

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")
def test_two_streams_read_what_a_first_one_landed(spark, monkeypatch):
    landed, merged = [], []
    append, merge = runs.append_to_folder, runs.merge_stream
    monkeypatch.setattr(runs, "append_to_folder", lambda stream, target, *a, **b: landed.append(target) or append(stream, target, *a, **b))
    plan = lambda stream: stream._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(runs, "merge_stream", lambda stream, *a, **b: merged.append(plan(stream)) or merge(stream, *a, **b))
    found = QUERIES["upsert_two_streams"](spark, str(DATA))
    assert len(landed) == 1 and len(merged) == 2 and not any("l_orderkey" in p for p in merged)
    claims = typed_claims(tables.raw_claims(spark, str(DATA))).where("claim_id IS NOT NULL")
    assert found.agg(F.sum("snapshots")).first()[0] == claims.select("claim_id", "snapshot_date").distinct().count()
