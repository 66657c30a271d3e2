"""Queries that take batches of one derivation derive it once."""

from pathlib import Path

import pytest

from claimlake.workload import mart_queries, run_queries

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")
def test_batches_read_what_landed(spark, tmp_path):
    changes = run_queries._batched_changes(spark, str(DATA), str(tmp_path / "a"))
    claims = mart_queries._claim_batches(spark, str(DATA), str(tmp_path / "b"))
    for frame in (changes.where("batch = 1"), *claims):
        files = frame.inputFiles()
        assert files and all(str(tmp_path) in f for f in files)  # and none of the order lines
    assert changes.count() > 0 and {r.batch for r in changes.select("batch").distinct().collect()} == {0, 1, 2}
