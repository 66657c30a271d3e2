"""Claims land in files whose number follows the order lines, so no task takes a share that grows with them."""

from pathlib import Path

from claimlake.sources.paths import size
from claimlake.workload import tables as t


def test_files_grow_with_the_order_lines(spark, tmp_path, monkeypatch):
    folder = tmp_path / "lineitem.parquet"
    assert size(spark, str(folder)) == 0 and t.landed_files(spark, str(tmp_path), 2) == 2
    folder.mkdir()
    for name in "ab":
        (folder / name).write_bytes(b"x" * 500)
    monkeypatch.setattr(t, "LANDED", 100)
    assert size(spark, str(folder)) == 1000 == 2 * size(spark, str(Path(folder, "a")))
    assert t.landed_files(spark, str(tmp_path), 2) == 10 and t.landed_files(spark, str(tmp_path), 30) == 30
