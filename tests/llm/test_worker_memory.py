"""What a Python worker holds."""

import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from claimlake.llm import common


def test_workers_do_without_the_machine_learning_package():
    code = "import sys, claimlake.llm.language_mixture, claimlake.llm.bpe_recursive, claimlake.llm.superminhash; sys.exit('pyspark.ml' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2]).returncode == 0


def test_batches_are_cut_before_they_become_objects(spark):
    seen = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))

    def sizes(batches):
        yield {"n": [len(b["text"]) for b in batches]}

    found = [r.n for r in common.arrow_partitions(seen, sizes, "n long", cut=True).collect()]
    assert sum(found) == 200 and max(found) <= 90
