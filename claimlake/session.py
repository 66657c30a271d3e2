"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles, splits skewed join partitions and picks broadcast joins from
# measured sizes, so no operator carries a broadcast hint of its own.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "claimlake", master: str | None = None, **extra: str) -> SparkSession:
    """Create or reuse a session with the engine's settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="claimlake-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a cluster a missing
    setting is an error, because a machine-local path would vanish with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or ""
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set: name a folder shared by all executors")
    return _local_folder()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one run."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
