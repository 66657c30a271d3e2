"""Full refresh: compute a fresh version of an output beside the old one, then point readers at it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.sources.paths import exists


class Versions:
    """The versions of one output; an append-only log says which one is current."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _entries(self) -> DataFrame:
        return self.spark.read.schema("number int, name string").json(f"{self.root}/versions")

    def current(self) -> str | None:
        """Folder of the current version, None before the first refresh."""
        if not exists(self.spark, f"{self.root}/versions"):
            return None
        last = self._entries().orderBy(F.col("number").desc()).first()
        return f"{self.root}/{last['name']}" if last else None

    def refresh(self, build: Callable[[str, str], None]) -> str:
        """Run ``build(output, checkpoint)`` on empty folders and make the result current.

        Readers see the old version until the new one is whole; a failed build changes nothing.
        """
        number = 1
        if exists(self.spark, f"{self.root}/versions"):
            number += self._entries().agg(F.max("number")).first()[0] or 0
        name = f"v{number}-{uuid.uuid4().hex[:8]}"
        build(f"{self.root}/{name}", f"{self.root}/{name}-checkpoint")
        entry = self.spark.createDataFrame([(number, name)], "number int, name string")
        entry.coalesce(1).write.mode("append").json(f"{self.root}/versions")
        return f"{self.root}/{name}"
