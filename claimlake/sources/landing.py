"""Landing folders: the registry of datasets, their paths, and the CSV files found in a folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.schemas import ENTITIES, Entity
from claimlake.sources.paths import exists


@dataclass(frozen=True)
class LandingDataset:
    """One dataset below a landing folder and the bronze table it fills."""

    entity: Entity

    @property
    def subdir(self) -> str:
        return self.entity.name

    @property
    def table(self) -> str:
        return f"bronze_{self.entity.table}"

    def source_path(self, landing: str) -> str:
        return f"{landing.rstrip('/')}/{self.subdir}"

    def schema_path(self, state: str) -> str:
        return f"{state.rstrip('/')}/{self.subdir}/schema"

    def checkpoint_path(self, state: str) -> str:
        return f"{state.rstrip('/')}/{self.subdir}/checkpoints"


DATASETS = tuple(LandingDataset(entity) for entity in ENTITIES.values())


def list_csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name) of the CSV files in a folder, whatever the case of their extension; contents stay unread."""
    if not exists(spark, folder):
        raise FileNotFoundError(f"no folder {folder}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name")).orderBy("path")
