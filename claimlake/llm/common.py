"""Helpers the operators of this package share: tables, ordered partitions, anchored files, Arrow loops."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.session import shared_folder

PIECE = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; a table written there cuts lineage and survives lost executors."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written below the shared folder and read again."""
    spark = frame.sparkSession
    path = scratch(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def file_system(uri: str):
    """Arrow file system and path of ``uri``: a local path, or whatever scheme Arrow knows."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def held_out(column: str, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; False for a null id."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def arrow_map(frame: DataFrame, work: Callable[[dict], dict], schema: str) -> DataFrame:
    """Each Arrow batch as a dict of Python lists through ``work``; the dict it returns is a batch of ``schema``."""
    names = frame.columns
    target = _arrow_schema(frame.sparkSession, schema)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            out = work({n: batch.column(i).to_pylist() for i, n in enumerate(names)})
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return frame.mapInArrow(loop, schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that about ``PIECE`` bytes at a time become Python objects, which take several times as much."""
    for batch in batches:
        rows = max(1, batch.num_rows * PIECE // max(batch.nbytes, 1))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def arrow_extend(frame: DataFrame, inputs: list[str], work: Callable[[dict], dict], added: str) -> DataFrame:
    """``frame`` with the columns of the DDL string ``added``, which ``work`` derives from ``inputs`` of a batch.

    Columns of those names that ``frame`` has already are replaced; the others pass through untouched.
    """
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(added).fields
    fresh = {f.name.lower() for f in fields}
    kept = [f for f in frame.schema.fields if f.name.lower() not in fresh]
    spots = [[f.name for f in frame.schema.fields].index(n) for n in inputs]
    stay = [i for i, f in enumerate(frame.schema.fields) if f.name.lower() not in fresh]
    target = _arrow_schema(frame.sparkSession, added)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            out = work({n: batch.column(i).to_pylist() for n, i in zip(inputs, spots, strict=True)})
            more = [pa.array(out[f.name], f.type) for f in target]
            names = [batch.schema.names[i] for i in stay] + target.names
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in stay] + more, names=names)

    return frame.mapInArrow(loop, StructType([*kept, *fields]))


def arrow_partitions(frame: DataFrame, work: Callable[[Iterator[dict]], Iterator[dict]], schema: str, cut: bool = False) -> DataFrame:
    """As ``arrow_map``, but ``work`` gets the whole iterator of a partition's batches and yields batches.

    The batches come as Spark makes them, or ``cut`` into pieces as those of ``arrow_map``.
    """
    names = frame.columns
    target = _arrow_schema(frame.sparkSession, schema)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dicts = ({n: batch.column(i).to_pylist() for i, n in enumerate(names)} for batch in (_pieces(batches) if cut else batches))
        for out in work(dicts):
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return frame.mapInArrow(loop, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def numbered_ranges(frame: DataFrame, key: str, parts: int, descending: bool = False) -> tuple[DataFrame, int]:
    """``frame`` with ``range_id``: consecutive ranges of ``key``, in order, and how many ranges there are.

    The bounds are quantiles of ``key`` (at most ``parts`` numbers on the driver), so one row always gets the same
    range however often it is computed; rows of one key share a range, and null keys have the last one.
    """
    from pyspark.ml.feature import Bucketizer  # only the driver has a use for it: 32 MB for each Python worker

    number = F.col(key).cast("double")
    steps = [i / parts for i in range(1, parts)]
    found = frame.select(number.alias("key")).where("key IS NOT NULL").approxQuantile("key", steps, 0.2 / parts) if steps else []
    bounds = sorted(set(found)) or [0.0]
    splits = [float("-inf"), *bounds, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_key", outputCol="_bucket", handleInvalid="keep")
    ranged = bucketed.transform(frame.withColumn("_key", F.coalesce(number, F.lit(float("nan")))))
    regular = len(splits) - 1
    spot = F.col("_bucket").cast("int")
    if descending:
        spot = F.when(spot < regular, F.lit(regular - 1) - spot).otherwise(spot)
    return ranged.withColumn("range_id", spot).drop("_key", "_bucket"), regular + 1


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices of at most ``most`` in sum, or of one item."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > most:
            yield slice(first, i)
            first, total = i, 0
        total += size
    if sizes:
        yield slice(first, len(sizes))
