"""Paths on whatever file system the session uses: existence, removal, names as a reader takes them."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    """Asked of the Hadoop file system, so that a first run needs no failed read to find out."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def decoded(path: Column) -> Column:
    """A file path of Spark's metadata column without its URL encoding (``%20``); a plus is a plus."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal(path: str) -> str:
    """A path whose brackets, braces and stars are not read as a pattern."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in files.listStatus(target)) if files.exists(target) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all that lies in a folder; 0 if there is no such path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(target).getLength() if files.exists(target) else 0


def read_text(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    opened = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place as a whole, or not at all: False if something has that name already.

    It is written under a hidden name and renamed, which the file system does in one step.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    hidden = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    files = target.getFileSystem(conf)
    out = files.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    no_overwriting = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(hidden, target, no_overwriting)
    except Py4JJavaError:
        files.delete(hidden, False)
        if files.exists(target):
            return False
        raise
    return True
