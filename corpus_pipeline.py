"""The corpus pipeline: language, near duplicates, repeated passages, benchmark passages, token ids.

Each stage takes (spark, documents, folder of the tables) and gives a frame, which ``run`` writes below the shared folder and
reads again for the next stage. All but the last give the columns of ``documents``:

* ``language`` drops documents without a letter and those of which no language makes up half;
* ``near_duplicates`` keeps the document of the smallest id of each group at a similarity of 0.8 on shingles of five words;
* ``repeated_passages`` cuts the words that windows of 35 words repeat anywhere; other texts stay as they are;
* ``benchmark`` drops documents that hold a benchmark item, or 13 tokens of one in a row;
* ``tokens`` gives doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers) and whether they decode to the very text.

Rows with a null id pass the second to fourth stage unless their text is judged otherwise; repeated ids are one document.
SQL cannot express the first, second and last stage, so there is no ``ORACLE_SQL``; the tests compare with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import bpe_recursive, fm_index, language_mixture, superminhash, templates
from claimlake.llm.common import held_out, scratch, table
from claimlake.llm.queries import vocabulary, workers_find_us

ORACLE_SQL = None
OTHERS = "_other_columns"


def packed(docs: DataFrame) -> DataFrame:
    """Id and text, and all other columns in one, so that none of them can bear the name of a column an operator adds."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(None).alias("none")]).alias(OTHERS))


def unpacked(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, with those that changed where ``docs`` has them."""
    known = {"doc_id": F.col("doc_id"), "text": F.col("text"), **changed}
    return rows.select(*[known.get(c, F.col(OTHERS)[c]).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_us(spark)
    model = language_mixture.learn(docs.where(~held_out("doc_id", 4, 2) & F.col("doc_id").isNotNull()))
    judged = language_mixture.predict(packed(docs), model)
    return unpacked(judged.where((F.col("lang_pred") != language_mixture.UNKNOWN) & (F.col("score") >= 0.5)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_us(spark)
    found = superminhash.near_duplicates(docs.select("doc_id", "text"), width=5)
    dropped = found.where("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return unpacked(packed(docs).join(dropped, F.col("doc_id") == F.col("_dropped"), "left_anti"), docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_find_us(spark)
    cut = fm_index.remove(packed(docs))
    whole = F.col("n_removed") == 0
    changed = cut.withColumn("text", F.when(whole, F.col("text")).otherwise(F.col("kept_text")))
    if "n_chars" not in docs.columns:
        return unpacked(changed, docs)
    return unpacked(changed, docs, n_chars=F.when(whole, F.col(OTHERS)["n_chars"]).otherwise(F.length("text").cast("long")))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = templates.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    hit = found.select(F.col("doc_id").alias("_hit")).distinct()
    return unpacked(packed(docs).join(hit, F.col("doc_id").eqNullSafe(F.col("_hit")), "left_anti"), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    workers_find_us(spark)
    coded = bpe_recursive.round_trip(docs.select("doc_id", "text"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "n_tokens", "ids", exact.alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark", benchmark),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
