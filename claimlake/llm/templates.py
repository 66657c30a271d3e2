"""Benchmark decontamination by template windows, in DataFrame functions only.

Numbers, units and names become typed placeholders, so a question with other figures or persons keeps its template. A name is a
capitalised word that starts no sentence. Every window of ``width`` tokens is hashed with numbers and units replaced, and once
more with names replaced if it holds one, so that a passage in capitals is found too. Documents' windows are joined by hash with
those of the benchmark; items of fewer tokens (``least`` or more) are matched whole. Windows that follow one another in both
texts form a run. A run counts if it has ``tokens_needed`` tokens, or covers its whole item, and if the values in its
placeholders correspond one to one: the same item value always to the same value of the document, and the other way round.
Values that differ mark a re-parameterised question. Where they do not correspond, the verbatim stretches of the run count.

The benchmark's windows are broadcast if there are at most ``most_broadcast`` of them, else the join shuffles. Hashes only
find candidates: the tokens of a run are compared themselves before it counts.

Defined results: null and empty texts have no tokens and match nothing. Items of fewer than ``least`` tokens are too short to
tell and match nothing. Equal items all count. Rows of one doc_id that are repeated give each item once; a null doc_id or
item_id matches like any other and is returned as null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import broadcast

from claimlake.llm.common import stored

# a number with its inner points and commas, or a run of letters and marks, or a currency or per cent sign
TOKEN = r"(?:\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{M}]+|[%$€£°])"
OPENING = r"(?:^\P{L}*|[.!?:…][^\p{L}\p{N}]*\s|\n[^\p{L}\p{N}]*)?"  # what makes the next word the first of a sentence
UNITS = (
    "% $ € £ ° mm cm m km mg g kg t ml l s min h hour hours minute minutes second seconds day days week weeks month months year years meter meters "
    "metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre litres mile miles foot feet inch inches "
    "pound pounds ounce ounces dollar dollars euro euros cent cents percent"
).split()
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"


def tokens(text: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({TOKEN})"), F.lit(1))


def openings(text: str) -> Column:
    """The same tokens, those that start a sentence with what stands before them."""
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({OPENING}{TOKEN})"), F.lit(1))


def is_number(word: Column) -> Column:
    return (F.ascii(word) >= 48) & (F.ascii(word) <= 57)


def plain(words: Column) -> Column:
    """Lower-cased words, numbers and units replaced."""
    return F.transform(words, lambda w: F.when(is_number(w), NUMBER).when(F.lower(w).isin(UNITS), UNIT).otherwise(F.lower(w)))


def named(words: Column, plain_words: Column, opened: Column) -> Column:
    """``plain_words`` with names replaced."""
    cased = F.zip_with(words, opened, lambda w, o: (w == o) & (F.lower(w) != w) & (F.substring(w, 2, 100) == F.lower(F.substring(w, 2, 100))))
    return F.zip_with(plain_words, cased, lambda w, c: F.when(c & ~w.isin(NUMBER, UNIT), NAME).otherwise(w))


def hashed(tokens_: Column, width: int) -> Column:
    """(place, hash) of every window of ``width`` tokens."""
    last = F.size(tokens_) - width
    one = lambda i: F.struct(i.alias("place"), F.xxhash64(F.slice(tokens_, i + 1, F.lit(width)), F.lit(width)).alias("hash"))
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(F.array().cast("array<struct<place:int,hash:bigint>>"))


def windows(frame: DataFrame, width: int) -> Column:
    """(place, hash) of the windows of ``plain``, and of those windows of ``named`` that hold a name."""
    last = F.size("named") - width
    spots = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_contains(F.slice("named", i + 1, F.lit(width)), NAME))
    one = lambda i: F.struct(i.alias("place"), F.xxhash64(F.slice("named", i + 1, F.lit(width)), F.lit(width)).alias("hash"))
    none = F.array().cast("array<struct<place:int,hash:bigint>>")
    return F.concat(hashed(F.col("plain"), width), F.when((last >= 0) & F.array_contains("named", NAME), F.transform(spots, one)).otherwise(none))


def forms(frame: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns with ``words``, ``plain`` and ``named`` of ``text``."""
    cut = frame.select(*kept, tokens("text").alias("words"), openings("text").alias("opened"))
    cut = cut.withColumn("plain", plain(F.col("words")))
    return cut.withColumn("named", named(F.col("words"), F.col("plain"), F.col("opened"))).drop("opened")


def benchmark_windows(benchmark: DataFrame, width: int, least: int) -> tuple[DataFrame, list[int]]:
    """(item_id, size, wide, at, hash) rows and the widths that occur: ``width``, and those of shorter items."""
    items = forms(benchmark, "item_id").withColumn("size", F.size("words")).where(F.col("size") >= least)
    shorter = sorted(r[0] for r in items.where(F.col("size") < width).select("size").distinct().collect())
    parts = [items.where(F.col("size") == n).select("item_id", "size", F.lit(n).alias("wide"), F.explode(windows(items, n)).alias("w")) for n in shorter]
    parts.append(items.where(F.col("size") >= width).select("item_id", "size", F.lit(width).alias("wide"), F.explode(windows(items, width)).alias("w")))
    return reduce(DataFrame.union, parts).select("item_id", "size", "wide", F.col("w.place").alias("at"), F.col("w.hash").alias("hash")), [*shorter, width]


def slots_of(pairs: str) -> Column:
    return F.array_distinct(F.filter(pairs, lambda p: p["kind"] != ""))


def corresponds(pairs: str, slots: str) -> Column:
    """Whether all pairs match and the values of their placeholders correspond one to one."""
    owns = F.array_distinct(F.transform(slots, lambda p: F.struct(p["own"], p["kind"])))
    its = F.array_distinct(F.transform(slots, lambda p: F.struct(p["its"], p["kind"])))
    return ~F.exists(pairs, lambda p: p["kind"].isNull()) & (F.size(slots) == F.size(owns)) & (F.size(slots) == F.size(its))


def ends(pairs: str, breaks: Callable[[Column], Column]) -> Column:
    """The places of the pairs that break a run, with one before the first and one after the last."""
    places = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: breaks(F.get(pairs, i)))
    return F.concat(F.array(F.lit(-1)), places, F.array(F.size(pairs)))


def between(pairs: str, ends_: str, need: Column) -> Column:
    """The stretches of ``pairs`` between neighbouring ends, of ``need`` tokens or more."""
    one = lambda k: F.slice(pairs, F.get(ends_, k - 1) + 2, F.get(ends_, k) - F.get(ends_, k - 1) - 1)
    return F.filter(F.transform(F.sequence(F.lit(1), F.size(ends_) - 1), one), lambda p: F.size(p) >= need)


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 8, least: int = 4, tokens_needed: int = 13, most_broadcast: int = 2_000_000) -> DataFrame:
    """(doc_id, item_id, n_tokens, coverage, n_slots, changed_slots): the longest run of each item in each document it is in."""
    found, widths = benchmark_windows(benchmark, width, least)
    found = stored(found, "benchmark-windows")
    side = broadcast(found) if found.count() <= most_broadcast else found
    words = forms(docs, "doc_id")
    placed = reduce(DataFrame.union, [words.select("doc_id", F.lit(n).alias("wide"), F.explode(windows(words, n)).alias("w")) for n in widths])
    placed = placed.select("doc_id", "wide", F.col("w.place").alias("place"), F.col("w.hash").alias("hash"))
    hits = placed.join(side, ["hash", "wide"]).select("doc_id", "item_id", "size", "wide", "at", (F.col("place") - F.col("at")).alias("shift"))
    hits = hits.distinct()
    along = Window.partitionBy("doc_id", "item_id", "shift", "size", "wide").orderBy("at")
    runs = hits.withColumn("island", F.col("at") - F.row_number().over(along)).groupBy("doc_id", "item_id", "shift", "size", "wide", "island")
    runs = runs.agg(F.min("at").alias("start"), F.max("at").alias("end")).withColumn("n_tokens", F.col("end") - F.col("start") + F.col("wide"))
    runs = stored(runs.where(F.col("n_tokens") >= F.least("size", F.lit(tokens_needed))), "runs")

    ids = runs.select("doc_id").distinct()
    texts = docs.join(ids.withColumnRenamed("doc_id", "_hit"), F.col("doc_id").eqNullSafe(F.col("_hit"))).select("doc_id", tokens("text").alias("words"))
    item_words = benchmark.select("item_id", tokens("text").alias("item_words"))
    item_words = item_words.where(F.size("item_words") >= least).distinct()
    lined = runs.alias("r").join(texts.alias("t"), F.col("r.doc_id").eqNullSafe(F.col("t.doc_id"))).select("r.*", "words")
    lined = lined.alias("r").join(item_words.alias("i"), F.col("r.item_id").eqNullSafe(F.col("i.item_id")) & (F.size("item_words") == F.col("size"))).select("r.*", "item_words")
    own = F.slice("words", F.col("start") + F.col("shift") + 1, F.col("n_tokens"))
    its = F.slice("item_words", F.col("start") + 1, F.col("n_tokens"))
    lined = lined.where((F.col("start") + F.col("shift") >= 0) & (F.size(own) == F.col("n_tokens"))).withColumn("own", own).withColumn("its", its)
    pair = F.zip_with(
        "own", "its", lambda o, i: F.struct(
            F.lower(o).alias("own"), F.lower(i).alias("its"),
            F.when(is_number(o) & is_number(i), NUMBER).when(F.lower(o).isin(UNITS) & F.lower(i).isin(UNITS), UNIT)
            .when((F.lower(i) != i) & ((F.lower(o) != o) | (F.lower(o) == F.lower(i))), NAME).when(F.lower(o) == F.lower(i), "").alias("kind"),
        ),
    )
    lined = lined.withColumn("pairs", pair).withColumn("slots", slots_of("pairs")).withColumn("whole", corresponds("pairs", "slots"))
    need = F.least("size", F.lit(tokens_needed))
    split = lined.where(~F.col("whole")).withColumn("differing", ends("pairs", lambda p: p["kind"].isNull() | (p["own"] != p["its"])))
    split = split.withColumn("pairs", F.explode(between("pairs", "differing", need)))
    split = split.withColumn("slots", slots_of("pairs"))
    columns = ("doc_id", "item_id", "size", "pairs", "slots")
    judged = lined.where("whole").select(*columns).unionByName(split.select(*columns)).withColumn("n_tokens", F.size("pairs"))
    best = judged.select(
        "doc_id", "item_id", "n_tokens", (F.col("n_tokens") / F.col("size")).alias("coverage"), F.size("slots").alias("n_slots"),
        F.size(F.filter("slots", lambda p: p["own"] != p["its"])).alias("changed_slots"),
    )
    top = F.max(F.struct("n_tokens", (-F.col("changed_slots")).alias("same"), "n_slots", "coverage", "changed_slots")).alias("top")
    best = best.groupBy("doc_id", "item_id").agg(top)
    return best.select("doc_id", "item_id", *(F.col(f"top.{c}").alias(c) for c in ("n_tokens", "coverage", "n_slots", "changed_slots")))
