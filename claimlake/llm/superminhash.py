"""Near-duplicate groups: SuperMinHash signatures, banding, exact confirmation, connected components.

A document's set holds the hashes of its distinct shingles of ``width`` words (A-Z lower-cased); with fewer words the whole
sequence is its one shingle. Each element draws a random permutation of the signature's components step by step and offers
(step + fraction) to the component it meets; drawing stops as soon as no later step can lower any component. Documents whose
values agree in all ``rows`` components of one of ``bands`` bands share a bucket; with 50 bands of 6, a pair at similarity 0.8
misses all of them once in four million times.

Pairs are not expanded. Documents with equal sets are one representative. Every member of a bucket is compared with the
bucket's smallest member on full sets. Where the members of a bucket then lie in several components, pairs across components
are compared too, but for those that are ruled out by the triangle inequality of the Jaccard distance (via the smallest
member), by their set sizes, or by how many of their shingles any other such document has at all: heavily edited copies of one
text have too many of their own. Of what is left, parity bits of the sets bound from below how many shingles two documents do
not share, which rules out nearly all pairs below the threshold unless the sets have thousands of shingles. One bit and one byte
of every signature component rule out pairs five standard deviations below it. Members of a bucket's largest component are not paired with each other. So all links that sharing a bucket can give
are in the components, though not all are listed.

Defined results: a null text, an empty one and one of blanks have an empty set and are linked with nothing. Rows of one
``doc_id`` are linked if their sets are. A row with a null id belongs to the component of its set, or to none (null).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import broadcast

from claimlake.llm.common import arrow_map, slices, stored
from claimlake.llm.words import mix, words_of

GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    table = words_of(texts, lower=True)
    h, first = table.hash, table.first
    n = np.diff(first)
    grams = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for i in range(width):
        grams = mix(grams + h[i : len(h) - width + 1 + i] + np.uint64(i + 1)) if len(grams) else grams
    out = []
    for a, size in zip(first[:-1].tolist(), n.tolist(), strict=True):
        if size >= width:
            out.append(np.unique(grams[a : a + size - width + 1]))
        elif size:
            whole = np.zeros(1, np.uint64)
            for i in range(size):
                whole = mix(whole + h[a + i : a + i + 1] + np.uint64(1000 * size + i))
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(elements: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash of distinct elements: step in the upper 32 bits of each component, fraction in the lower."""
    found = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    if not len(elements):
        return found
    rows = np.arange(len(elements))
    order = None
    for step in range(m):
        drawn = mix(elements + np.uint64(int(GOLD) * (step + 1) % 2**64))
        pick = (((drawn >> np.uint64(32)) * np.uint64(m - step)) >> np.uint64(32)).astype(np.int64) + step
        if step == 0:
            met, first_pick = pick, pick
        else:
            if order is None:
                order = np.tile(np.arange(m, dtype=np.uint16), (len(elements), 1))
                order[rows, first_pick] = 0
                order[:, 0] = first_pick
            met = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, step]
            order[:, step] = met
        np.minimum.at(found, met, (np.uint64(step) << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF)))
        if int(found.max() >> np.uint64(32)) <= step:
            break
    return found


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    table = values[: bands * rows].reshape(bands, rows)
    keys = mix(np.arange(bands, dtype=np.uint64) + GOLD)
    for i in range(rows):
        keys = mix(keys + table[:, i])
    return keys.view(np.int64)


def low_bits(values: np.ndarray) -> np.ndarray:
    """One bit of every component, packed into 64-bit numbers: the share of equal bits is (1 + similarity) / 2."""
    bits = np.zeros(-(-len(values) // 64) * 64, np.uint8)
    bits[: len(values)] = values & np.uint64(1)
    return np.packbits(bits).view(np.int64)


def most_unlike(components_: int, similarity: float, deviations: float = 5.0) -> int:
    """Differing bits that a pair at ``similarity`` exceeds once in three million times."""
    differ = (1 - similarity) / 2
    return int(components_ * differ + deviations * (components_ * differ * (1 - differ)) ** 0.5)


def least_alike(components_: int, similarity: float, deviations: float = 5.0) -> int:
    """Equal components that a pair at ``similarity`` falls short of once in three million times."""
    return int(components_ * similarity - deviations * (components_ * similarity * (1 - similarity)) ** 0.5)


def parity_bits(elements: np.ndarray, longs: int) -> np.ndarray:
    """For each of 64 * ``longs`` bits, whether an odd number of elements meets it.

    An element that only one of two sets has flips one bit, so the bits in which the sets differ are at most the elements they
    do not share.
    """
    spots = (mix(elements ^ GOLD) % np.uint64(64 * longs)).astype(np.int64)
    odd = (np.bincount(spots, minlength=64 * longs) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def summaries(docs: DataFrame, width: int, bands: int, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, s1, s2, buckets, bits, octets): size and 128-bit digest of each set, its bucket in each band, and one bit and
    one byte of each signature component."""

    def work(batch: dict) -> dict:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "n": [], "s1": [], "s2": [], "buckets": [], "bits": [], "octets": []}
        for at in slices([len(t or "") for t in batch["text"]], 500_000):
            for found in shingle_sets(batch["text"][at], width):
                one, two = mix(found + GOLD).sum(dtype=np.uint64), mix(found ^ GOLD).sum(dtype=np.uint64)
                out["n"].append(len(found))
                out["s1"].append(int(one.view(np.int64)))
                out["s2"].append(int(two.view(np.int64)))
                values = signature(found, bands * rows)
                out["buckets"].append(band_keys(values, bands, rows) if len(found) else [])
                out["bits"].append(low_bits(values))
                out["octets"].append((values & np.uint64(0xFF)).astype(np.uint8).view(np.int8))
        return out

    rows_ = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return arrow_map(rows_, work, "doc_id long, n long, s1 long, s2 long, buckets array<long>, bits array<long>, octets array<tinyint>")


def texts_of(ids: DataFrame, docs: DataFrame, key: str, text: str, most_broadcast: int = 4_000_000) -> DataFrame:
    """(id, text) of the documents in ``ids``; so many ids are broadcast, which spares the other texts the shuffle."""
    ids = stored(ids.distinct(), "ids")
    side = broadcast(ids) if ids.count() <= most_broadcast else ids
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(side, "id")
    return texts.groupBy("id").agg(F.min("text").alias("text"))


def common_shingles(texts: DataFrame, width: int) -> DataFrame:
    """(id, common): how many of a document's shingles any other document of ``texts`` (id, text) has too."""

    def work(batch: dict) -> dict:
        sets = [s for at in slices([len(t or "") for t in batch["text"]], 500_000) for s in shingle_sets(batch["text"][at], width)]
        ids_ = np.repeat(np.array(batch["id"], np.int64), [len(s) for s in sets])
        return {"id": ids_, "shingle": np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)}

    rows = stored(arrow_map(texts, work, "id long, shingle long"), "shingles")
    several = rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    return rows.join(several, "shingle").groupBy("id").agg(F.count("*").alias("common"))


def parities(texts: DataFrame, width: int, longs: int = 64) -> DataFrame:
    """(id, parity): the parity bits of each document's set."""

    def work(batch: dict) -> dict:
        sets = (s for at in slices([len(t or "") for t in batch["text"]], 500_000) for s in shingle_sets(batch["text"][at], width))
        return {"id": batch["id"], "parity": [parity_bits(s, longs) for s in sets]}

    return arrow_map(texts, work, "id long, parity array<long>")


def confirm(pairs: DataFrame, docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, common, union_size) of (a, b) id pairs, from the full sets of both texts."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    texts = stored(texts_of(ids, docs, key, text), "texts")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def work(batch: dict) -> dict:
        held: dict[int, np.ndarray] = {}
        common, union = [], []
        for b, text_a, text_b in zip(batch["b"], batch["text_a"], batch["text_b"], strict=True):
            if b not in held:
                if len(held) > 256:
                    held.clear()
                held[b] = shingle_sets([text_b], width)[0]
            one, two = shingle_sets([text_a], width)[0], held[b]
            both_ = len(np.intersect1d(one, two, assume_unique=True))
            common.append(both_)
            union.append(len(one) + len(two) - both_)
        return {"a": batch["a"], "b": batch["b"], "common": common, "union_size": union}

    return arrow_map(both, work, "a long, b long, common long, union_size long")


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id in ``links`` (a, b): the smallest id that links lead to.

    Alternating large and small stars; each round is written below the shared folder. The rounds end when a round leaves the
    edges as they were.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = None
    while True:
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m")).distinct()
        edges = stored(small.where("a <> b"), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "id")
    return roots.union(roots.select(F.col("root").alias("id"), "root").distinct())


def near_duplicates(
    docs: DataFrame, width: int = 4, percent: int = 80, bands: int = 50, rows: int = 6, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; links are pairs with 100 * common >= percent * union."""
    all_rows = stored(summaries(docs, width, bands, rows, key, text), "sets")
    full = all_rows.where("n > 0")
    reps = stored(full.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("buckets").alias("buckets"), F.first("bits").alias("bits"), F.first("octets").alias("octets")), "representatives")
    placed = reps.where("rep IS NOT NULL").select("rep", "n", F.posexplode("buckets").alias("band", "bucket"))
    shared = placed.groupBy("bucket").agg(F.min("rep").alias("centre"), F.count("*").alias("size")).where("size > 1").select("bucket", "centre")
    members = stored(placed.join(shared, "bucket"), "members")
    judged = stored(confirm(members.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct(), docs, width, key, text), "judged")
    links = judged.where(f"100 * common >= {percent} * union_size").select("a", "b")
    first = stored(components(links), "components")

    reach = 1 - percent / 100
    named = members.join(first.withColumnRenamed("id", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    per_root = named.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    open_ = per_root.groupBy("bucket").agg(F.count("*").alias("roots"), F.max(F.struct("size", "root")).alias("top")).where("roots > 1")
    apart = named.join(open_.select("bucket", F.col("top.root").alias("main")), "bucket")
    apart = apart.join(judged.select(F.col("a").alias("rep"), F.col("b").alias("centre"), (1 - F.col("common") / F.col("union_size")).alias("far")), ["rep", "centre"], "left")
    apart = apart.withColumn("far", F.coalesce("far", F.lit(0.0))).withColumn("ring", F.floor(F.col("far") / reach).cast("int"))
    apart = stored(apart.where("rep <> centre").select("band", "bucket", "rep", "n", "root", "far", "ring", (F.col("root") == F.col("main")).alias("in_main")), "apart")
    texts = stored(texts_of(apart.select(F.col("rep").alias("id")), docs, key, text), "texts")
    shared_part = common_shingles(texts, width).withColumnRenamed("id", "rep")
    apart = apart.join(shared_part, "rep").where(f"100 * common >= {percent} * n")
    apart = apart.join(parities(texts, width).withColumnRenamed("id", "rep"), "rep")
    apart = stored(apart.join(reps.select("rep", "bits", "octets", F.transform("buckets", lambda b: b.bitwiseAND(0x7FFFFFFF).cast("int")).alias("marks")), "rep"), "linkable")
    small = apart.where("NOT in_main").withColumn("ring", F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1)))
    x, y = small.alias("x"), apart.alias("y")
    near = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.ring") == F.col("y.ring")) & (F.col("x.root") != F.col("y.root"))
    near &= F.abs(F.col("x.far") - F.col("y.far")) <= reach + 1e-9
    both = F.least("x.common", "y.common")
    near &= 100 * both >= percent * (F.col("x.n") + F.col("y.n") - both)
    longs = -(-bands * rows // 64)
    unlike = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(longs)), F.lit(0))
    near &= unlike <= most_unlike(bands * rows, percent / 100)
    near &= (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")) & (F.col("y.in_main") | (F.col("x.rep") < F.col("y.rep")))
    # exact: the bits that differ are at most the shingles that only one of the two has
    odd = F.aggregate(F.zip_with("x.parity", "y.parity", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, n: total + n)
    near &= (100 + percent) * odd <= (100 - percent) * (F.col("x.n") + F.col("y.n"))
    alike = F.size(F.filter(F.zip_with("x.octets", "y.octets", lambda a, b: a == b), lambda same: same))
    near &= alike >= least_alike(bands * rows, percent / 100)
    # a pair that shares several buckets is made in the first of them
    near &= F.array_position(F.zip_with("x.marks", "y.marks", lambda a, b: a == b), F.lit(True)) == F.col("x.band") + 1
    across = x.join(y, near).select(F.greatest("x.rep", "y.rep").alias("a"), F.least("x.rep", "y.rep").alias("b")).distinct()
    across = stored(across.join(judged.select("a", "b"), ["a", "b"], "left_anti"), "across")
    more = stored(confirm(across, docs, width, key, text), "judged").where(f"100 * common >= {percent} * union_size").select("a", "b")
    if more.isEmpty():
        final = first
    else:
        final = components(first.select(F.col("id").alias("a"), F.col("root").alias("b")).union(more))
    final = final.groupBy("id").agg(F.min("root").alias("root"))

    by_set = reps.select("s1", "s2", "rep").join(final.withColumnRenamed("id", "rep"), "rep", "left")
    by_set = by_set.select("s1", "s2", F.coalesce("root", "rep").alias("component"))
    found = all_rows.select("doc_id", "n", "s1", "s2").join(by_set, ["s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


