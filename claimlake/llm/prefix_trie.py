"""The trie of conversation prefixes, found by blocks of turns first.

A conversation is a chain: each prefix has a digest made of the one before it and the next turn. The chain is cut into blocks of
``block`` prefixes, and conversations are grouped by the digest at the end of each block (``_grouped``). Where all that share the
beginning of a block also share its end, the block's prefixes are nodes as they are. Only blocks whose siblings diverge are
opened, and their prefixes grouped turn by turn; that works on distinct blocks with a weight, so thousands of copies are one row.

A node belongs to its smallest conversation, its owner; what a conversation owns is the end of its chain. So sums over subtrees
need no walk up or down the trie. A node's subtree is, for each of its members, the part of the member's chain that it owns, and
the part it shares with a smaller one is what a cache would save: both follow from where the member's own part begins. Nodes of a
single conversation are told from that conversation alone; the others add up their members, combined before the shuffle.

Digests are 128 bits and texts never leave the map side. A task holds one block of a conversation and the leader's first turns;
a conversation's turns and the ids of those that end at one node are read in order, one at a time, as their digests demand.

Turns are ordered by turn, null first, repeated numbers by their digest. Null roles and texts are empty; rows of a null id
belong to no conversation and are left out; repeated rows are turns. An empty table gives no node, not even the root. Columns
besides id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import _arrow_schema, stored

WORD = r"[^\x20\x09-\x0D]+"
ROOT = b"\0" * 16
BLOCKS = "conv_id bigint, block bigint, parent binary, points array<binary>, said array<bigint>, before bigint, last boolean"
ENDS = "point binary, n_ends bigint, ends_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()
FLUSH = 20_000


def _digested(chats: DataFrame, lead: Column | None, heads: Column | None) -> DataFrame:
    """Turns as digest and number of words, with the leader of their conversation and how many turns it takes from it."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return chats.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        (F.col("conv_id") if lead is None else lead).cast("bigint").alias("lead"),
        (F.lit(0) if heads is None else heads).cast("int").alias("heads"),
        F.unhex(F.md5(named)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )


class _Chain:
    """Block rows of one conversation as its turns come."""

    def __init__(self, conv_id: int, size: int) -> None:
        self.conv_id, self.size = conv_id, size
        self.block, self.parent, self.before, self.total = 0, b"", 0, 0
        self.points, self.said = [ROOT], [0]

    def add(self, digest: bytes, words: int) -> tuple | None:
        """Take a turn in; the block before it, if that is full."""
        full = None
        point = hashlib.md5(self.points[-1] + digest).digest()
        if len(self.points) == self.size:
            full = self.row(False)
            self.block, self.parent, self.before = self.block + 1, self.points[-1], self.total
            self.points, self.said = [], []
        self.total += words
        self.points.append(point)
        self.said.append(self.total)
        return full

    def row(self, last: bool) -> tuple:
        return self.conv_id, self.block, self.parent, self.points, self.said, self.before, last


def _blocks(chats: DataFrame, size: int, lead: Column | None, heads: Column | None, most_heads: int) -> DataFrame:
    """The chains as rows of blocks; ``said`` is the words up to each prefix, ``before`` those up to the block.

    A conversation begins with the first ``heads`` turns of its leader in place of as many of its own.
    """
    ordered = (
        _digested(chats, lead, heads)
        .repartition("lead")
        .sortWithinPartitions("lead", F.col("conv_id") != F.col("lead"), "conv_id", F.col("turn").asc_nulls_first(), "digest")
    )
    target = _arrow_schema(chats.sparkSession, BLOCKS)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chain, leader, first, number = None, None, [], 0
        for batch in batches:
            columns = batch.to_pydict()
            for conv, lead_id, taken, digest, words in zip(*(columns[c] for c in ("conv_id", "lead", "heads", "digest", "words")), strict=True):
                if chain is None or conv != chain.conv_id:
                    if chain is not None:
                        rows.append(chain.row(True))
                    if lead_id != leader:
                        leader, first = lead_id, []
                    chain, number = _Chain(conv, size), 0
                    if conv != leader:
                        rows += [r for turn in first[:taken] if (r := chain.add(*turn))]
                if conv == leader and number < most_heads:
                    first.append((digest, words))
                if conv == leader or number >= taken:
                    full = chain.add(digest, words)
                    if full:
                        rows.append(full)
                number += 1
                if len(rows) >= FLUSH:
                    yield _batch(rows, target)
                    rows = []
        if chain is not None:
            rows.append(chain.row(True))
        if rows:
            yield _batch(rows, target)

    return ordered.mapInArrow(loop, BLOCKS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _ends(blocks: DataFrame) -> DataFrame:
    """Per prefix that is a whole conversation: how many there are, and the digest of their ids in ascending order."""
    ends = blocks.where("last").select(F.element_at("points", -1).alias("point"), "conv_id")
    target = _arrow_schema(blocks.sparkSession, ENDS)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        at, n, digest = None, 0, None
        for batch in batches:
            for point, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if point != at:
                    if at is not None:
                        rows.append((at, n, digest.hexdigest()))
                    at, n, digest = point, 0, hashlib.sha256()
                digest.update((b"," if n else b"") + str(conv).encode())
                n += 1
            if len(rows) >= FLUSH:
                yield _batch(rows, target)
                rows = []
        if at is not None:
            rows.append((at, n, digest.hexdigest()))
        if rows:
            yield _batch(rows, target)

    return ends.repartition("point").sortWithinPartitions("point", "conv_id").mapInArrow(loop, ENDS)


def _opened(blocks: DataFrame, size: int, *carried: str) -> DataFrame:
    """One row per prefix of each block row: depth, point, the prefix before it, and the words up to both."""
    points = blocks.select(*carried, "block", "parent", "points", "said", "before", F.posexplode("points").alias("spot", "point"))
    earlier = F.when(F.col("spot") == 0, F.col("parent")).otherwise(F.get("points", F.col("spot") - 1))
    before = F.when(F.col("spot") == 0, F.col("before")).otherwise(F.get("said", F.col("spot") - 1))
    return points.select(*carried, (F.col("block") * size + F.col("spot")).alias("depth"), "point", earlier.alias("parent"), before.alias("before"))


def _grouped(blocks: DataFrame, size: int) -> DataFrame:
    """The nodes: depth, point, parent, before, n_convs and conv_id, their smallest member.

    The first block is always opened, as all conversations share its beginning.
    """
    content = ["block", "parent", "points", "said", "before"]
    counted = [F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")]
    groups = stored(blocks.groupBy(*content).agg(*counted), "prefix-blocks")
    siblings = groups.where("block > 0").groupBy("block", "parent").agg(F.count(F.lit(1)).alias("siblings"))
    later = groups.where("block > 0").join(siblings, ["block", "parent"])
    diverging = groups.where("block = 0").unionByName(later.where("siblings > 1").drop("siblings"))
    kept = ["depth", "point", "parent", "before"]
    refined = _opened(diverging, size, "n_convs", "conv_id").groupBy(*kept).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    undivided = _opened(later.where("siblings = 1"), size, "n_convs", "conv_id").select(*kept, "n_convs", "conv_id")
    return refined.unionByName(undivided)


def prefix_trie(
    chats: DataFrame, *, block: int = 4, lead: Column | None = None, heads: Column | None = None, most_heads: int = 0
) -> DataFrame:
    """Nodes of the trie of conversations (conv_id, turn, role, text).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (for all nodes of the
    subtree, the words of a node's last text for each member after its first) and ends_sha256 (ids of the conversations that end
    at the node). ``lead`` names each conversation's leader, whose first ``heads`` turns, ``most_heads`` at most, stand in
    place of its own; both are expressions of conv_id, and a leader that has no row lends no turns.
    """
    blocks = stored(_blocks(chats, block, lead, heads, most_heads), "prefix-chains")
    nodes = stored(_grouped(blocks, block).join(_ends(blocks), "point", "left").fillna({"n_ends": 0, "ends_sha256": NOTHING}), "prefix-nodes")
    owned = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("owns"),
        F.min("before").alias("shared_words"),
        F.max(F.when(F.col("n_ends") == F.col("n_convs"), 1).otherwise(0)).alias("leaf"),
        F.min(F.when(F.col("n_convs") == 1, F.col("depth"))).alias("alone"),
    )
    whole = blocks.where("last").select(
        "conv_id", (F.col("block") * block + F.size("points") - 1).alias("length"), F.element_at("said", -1).alias("total")
    )
    chains = whole.join(owned, "conv_id", "left")
    shared = _shared_sums(blocks, chains, block)
    placed = nodes.join(owned.select("conv_id", "owns"), "conv_id")
    first = (F.col("depth") == F.col("owns")) & (F.col("depth") > 0)
    owners = nodes.where("n_convs > 1").select(F.col("point").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    within = placed.where(~first).withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    branching = placed.where(first).join(owners, "parent")
    named = within.unionByName(branching)
    alone = named.where("n_convs = 1").withColumns(
        {
            "n_children": F.when(F.col("n_ends") == 1, 0).otherwise(1).cast("bigint"),
            "n_leaves": F.lit(1).cast("bigint"),
            "saved_tokens": F.lit(0).cast("bigint"),
        }
    )
    result = alone.unionByName(named.where("n_convs > 1").join(shared, "point"))
    return result.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _shared_sums(blocks: DataFrame, chains: DataFrame, size: int) -> DataFrame:
    """Children, leaves and saved words of the nodes of several conversations, added up over their members."""
    reach = F.coalesce("alone", F.lit(1 << 62))  # where a conversation is on its own
    members = _opened(
        blocks.join(chains, "conv_id").where(F.col("block") * size < reach), size, "owns", "shared_words", "leaf", "alone", "length", "total"
    ).where(F.col("depth") < reach)
    borrowed = F.when(F.col("owns").isNull(), F.col("total")).when(F.col("depth") < F.col("owns"), F.col("shared_words")).otherwise(F.col("before"))
    next_owned = (F.col("owns") <= F.col("depth") + 1) & (F.col("depth") + 1 <= F.col("length"))
    return members.groupBy("point").agg(
        F.sum(F.when(next_owned, 1).otherwise(0)).alias("n_children"),
        F.sum(F.coalesce("leaf", F.lit(0))).cast("bigint").alias("n_leaves"),
        F.sum(borrowed - F.col("before")).alias("saved_tokens"),
    )
