"""Token ids in binary files: blocks of a fixed number of ids, transposed into byte or bit planes, each plane under zstandard.

A file holds ``MAGIC``, the planes of its blocks one after the other, the document table (ids and token counts), an index as
JSON (offset, ids and plane lengths of every block; place of the document table), the index's length as an unsigned 64-bit
number, and ``MAGIC`` again. Blocks cut across documents, so every block but the last is full, and a reader can fetch any
block, or any document, from the index alone. Files are written under a temporary name and renamed, one for each range of
ascending ``doc_id``: a task that runs again writes the same file again.

``Encoder`` gives the tokenizer's own ids but works on pieces between blanks, which it remembers: most pieces of a corpus
recur. Pieces whose normal form could differ (composed letters, unusual blanks, letters with special lower case, characters that
not every version of Unicode knows) and those that hold a special token always go through the library themselves.

Defined results: a null or empty text has only the end id. Strings of special tokens are what the library's call gives for
them. Rows of one
``doc_id`` follow one another in order of their text; null ids come last.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import arrow_partitions, file_system, numbered_ranges, scratch, shuffle_parts, slices

MAGIC = b"IDPLANE1"
NO_ID = -(2**63)
MOST_PIECES, MOST_WORDS = 600_000, 800_000
TOGETHER = 500  # pieces looked through at once
SIGNS = frozenset(",.;:!?")


@lru_cache(maxsize=1)
def recent() -> re.Pattern:
    """Characters that Unicode 3.2 did not have, or that take more than 16 bits: classes of later ones depend on the version a
    library was built with."""
    category = unicodedata.ucd_3_2_0.category
    unknown = [category(chr(c)) == "Cn" for c in range(0x10000)] + [True]
    edges = [c for c in range(0x10001) if unknown[c] != (c > 0 and unknown[c - 1])] + [0x110000]
    spans = zip(edges[::2], edges[1::2], strict=False)
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in spans) + "]")


class Encoder:
    """Ids of texts under a ``tokenizers`` file, remembered piece by piece; ids as little-endian unsigned 32-bit numbers."""

    # pieces in which the tokenizer's normal form may be more than lower case, or blanks may be read in another way
    _hard = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u0130\u03a3\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
    # fixed value: the split pattern of the tokenizer file
    _split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(special)) if special else None
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.by_piece: dict[str, bytes] = {}
        self.by_word: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [(t or "").split(" ") for t in texts]
        if len(self.by_piece) > MOST_PIECES:
            self.by_piece.clear()
        if len(self.by_word) > MOST_WORDS:
            self.by_word.clear()
        known = self.by_piece
        found = [list(map(known.get, pieces)) for pieces in split]
        missing = [[i for i, ids in enumerate(of_text) if ids is None] for of_text in found]
        self._learn(list({pieces[i] for pieces, spots in zip(split, missing, strict=True) for i in spots}))
        for pieces, of_text, spots in zip(split, found, missing, strict=True):
            for i in spots:
                of_text[i] = known[pieces[i]]
        return [b"".join(of_text) for of_text in found]

    def _learn(self, fresh: list[str]) -> None:
        hard: list[str] = []
        single: dict[str, str] = {}
        ended: dict[str, str] = {}  # one word and a sign
        mixed: dict[str, list[str]] = {}
        for at in range(0, len(fresh), TOGETHER):
            part = fresh[at : at + TOGETHER]
            if self._goes_to_the_library(" ".join(part)):
                hard += [p for p in part if self._goes_to_the_library(p)]
                part = [p for p in part if not self._goes_to_the_library(p)]
            for piece, low in zip(part, " ".join(part).lower().split(" "), strict=True) if part else ():
                if low.isalpha():
                    single[piece] = low
                elif low[-1:] in SIGNS and low[:-1].isalpha():
                    ended[piece] = low
                else:
                    mixed[piece] = self._split.findall(low)
        words = {*single.values(), *(low[:-1] for low in ended.values()), *(SIGNS if ended else ()), *chain.from_iterable(mixed.values())}
        self._learn_words(words.difference(self.by_word))
        known = self.by_word
        self.by_piece.update(zip(single, map(known.__getitem__, single.values()), strict=True))
        self.by_piece.update((piece, known[low[:-1]] + known[low[-1]]) for piece, low in ended.items())
        self.by_piece.update((piece, b"".join(map(known.__getitem__, found))) for piece, found in mixed.items())
        self.by_piece.update(zip(hard, self._library(hard), strict=True))

    def _goes_to_the_library(self, piece: str) -> bool:
        """Of a piece, or of several with blanks between them, of which one does."""
        if self._special and self._special.search(piece):
            return True
        if piece.isascii() and piece.isprintable():
            return False
        return bool(self._hard.search(piece) or recent().search(piece)) or not unicodedata.is_normalized("NFC", piece)

    def _learn_words(self, fresh: set[str]) -> None:
        """Many words in one text: the last id of each word is one that ends a word."""
        words = sorted(fresh)
        for at in range(0, len(words), 20_000):
            part = words[at : at + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                flat = ids.tobytes()
                edges = [0, *(cuts * 4).tolist()]
                self.by_word.update((w, flat[a:b]) for w, a, b in zip(part, edges, edges[1:], strict=False))
            else:
                self.by_word.update(zip(part, self._library(part), strict=True))

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(x.ids, "<u4").tobytes() for x in found]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of unsigned 32-bit ids, least significant first."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(octets[:, i]).tobytes() for i in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).copy().view("<u4").reshape(-1)
    bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").copy().view("<u4").reshape(-1)


def write_file(out, rows: Iterable[tuple[int | None, bytes]], block_ids: int = 65_536, kind: str = "byte", level: int = 1) -> dict:
    """Write (doc_id, ids) rows to a binary stream; gives the number of documents and ids."""
    packer = zstandard.ZstdCompressor(level=level)
    index: dict = {"block_ids": block_ids, "planes": kind, "blocks": []}
    keys, counts, waiting, held = [], [], [], 0
    at = out.write(MAGIC)

    def flush(data: bytes) -> int:
        planes = [packer.compress(p) for p in to_planes(np.frombuffer(data, "<u4"), kind)]
        index["blocks"].append([at, len(data) // 4, [len(p) for p in planes]])
        return out.write(b"".join(planes))

    size = block_ids * 4
    for key, ids in rows:
        keys.append(NO_ID if key is None else key)
        counts.append(len(ids) // 4)
        waiting.append(ids)
        held += len(ids)
        if held >= size:
            data = b"".join(waiting)
            whole = len(data) // size * size
            for i in range(0, whole, size):
                at += flush(data[i : i + size])
            waiting, held = [data[whole:]], len(data) - whole
    if held:
        at += flush(b"".join(waiting))
    docs = [packer.compress(np.array(x, "<i8").tobytes()) for x in (keys, counts)]
    index["documents"] = [at, len(docs[0]), len(docs[1])]
    text = json.dumps(index).encode()
    out.write(docs[0] + docs[1] + text + struct.pack("<Q", len(text)) + MAGIC)
    return {"n_docs": len(keys), "n_ids": int(sum(counts))}


def read_file(source, size: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, first id's place in the file, ids) of a seekable stream, one block in memory at a time."""

    def fetch(at: int, n: int) -> bytes:
        source.seek(at)
        return source.read(n)

    tail = fetch(size - 16, 16)
    if tail[8:] != MAGIC or fetch(0, 8) != MAGIC:
        raise ValueError("not a plane file, or one that was cut off")
    length = struct.unpack("<Q", tail[:8])[0]
    index = json.loads(fetch(size - 16 - length, length))
    unpack = zstandard.ZstdDecompressor()
    at, n_keys, n_counts = index["documents"]
    keys = np.frombuffer(unpack.decompress(fetch(at, n_keys)), "<i8")
    counts = np.frombuffer(unpack.decompress(fetch(at + n_keys, n_counts)), "<i8")

    blocks = iter(index["blocks"])
    held, place = np.empty(0, "<u4"), 0
    for key, count in zip(keys.tolist(), counts.tolist(), strict=True):
        parts, need = [], count
        while need:
            if not len(held):
                offset, n, lengths = next(blocks)
                edges = np.cumsum([0, *lengths])
                data = fetch(offset, int(edges[-1]))
                planes = [unpack.decompress(data[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
                held = from_planes(planes, n, index["planes"])
            parts.append(held[:need])
            need -= len(parts[-1])
            held = held[len(parts[-1]) :]
        yield None if key == NO_ID else key, place, np.concatenate(parts) if parts else np.empty(0, "<u4")
        place += count


def write(docs: DataFrame, folder: str, path: str, end_id: int = 1, key: str = "doc_id", text: str = "text", **form) -> list[dict]:
    """Encode every text, append ``end_id``, and write one file for each range of ascending ``key`` to ``folder``.

    Gives the files in order, with the number of ids before each; the driver sees one row for each file.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    ranged, n = numbered_ranges(rows, "doc_id", shuffle_parts(docs.sparkSession))
    ordered = ranged.repartitionById(n, F.col("range_id")).sortWithinPartitions("range_id", F.col("doc_id").asc_nulls_last(), "text")
    last = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        
        coder = encoder(path)
        first = next(batches, None)
        while first is not None and not first["doc_id"]:
            first = next(batches, None)
        if first is None:
            return
        spot = first["range_id"][0]

        def coded() -> Iterator[tuple[int | None, bytes]]:
            batch = first
            while batch is not None:
                for at in slices([len(t or "") for t in batch["text"]], 2_000_000):
                    for key_, ids in zip(batch["doc_id"][at], coder.encode(batch["text"][at]), strict=True):
                        yield key_, ids + last
                batch = next(batches, None)

        files, base = file_system(folder)
        files.create_dir(base, recursive=True)
        name = f"part-{spot:06d}.idp"
        draft = f"{base}/.{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            made = write_file(out, coded(), **form)
        files.move(draft, f"{base}/{name}")
        yield {"range_id": [spot], "file": [f"{folder}/{name}"], "n_docs": [made["n_docs"]], "n_ids": [made["n_ids"]]}

    found = arrow_partitions(ordered, work, "range_id int, file string, n_docs long, n_ids long").collect()
    before, out = 0, []
    for r in sorted(found):  # a sort in Spark would run the encoding once more for its sample
        out.append({"file": r.file, "before": before, "n_docs": r.n_docs, "n_ids": r.n_ids})
        before += r.n_ids
    return out


def read(spark, files: list[dict]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in ``files``, as ``write`` gave them."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame([(f["file"], f["before"]) for f in files], "file string, before long").repartition(len(files))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for name, before in zip(batch["file"], batch["before"], strict=True):
                store, path = file_system(name)
                with store.open_input_file(path) as source:
                    out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
                    for key, place, ids in read_file(source, source.size()):
                        out["doc_id"].append(key)
                        out["start"].append(before + place)
                        out["n_tokens"].append(len(ids))
                        out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                    yield out

    return arrow_partitions(listed, work, schema)


def encode_and_read(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` as plane files below the shared folder and read them back."""
    spark = docs.sparkSession
    return read(spark, write(docs, scratch(spark, "planes"), path, end_id))
