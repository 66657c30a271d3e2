"""Chat formatting of typed content parts.

A turn's content is a text or a list of parts: text, image, audio, document, or another kind. A visitor flattens the parts into one
string in which every attachment is a placeholder, and keeps beside it the attachment's reference, its place and the number of
tokens its placeholder stands for once expanded. The template marks turns as ``<|im_start|>role\\n...<|im_end|>\\n``; a text that
holds ``<|`` itself gets a backslash in between (one more, if there are some), so a control string in the output is always one
of the template's and ``unescape`` gives the text back.

``format_chats`` writes conversations as rows of whole turns: a conversation is one row, or several consecutive ones where it is
longer than ``most_chars``. A task holds one such row, never a whole conversation of unbounded length. The loss mask is the spans
of the assistant's texts. ``read_turns`` and ``digests`` read these rows and nothing else.

Rows are ordered by turn, null first, then role and text. Null roles and texts are empty, a null id is a conversation of its
own, repeated rows are repeated turns; a null list of parts is no content, a null part is left out, and so are sizes that are
null. Empty tables give empty tables. Columns besides id, turn, role, text and parts are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import _arrow_schema

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENT = "struct<turn_no: bigint, part_no: int, kind: string, ref: string, at: bigint, n_tokens: bigint>"
FORMATTED = (
    "conv_id bigint, row_no bigint, last boolean, start bigint, formatted string, "
    f"loss array<struct<start: bigint, end: bigint>>, attachments array<{ATTACHMENT}>, n_expanded bigint"
)
TURNS = "conv_id bigint, row_no bigint, position bigint, role string, parts array<struct<kind: string, text: string>>"
DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

START, END = "<|im_start|>", "<|im_end|>\n"
TEXT_AGAIN = "<|text|>"  # between two texts, which would read as one otherwise
KINDS = ("image", "audio", "document")
_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
_ROLE = str.maketrans({"\\": "\\\\", "\n": "\\n", "|": "\\p"})
_PLACEHOLDER = re.compile(r"(<\|[a-z]+\|>)")
FLUSH = 8 << 20  # characters of finished rows that a task holds before it hands them on


def escape(text: str) -> str:
    return _OPENING.sub(r"<\1\\|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return role.translate(_ROLE)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "p": "|"}.get(m[1], m[1]), role) if "\\" in role else role


@dataclass(frozen=True)
class Expansion:
    """How many tokens a placeholder stands for."""

    patch: int = 28  # side of the square of pixels that is one token
    per_second: float = 25.0
    per_page: int = 256
    unknown: int = 256  # where the size is not given

    def image(self, part: dict) -> int:
        if not part.get("width") or not part.get("height"):
            return self.unknown
        return math.ceil(part["width"] / self.patch) * math.ceil(part["height"] / self.patch)

    def audio(self, part: dict) -> int:
        return self.unknown if part.get("seconds") is None else math.ceil(part["seconds"] * self.per_second)

    def document(self, part: dict) -> int:
        return self.unknown if part.get("pages") is None else part["pages"] * self.per_page


@dataclass
class Visitor:
    """Flattens the parts of one turn; what it found lies in its fields."""

    expansion: Expansion
    pieces: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)  # of the texts
    attachments: list[dict] = field(default_factory=list)
    chars: int = 0
    after_text: bool = False

    def visit(self, number: int, part: dict) -> None:
        kind = part.get("kind") or "text"
        if kind == "text":
            self.visit_text(part.get("text") or "")
        elif kind in KINDS:
            self.visit_attachment(number, part, kind, getattr(self.expansion, kind)(part))
        else:
            self.visit_attachment(number, part, "attachment", self.expansion.unknown)

    def visit_text(self, text: str) -> None:
        if self.after_text:
            self._add(TEXT_AGAIN)
        escaped = escape(text)
        if escaped:
            self.spans.append((self.chars, self.chars + len(escaped)))
        self._add(escaped)
        self.after_text = True

    def visit_attachment(self, number: int, part: dict, placeholder: str, tokens: int) -> None:
        kind = part.get("kind")
        self.attachments.append({"part_no": number, "kind": kind, "ref": part.get("ref"), "at": self.chars, "n_tokens": tokens})
        self._add(f"<|{placeholder}|>")
        self.after_text = False

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.chars += len(piece)


@dataclass
class Row:
    """A row of the output as it grows."""

    conv_id: int | None
    row_no: int
    start: int
    pieces: list[str] = field(default_factory=list)
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    chars: int = 0

    def add(self, turn_no: int, role: str, parts: list[dict], learned: frozenset[str], expansion: Expansion) -> None:
        head = f"{START}{escape_role(role)}\n"
        visitor = Visitor(expansion)
        for number, part in enumerate(parts):
            visitor.visit(number, part)
        at = self.chars + len(head)
        if role in learned:
            self.loss += [{"start": at + a, "end": at + b} for a, b in visitor.spans]
        self.attachments += [{"turn_no": turn_no, **a, "at": self.start + at + a["at"]} for a in visitor.attachments]
        self.pieces += [head, *visitor.pieces, END]
        self.chars = at + visitor.chars + len(END)

    def closed(self, last: bool) -> tuple:
        tokens = sum(a["n_tokens"] for a in self.attachments)
        return self.conv_id, self.row_no, last, self.start, "".join(self.pieces), self.loss, self.attachments, tokens


def parts_of_json(content: Column) -> Column:
    """Parts from a JSON list of objects with the fields of ``PART``; a text that is no such list is one part of text."""
    found = F.from_json(content, f"array<{PART}>")
    whole = F.from_json(F.to_json(F.array(F.struct(F.lit("text").alias("kind"), content.alias("text")))), f"array<{PART}>")
    return F.when(F.ltrim(content).startswith("["), F.coalesce(found, whole)).otherwise(whole)


def format_chats(
    chats: DataFrame, *, learned: tuple[str, ...] = ("assistant",), expansion: Expansion | None = None, most_chars: int = 1 << 20
) -> DataFrame:
    """Rows (``FORMATTED``) of conversations with columns conv_id, turn, role and text or parts.

    ``start`` is the row's place in its conversation and counts code points, as do the places of attachments; the spans of
    the loss mask count from the row's own beginning.
    """
    typed = "parts" in chats.columns
    content = "parts" if typed else "text"
    tie = F.to_json(content) if typed else F.col(content)
    ordered = (
        chats.select("conv_id", "turn", "role", content)
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", tie)
    )
    target = _arrow_schema(chats.sparkSession, FORMATTED)
    settings = (frozenset(learned), expansion or Expansion())

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held, row, turn_no = 0, None, 0
        for batch in batches:
            columns = batch.to_pydict()
            for conv, role, body in zip(columns["conv_id"], columns["role"], columns[content], strict=True):
                if row is None or conv != row.conv_id:
                    if row is not None:
                        done.append(row.closed(True))
                    row, turn_no = Row(conv, 0, 0), 0
                elif row.chars >= most_chars:
                    done.append(row.closed(False))
                    row = Row(conv, row.row_no + 1, row.start + row.chars)
                parts = [p for p in body or () if p is not None] if typed else [{"text": body}]
                before = row.chars
                row.add(turn_no, role or "", parts, *settings)
                held, turn_no = held + row.chars - before, turn_no + 1
                if held >= FLUSH and done:
                    yield _rows(done, target)
                    done, held = [], row.chars
        if row is not None:
            done.append(row.closed(True))
        if done:
            yield _rows(done, target)

    return ordered.mapInArrow(loop, FORMATTED)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def parse_turns(formatted: str) -> Iterator[tuple[str, list[dict]]]:
    """(role, parts) of the turns of a formatted row; an attachment's text is None."""
    at = 0
    while at < len(formatted):
        line, end = formatted.find("\n", at), formatted.find(END, at)
        if not formatted.startswith(START, at) or not at < line < end:
            raise ValueError(f"no turn of the template at {at}")
        role, content = formatted[at + len(START) : line], formatted[line + 1 : end]
        at = end + len(END)
        parts: list[dict] = []
        after = None
        for piece in _PLACEHOLDER.split(content):
            if piece == TEXT_AGAIN:
                if after == TEXT_AGAIN or not parts or parts[-1]["kind"] != "text":
                    parts.append({"kind": "text", "text": ""})
                after = TEXT_AGAIN
            elif piece.startswith("<|"):
                parts.append({"kind": piece[2:-2], "text": None})
                after = piece
            elif piece:
                parts.append({"kind": "text", "text": unescape(piece)})
                after = None
        if after == TEXT_AGAIN:
            parts.append({"kind": "text", "text": ""})
        yield unescape_role(role), parts


def read_turns(formatted: DataFrame) -> DataFrame:
    """The turns of formatted rows (``TURNS``); ``position`` counts within the row, so that no row waits for another."""
    target = _arrow_schema(formatted.sparkSession, TURNS)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, number, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                turns = [(conv.as_py(), number.as_py(), i, *turn) for i, turn in enumerate(parse_turns(text.as_py()))]
                if turns:
                    yield _rows(turns, target)

    return formatted.select("conv_id", "row_no", "formatted").mapInArrow(loop, TURNS)


class _Reader:
    """Counts and digests of one conversation, from its rows in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.of_turns, self.of_loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, loss: list[dict]) -> None:
        self.chars += len(text)
        for role, parts in parse_turns(text):
            self.turns += 1
            said = "".join(p["text"] for p in parts if p["text"] is not None)
            self.of_turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
        for span in loss:
            said = unescape(text[span["start"] : span["end"]])
            self.loss_chars += len(said)
            self.of_loss.update(said.encode("utf-8", "surrogatepass"))

    def result(self) -> tuple:
        return self.conv_id, self.turns, self.of_turns.hexdigest(), self.loss_chars, self.of_loss.hexdigest(), self.chars


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation (``DIGESTS``) what its formatted rows hold: turns as role, \\n, text, \\n, and the text under the mask.

    A conversation of one row is read where it lies; the rows of the others are brought together in order, and read one by one.
    """
    rows = formatted.select("conv_id", "row_no", "last", "formatted", "loss")
    whole = (F.col("row_no") == 0) & F.col("last")
    ordered = rows.where(~whole).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "row_no")
    target = _arrow_schema(formatted.sparkSession, DIGESTS)

    def loop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            done = []
            for conv, number, last, text, loss in zip(*batch.columns, strict=True):
                if number.as_py() == 0:
                    reader = _Reader(conv.as_py())
                reader.read(text.as_py(), loss.as_py())
                if last.as_py():
                    done.append(reader.result())
            if done:
                yield _rows(done, target)

    return rows.where(whole).mapInArrow(loop, DIGESTS).unionByName(ordered.mapInArrow(loop, DIGESTS))
