"""Chat formatting with typed content parts (operator 8).

A turn's content is a text or a list of typed parts.  A visitor flattens the
parts in order: text stays text, each image, audio or document part becomes
one placeholder and one attachment record (number, kind, reference, tokens
that the placeholder expands to).  Turns are marked by control strings; a
backslash before a control string or a backslash inside a text makes it plain
text, so the formatted string can always be read back exactly.

    system     [SYS]text[/SYS]
    user       [INST]text[/INST]
    assistant  <s>text</s>
    others     [TURN]role[:]text[/TURN]

The loss mask covers exactly the (escaped) contents of assistant turns, as
ranges of code points.

Rows are sorted within their conversation by Spark and formatted as a stream:
a task holds one conversation at a time.

Input handling: null text is empty, a null role is the empty role; rows with
equal (conv_id, turn) follow each other by role and text, null turns come
first; rows with a null conv_id are one conversation; an empty table gives
none; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
FRAMES = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[TURN]", "[:]", "[/TURN]")
CONTROLS = [*(m for pair in FRAMES.values() for m in pair), *OTHER, *PLACEHOLDERS.values()]
_ESCAPE = re.compile("|".join(re.escape(c) for c in ["\\", *CONTROLS]))
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TOKEN = re.compile(r"\\.|" + "|".join(re.escape(c) for c in CONTROLS), re.S)

PATCH = 14                 # side in pixels of a patch that is one token of an image
AUDIO_TOKENS = 25          # tokens of a second of audio
PAGE_TOKENS = 256          # tokens of a page of a document

PART = ("struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")
ATTACHMENT = "struct<number:int,kind:string,ref:string,tokens:long>"
SCHEMA = ("conv_id long, n_turns long, formatted string, loss array<struct<s:long,e:long>>, "
          f"attachments array<{ATTACHMENT}>, expanded_tokens long")


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@dataclass
class PartVisitor:
    """Flattens typed parts; numbers attachments through a conversation."""

    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> str:
        kind = part.get("type") or "text"
        return getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def visit_image(self, part: dict) -> str:
        across, down = (math.ceil(max(part.get(k) or 0, 1) / PATCH) for k in ("width", "height"))
        return self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> str:
        return self._attach("audio", part, max(math.ceil((part.get("seconds") or 0) * AUDIO_TOKENS), 1))

    def visit_document(self, part: dict) -> str:
        return self._attach("document", part, max(part.get("pages") or 0, 1) * PAGE_TOKENS)

    def visit_unknown(self, part: dict) -> str:
        raise ValueError(f"unknown content part type: {part.get('type')!r}")

    def _attach(self, kind: str, part: dict, tokens: int) -> str:
        self.attachments.append({"number": len(self.attachments), "kind": kind, "ref": part.get("ref"),
                                 "tokens": tokens})
        return PLACEHOLDERS[kind]


class Conversation:
    """One conversation being formatted."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.length = conv_id, 0, 0
        self.out: list[str] = []
        self.loss: list[dict] = []
        self.visitor = PartVisitor()

    def add(self, role: str | None, text: str | None, parts: list[dict] | None = None) -> None:
        role = role or ""
        # A plain text is a conversation's commonest part.
        body = "".join(map(self.visitor.visit, parts or [{"type": "text", "text": text}]))
        if role in FRAMES:
            opening, closing = FRAMES[role]
        else:
            opening, closing = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
        if role == "assistant":
            start = self.length + len(opening)
            self.loss.append({"s": start, "e": start + len(body)})
        self.out += [opening, body, closing]
        self.length += len(opening) + len(body) + len(closing)
        self.turns += 1

    def row(self) -> list:
        found = self.visitor.attachments
        return [self.conv_id, self.turns, "".join(self.out), self.loss, found, sum(a["tokens"] for a in found)]


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn; placeholders stay in the text as they are."""
    turns: list[tuple[str, str]] = []
    opened = {o: (r, c) for r, (o, c) in FRAMES.items()}
    role, closing, start, at = None, None, 0, 0
    for m in _TOKEN.finditer(formatted):
        token = m[0]
        if closing is None:
            if m.start() != at:
                raise ValueError("text outside a turn")
            role, closing = opened.get(token, (None, OTHER[2]))
            if role is None and token != OTHER[0]:
                raise ValueError(f"unexpected {token!r}")
            start = m.end()
        elif token == OTHER[1] and role is None:
            role, start = unescape(formatted[start:m.start()]), m.end()
        elif token == closing:
            turns.append((role or "", unescape(formatted[start:m.start()])))
            role, closing, at = None, None, m.end()
    if closing is not None or at != len(formatted):
        raise ValueError("unfinished turn")
    return turns


_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
    ("attachments", pa.list_(pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()),
                                        ("tokens", pa.int64())]))),
    ("expanded_tokens", pa.int64())])


def _format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: Conversation | None = None
    done: list[list] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = zip(*done) if done else ([] for _ in _ARROW)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    for rows in batches:
        for conv_id, role, text, parts in zip(*(c.to_pylist() for c in rows.columns)):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.row())
                    size += current.length
                    if size > 1 << 22:
                        yield batch()
                        done, size = [], 0
                current = Conversation(conv_id)
            current.add(role, text, parts)
    if current is not None:
        done.append(current.row())
        yield batch()


def format_chats(turns: DataFrame) -> DataFrame:
    """One row for each conversation of ``turns`` (conv_id, turn, role, text,
    and optionally ``parts``, an array of typed parts that replaces the text)."""
    parts = F.col("parts") if "parts" in turns.columns else F.lit(None)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text",
                        parts.cast(f"array<{PART}>").alias("parts"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text", "parts").mapInArrow(_format_batches, SCHEMA)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns, loss = [], []
        for formatted, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            turns.append([{"role": r, "text": t} for r, t in parse(formatted)])
            loss.append("".join(unescape(formatted[x["s"]:x["e"]]) for x in spans))
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(turns, kind), pa.array(loss, pa.string()), batch.column(1)],
            ["conv_id", "turns", "loss_text", "formatted"])


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss_text and formatted, read back from
    formatted conversations."""
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        _parse_batches, "conv_id long, turns array<struct<role:string,text:string>>, loss_text string, formatted string")
