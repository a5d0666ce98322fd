"""Chat formatting: typed content parts flattened into a template, with a loss mask, and read back."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueloom.llm.common import as_list, pieces_of

START, END = "<|im_start|>", "<|im_end|>"
_BREAK = "<|br|>"
ASSISTANT = "assistant"

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PATCH = 14
TOKENS_A_SECOND = 25
TOKENS_A_PAGE = 256

_MARK = re.compile(r"<(\\*)\|")
_MARKED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No control string is left: a backslash is put inside each ``<|``, and one more where there are some."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _MARKED.sub(r"<\1|", text)


class PartVisitor:
    """Flattens a turn's parts: texts are escaped, other parts become numbered placeholders.

    A part of an unknown kind is an attachment of no tokens. Null kinds are text,
    null texts and sizes empty.
    """

    def __init__(self) -> None:
        self.written: list[str] = []
        self.length = 0
        self.texts: list[tuple[int, int]] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        text = escape(part.get("text") or "")
        self.texts.append((self.length, self.length + len(text)))
        self._write(text)

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil((part.get(k) or 0) / PATCH) for k in ("width", "height"))
        self._attach(part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part.get("seconds") or 0.0) * TOKENS_A_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach(part, (part.get("pages") or 0) * TOKENS_A_PAGE)

    def visit_other(self, part: dict) -> None:
        self._attach(part, 0)

    def _attach(self, part: dict, tokens: int) -> None:
        place = len(self.attachments)
        kind = part.get("kind")
        self.attachments.append({"place": place, "kind": kind, "ref": part.get("ref"), "tokens": tokens})
        self._write(f"<|{escape(kind)}:{place}|>")

    def _write(self, text: str) -> None:
        self.written.append(text)
        self.length += len(text)


def format_turn(role: str | None, parts: list[dict] | None) -> dict:
    """One turn in the template, the code point ranges of its learned texts, and its attachments."""
    role = role or ""
    head = f"{START}{escape(role).replace('\n', _BREAK)}\n"
    visitor = PartVisitor()
    for part in parts or []:
        if part is not None:
            visitor.visit(part)
    learned = visitor.texts if role == ASSISTANT else []
    return {
        "formatted": head + "".join(visitor.written) + END + "\n",
        "loss": [{"start": len(head) + a, "end": len(head) + b} for a, b in learned],
        "attachments": visitor.attachments,
        "attached_tokens": sum(a["tokens"] for a in visitor.attachments),
    }


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and content (placeholders left as they are) of a formatted turn."""
    head, _, rest = formatted.removeprefix(START).partition("\n")
    return unescape(head.replace(_BREAK, "\n")), unescape(rest[: -len(END) - 1])


_FORMATTED = (
    "conv_id long, turn long, formatted string, loss array<struct<start:int,end:int>>, "
    "attachments array<struct<place:int,kind:string,ref:string,tokens:int>>, attached_tokens long"
)
_FORMATTED_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("formatted", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        (
            "attachments",
            pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int32())])),
        ),
        ("attached_tokens", pa.int64()),
    ]
)


def text_parts(text: str = "text") -> Column:
    """A plain text column as one part."""
    empty = [F.lit(None).alias(name) for name in ("ref", "width", "height", "seconds", "pages")]
    part = F.struct(F.lit("text").alias("kind"), F.col(text).cast("string").alias("text"), *empty)
    return F.array(part).cast(f"array<{PART}>")


def format_chat(turns: DataFrame) -> DataFrame:
    """Format ``turns`` (conv_id, turn, role, parts: array of ``PART``), each row by itself.

    A conversation is its rows' ``formatted`` by turn, one after the other. Any
    text survives: control strings inside are escaped reversibly. Under the loss
    mask are the texts of assistant turns, without the template and placeholders.
    Null roles are empty, null or empty parts give an empty content. Nothing is
    moved between tasks, so conversations may be of any length. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            done = [format_turn(*x) for x in zip(as_list(batch, "role"), as_list(batch, "parts"), strict=True)]
            ids = zip(as_list(batch, "conv_id"), as_list(batch, "turn"), strict=True)
            rows = [{"conv_id": c, "turn": t, **d} for (c, t), d in zip(ids, done, strict=True)]
            yield pa.RecordBatch.from_pylist(rows, _FORMATTED_ARROW)

    narrow = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        "parts",
    )
    return narrow.mapInArrow(run, _FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation as read from ``format_chat``'s output.

    ``turns_sha256`` over role, line feed, text, line feed of every turn;
    ``loss_sha256`` and ``loss_chars`` over the unescaped text under the loss mask;
    ``formatted_chars`` code points in all. Conversations are digested as sorted
    streams, so their length is not bound by memory. Turns of equal number are
    taken in the order of their formatted text. Rows of a null conv_id are one conversation.
    """
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        rows: list[list] = []

        def closed() -> list:
            conv, n, turns, chars, loss, size = now
            return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), size]

        for batch in batches:
            columns = (as_list(batch, c) for c in ("conv_id", "formatted", "loss"))
            for conv, text, loss in zip(*columns, strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        rows.append(closed())
                    now = [conv, 0, sha256(), 0, sha256(), 0]
                role, content = read_turn(text)
                now[1] += 1
                now[2].update(f"{role}\n{content}\n".encode("utf-8", "surrogatepass"))
                for span in loss:
                    learned = unescape(text[span["start"] : span["end"]])
                    now[3] += len(learned)
                    now[4].update(learned.encode("utf-8", "surrogatepass"))
                now[5] += len(text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                rows = []
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(closed(), types, strict=True)], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(run, schema)
