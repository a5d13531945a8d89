"""Chat formatting: conversations rendered by a compiled template, with masks of what a model should learn to generate.

The turns of a conversation are brought together and put in order by Spark; a task then streams them through the template,
so that it holds one turn at a time however long a conversation is. The output are parts: a piece of formatted text with
the ranges of generated text in it. `digests` reads parts back, undoing the escapes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .chat_template import compiled, unescape

TEMPLATE = (
    "{% for m in messages %}### {{ m.role|escape_name }}:\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}{% else %}{{ m.text|escape }}{% endif %}"
    "</turn>\n{% endfor %}"
)
PART = 1 << 16
PARTS = "conv long, part long, formatted string, generated array<struct<start: int, stop: int>>"


def by_conversation(batches: common.Batches, width: int) -> Iterator[tuple]:
    """(conversation, iterator of its rows) for sorted batches; nothing is held beyond a batch."""
    rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(width))))
    yield from itertools.groupby(rows, key=lambda row: row[0])


def parts_of(pieces: Iterator[tuple[str, bool]], size: int = PART) -> Iterator[tuple[str, list[dict]]]:
    """Pieces gathered into parts of about `size` characters, with ranges of generated text."""
    texts: list[str] = []
    spans: list[dict] = []
    at = 0
    for text, generated in pieces:
        if generated:
            if spans and spans[-1]["stop"] == at:
                spans[-1]["stop"] = at + len(text)
            else:
                spans.append({"start": at, "stop": at + len(text)})
        texts.append(text)
        at += len(text)
        if at >= size:
            yield "".join(texts), spans
            texts, spans, at = [], [], 0
    if texts:
        yield "".join(texts), spans


def render(df: DataFrame, template: str = TEMPLATE, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", size: int = PART) -> DataFrame:
    """The formatted parts of every conversation: conv, part, formatted, generated (ranges of code points).

    Turns are ordered by turn (nulls first), role and text, so equal turn numbers and repeated rows have a fixed order.
    Rows with a null key are one conversation; null roles and texts are empty. An empty table gives no parts. Other
    columns aren't read.
    """
    compiled(template)  # a wrong template fails here, not in a task
    turns = df.select(F.col(key).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    dealt = turns.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    schema = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("generated", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])

    def run(batches: common.Batches) -> common.Batches:
        write = compiled(template)
        held, length = [], 0
        for conv, rows in by_conversation(batches, 4):
            messages = ({"role": r or "", "text": t or ""} for _, _, r, t in rows)
            for n, (formatted, spans) in enumerate(parts_of(write(messages), size)):
                held.append((conv, n, formatted, spans))
                length += len(formatted)
                if length >= 64 * size:
                    yield common.batch_of(schema, [list(x) for x in zip(*held)])
                    held, length = [], 0
        if held:
            yield common.batch_of(schema, [list(x) for x in zip(*held)])

    return dealt.mapInArrow(run, PARTS)


class Turns:
    """Reads formatted parts in order: the header, the text and the mask of each turn, with escapes undone."""

    def __init__(self) -> None:
        self.text = ""
        self.mask: list[tuple[int, int]] = []

    def feed(self, formatted: str, spans: list[dict]) -> Iterator[tuple[str, str, str]]:
        """(role, text, generated text) of every turn that is complete."""
        self.mask += [(len(self.text) + s["start"], len(self.text) + s["stop"]) for s in spans]
        self.text += formatted
        at = 0
        while (stop := self.text.find("</turn>\n", at)) >= 0:
            head, text = self.text[at:stop].split(":\n", 1)
            learned = "".join(self.text[max(a, at) : min(b, stop)] for a, b in self.mask if a < stop and b > at)
            yield unescape(head.removeprefix("### ")), unescape(text), unescape(learned)
            at = stop + len("</turn>\n")
            self.mask = [(a, b) for a, b in self.mask if b > at]
        self.text = self.text[at:]
        self.mask = [(a - at, b - at) for a, b in self.mask]


def digests(parts: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation, read from parts."""
    dealt = parts.repartition("conv").sortWithinPartitions("conv", "part")
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def run(batches: common.Batches) -> common.Batches:
        def found() -> Iterator[tuple]:
            for conv, rows in by_conversation(batches, 4):
                reader, turns, loss = Turns(), hashlib.sha256(), hashlib.sha256()
                n = chars = learned = 0
                for _, _, formatted, spans in rows:
                    chars += len(formatted)
                    for role, text, generated in reader.feed(formatted, spans):
                        n += 1
                        turns.update(f"{role}\n{text}\n".encode())
                        loss.update(generated.encode())
                        learned += len(generated)
                if reader.text:
                    raise ValueError(f"conversation {conv} ends inside a turn")
                yield conv, n, turns.hexdigest(), learned, loss.hexdigest(), chars

        rows = found()
        while block := list(itertools.islice(rows, 4096)):
            yield common.batch_of(schema, [list(x) for x in zip(*block)])

    return dealt.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
