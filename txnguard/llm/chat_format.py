"""Chat formatting with a compiled template, and reading its output back.

``format_turns`` deals the rows by conversation, sorts them by turn and streams
each conversation through the template: one output row per turn, whose texts in
order make up the formatted conversation, with the spans that a loss covers.
Neither a long conversation nor a frequent one is ever held whole: a task holds
one turn and the next. ``read_back`` parses that output again and digests it.

Texts may hold the template's control strings: ``escape`` puts one backslash
more after the first character of each, however many are there already, and
``unescape`` takes one away, so every text comes back as it was.

Cases: a null text, role or id reads as empty (a null conversation id is a
conversation of its own); rows of one turn are ordered by role and text; repeated
rows are turns of their own; other columns are ignored. Any role can occur. Texts of
any length are formatted whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from txnguard.llm.chat_template import CUT, Stream, compile_template

# The format's control strings are <s> </s> [INST] [/INST] [SYS] [/SYS] [ROLE] [/ROLE] [/TURN].
_TAIL = r"(?=/?s>|/?(?:INST|SYS|ROLE)\]|/TURN\])"
TEMPLATE = """
{%- for m in messages -%}
{%- if m.role == 'user' -%}{{ '<s>' ~ '[INST] ' }}{{ m.text | escape }}{{ ' [/INST]' }}
{%- elif m.role == 'assistant' -%}{{ ' ' }}{% generation %}{{ m.text | escape }}{% endgeneration %}{{ ' </s>' }}
{%- elif m.role == 'system' -%}{{ '<s>' ~ '[SYS] ' }}{{ m.text | escape }}{{ ' [/SYS]' }}
{%- else -%}{{ '<s>' ~ '[ROLE] ' }}{{ m.role | escape }}{{ ' [/ROLE] ' }}{{ m.text | escape }}{{ ' [/TURN]' }}
{%- endif -%}
{%- endfor -%}
"""
_MARKS = (("<s>[INST] ", " [/INST]", "user"), ("<s>[SYS] ", " [/SYS]", "system"), (" ", " </s>", "assistant"))


def escape(text: str | None) -> str:
    return re.sub(r"([<\[])(\\*)" + _TAIL, r"\1\\\2", text or "")


def unescape(text: str) -> str:
    return re.sub(r"([<\[])\\(\\*)" + _TAIL, r"\1\2", text)


def parse_turn(text: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    for start, end, role in _MARKS:
        if text.startswith(start) and text.endswith(end):
            return role, unescape(text[len(start) : len(text) - len(end)])
    start, middle, end = "<s>[ROLE] ", " [/ROLE] ", " [/TURN]"
    if not (text.startswith(start) and middle in text and text.endswith(end)):
        raise ValueError(f"not a formatted turn: {text[:40]!r}")
    role, _, body = text[len(start) : len(text) - len(end)].partition(middle)
    return unescape(role), unescape(body)


@lru_cache(maxsize=16)
def renderer(template: str):
    return compile_template(template, {"escape": escape})


def render_turns(template: str, messages: Iterator[dict]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """(text, loss spans as (start, length)) of each turn; what the template writes after the last turn ends the last one."""
    held, pieces = None, []
    for piece in renderer(template)(messages=Stream(messages)):
        if piece is CUT:
            if held is not None:
                yield _joined(held)
            held, pieces = pieces, []
        else:
            pieces.append(piece)
    if held is not None or pieces:
        yield _joined((held or []) + pieces)


def _joined(pieces: list[tuple[str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    at, spans = 0, []
    for text, learn in pieces:
        if learn:
            spans.append((at, len(text)))
        at += len(text)
    return "".join(p[0] for p in pieces), spans


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1024):
            yield from batch.slice(lo, 1024).to_pylist()


def _chunks(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], most: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def format_turns(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, seq, formatted, loss) per turn, each conversation's rows together and in order within one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for conv_id, own in groupby(_rows(batches), key=lambda r: r["conv_id"]):
                messages = ({"role": r["role"] or "", "text": r["text"] or ""} for r in own)
                for seq, (text, spans) in enumerate(render_turns(template, messages)):
                    yield conv_id, seq, text, [{"start": a, "length": n} for a, n in spans]

        yield from _chunks(rows(), ["conv_id", "seq", "formatted", "loss"], [pa.int64(), pa.int64(), pa.string(), _SPANS])

    turns = conversations.selectExpr("cast(conv_id as long) conv_id", "turn", "cast(role as string) role", "cast(text as string) text")
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, "conv_id long, seq long, formatted string, loss array<struct<start: long, length: long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation with digests of what its formatted turns say; takes ``format_turns``' rows as they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for conv_id, own in groupby(_rows(batches), key=lambda r: r["conv_id"]):
                said, learned, n_turns, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for r in own:
                    role, text = parse_turn(r["formatted"])
                    said.update(f"{role}\n{text}\n".encode())
                    for span in r["loss"]:
                        part = unescape(r["formatted"][span["start"] : span["start"] + span["length"]])
                        learned.update(part.encode())
                        loss_chars += len(part)
                    n_turns, chars = n_turns + 1, chars + len(r["formatted"])
                yield conv_id, n_turns, said.hexdigest(), loss_chars, learned.hexdigest(), chars

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield from _chunks(rows(), names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
