"""Chat transcripts rebuilt from an event log and rendered for training.

An event names its conversation, a sequence number, the message it concerns and what it does:

    message      begins a message with a role and a first text
    delta        adds text to the message
    edit         replaces the message's text so far
    regenerate   empties the message; deltas of the new answer follow
    delete       takes the message out

Events are dealt by (conversation, message), sorted by sequence and folded as a stream, so a message costs
the memory of its own text and a conversation with a third of all events is spread over many tasks.
Messages are then rendered one by one, and a reader streams a conversation's turns in order without
holding more than one of them.

Template: `[INST] user [/INST]`, ` assistant</s>`, and `[ROLE name] text [/ROLE]` for any other role.
Every backslash, `<` and `[` inside a text or a role's name gets a backslash in front, and so no control string can
occur there; taking those backslashes away gives the text back.

Defined cases: a null text is empty, a null role is the empty name, a null conversation is a conversation
of its own; events of a message that was never begun are left out; events with equal numbers are taken by
kind, role and text; an empty log gives no row; other columns stay behind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

EVENTS = "conv_id long, seq long, message long, kind string, role string, text string"
RENDERED = "conv_id long, position long, part int, formatted string, loss_start long, loss_end long"
CONTROL = re.compile(r"[\\<\[]")
ESCAPED = re.compile(r"\\([\\<\[])")
OTHER_ROLE = re.compile(r"\[ROLE ((?:[^\\\]]|\\.)*)\] ", re.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn in the template, and where the loss mask begins and ends (code points, 0 and 0: nowhere)."""
    body = escape(text)
    if role == "user":
        return f"[INST] {body} [/INST]", 0, 0
    if role == "assistant":
        return f" {body}</s>", 1, 1 + len(body)
    name = escape(role).replace("]", "\\]")
    return f"[ROLE {name}] {body} [/ROLE]", 0, 0


def read(turn: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    if turn.startswith("[INST] ") and turn.endswith(" [/INST]"):
        return "user", unescape(turn[7:-8])
    if turn.startswith(" ") and turn.endswith("</s>"):
        return "assistant", unescape(turn[1:-4])
    head = OTHER_ROLE.match(turn)
    if not head or not turn.endswith(" [/ROLE]"):
        raise ValueError("not a turn of this template")
    return unescape(head[1].replace("\\]", "]")), unescape(turn[head.end() : -8])


def turns_as_events(turns: DataFrame) -> DataFrame:
    """A table of finished turns as a log: each row begins a message of its own."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("seq"),
        F.col("turn").cast("long").alias("message"),
        F.lit("message").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_RENDERED_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("position", pa.int64()), ("part", pa.int32())]
    + [("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())]
)


def formatted(events: DataFrame) -> DataFrame:
    """Fold the log and render it: one row for each final message, in order of (position, part).

    `position` is the message's number; `part` tells apart messages begun more than once under it.
    """

    def fold(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, part, role, text = None, 0, None, []

        def done():
            if key is not None and role is not None:
                out, start, end = render(role, "".join(text))
                yield key[0], key[1], part, out, start, end

        for conv, message, _, _, kind, event_role, event_text in rows:
            if (conv, message) != key:
                yield from done()
                key, part, role, text = (conv, message), 0, None, []
            if kind == "message":
                if role is not None:
                    yield from done()
                    part += 1
                role, text = event_role or "", [event_text or ""]
            elif role is None:
                continue
            elif kind == "delta":
                text.append(event_text or "")
            elif kind == "edit":
                text = [event_text or ""]
            elif kind == "regenerate":
                text = []
            elif kind == "delete":
                role = None
        yield from done()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(fold(_records(batches)), _RENDERED_ARROW)

    order = F.when(F.col("kind") == "message", 0).otherwise(1).alias("after")
    keyed = events.select("conv_id", "message", "seq", order, "kind", "role", "text")
    dealt = keyed.repartition("conv_id", "message")
    return dealt.sortWithinPartitions("conv_id", "message", "seq", "after", "kind", "role", "text").mapInArrow(run, RENDERED)


def reread(rendered: DataFrame) -> DataFrame:
    """Per conversation what its rendered turns say: digests of all turns and of the text under the loss mask.

    Turns stream through in order; a conversation costs the memory of one turn, however long it is.
    """
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
        + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )

    def digest(rows: Iterator[tuple]) -> Iterator[tuple]:
        current, open_one = None, False
        for conv, turn, start, end in rows:
            if not open_one or conv != current:
                if open_one:
                    yield current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars
                current, open_one, n, loss_chars, chars = conv, True, 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            role, text = read(turn)
            turns.update(f"{role}\n{text}\n".encode())
            learned = unescape(turn[start:end])
            loss.update(learned.encode())
            n, loss_chars, chars = n + 1, loss_chars + len(learned), chars + len(turn)
        if open_one:
            yield current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(digest(_records(batches)), schema)

    dealt = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "position", "part")
    wanted = dealt.select("conv_id", "formatted", "loss_start", "loss_end")
    return wanted.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
