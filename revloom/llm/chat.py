"""Conversations rebuilt from a log of events and rendered with a template and a loss mask.

Events are partitioned by conversation and sorted by message and sequence; one pass folds them into final messages. A
turn is rendered as
    ### role: text</turn>
and a line feed. In texts and roles a backslash is doubled and one is put into each control string, so that none of them
stands inside, whatever a text says; dropping a backslash before any character gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"
LEARNED_ROLE = "assistant"
#: Kinds of events: `message` opens a message with its whole text, `delta` appends to a message (opening it, if new),
#: `edit` replaces its text, `regenerate` empties it and drops the messages after it as they were until then.
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"

_CONTROL = re.compile(r"#(?=##)|<(?=/turn>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and from where to where its text goes."""
    head = OPEN + escape(role).replace(":", "\\:") + BETWEEN
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def read_turn(segment: str) -> tuple[str, str]:
    """(role, text) of a rendered turn."""
    found = _TURN.fullmatch(segment)
    if not found or CLOSE[:-1] in found[2]:
        raise ValueError("not one turn")
    return unescape(found[1]), unescape(found[2])


class _Fold:
    """The messages of one conversation from its events in order of message and sequence; holds one message."""

    def __init__(self):
        self.key, self.role, self.parts, self.live = None, "", [], False
        self.cut = self.next_cut = None  # events before `cut` are void, since an earlier message was generated anew then

    def event(self, key, seq, kind, role, text) -> tuple[str, str] | None:
        """Takes an event; gives the message before, if this one belongs to another."""
        done = None
        if key != self.key or kind == MESSAGE:
            done = self.end()
            self.cut = self.next_cut
            self.key, self.role, self.parts, self.live = key, "", [], False
        if kind == REGENERATE and seq is not None and (self.next_cut is None or seq > self.next_cut):
            self.next_cut = seq
        if self.cut is not None and (seq is None or seq < self.cut):
            return done
        if kind == DELTA or kind == MESSAGE:
            self.parts.append(text or "")
        elif kind == EDIT:
            self.parts = [text or ""]
        elif kind == REGENERATE:
            self.parts = []
        else:
            raise ValueError(f"unknown kind of event: {kind}")
        self.live = True
        self.role = role or self.role
        return done

    def end(self) -> tuple[str, str] | None:
        return (self.role, "".join(self.parts)) if self.live else None


_SEGMENTS = "conv_id long, position long, role string, text string, formatted string, start long, loss_from long, loss_to long"


def _rendered(keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "position", "role", "text", "formatted", "start", "loss_from", "loss_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        rows: list[tuple] = []
        fold, conv, begun, position, start = _Fold(), None, False, 0, 0

        def put(message) -> None:
            nonlocal position, start
            if message:
                role, text = message
                formatted, a, b = render(role, text)
                learned = role == LEARNED_ROLE
                rows.append((conv, position, role, text, formatted, start, start + a if learned else None, start + b if learned else None))
                position, start = position + 1, start + len(formatted)

        def take() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows.clear()
            return out

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                if not begun or row[0] != conv:
                    put(fold.end())
                    fold, conv, begun, position, start = _Fold(), row[0], True, 0, 0
                put(fold.event(row[1 : 1 + keys], *row[1 + keys :]))
            if rows:
                yield take()
        put(fold.end())
        if rows:
            yield take()

    return run


def formatted(events: DataFrame, by: tuple[str, ...] = ("message",)) -> DataFrame:
    """A row per turn of each conversation, in the order of `by`.

    events: conv_id long, the columns of `by` (which tell and order a conversation's messages), seq long, kind (one of the
    module's kinds), role, text strings; other columns are ignored. Columns: conv_id, position (from 0), role, text,
    formatted (the rendered turn; a conversation is their concatenation), start (of the turn in it, in code points),
    loss_from and loss_to (of the text under the loss mask, for turns of the assistant; else null). A null text is empty,
    as is a null role; a message's role is the last one given. Events that tie in `by` and seq are ordered by kind, role
    and text, so equal rows count as often as they come. A null conv_id is a conversation of its own. A message that was dropped
    and not opened again gives no turn. An empty table gives no rows. A conversation is read as a stream by one task, which
    holds one message.
    """
    columns = ["conv_id", *by, "seq", "kind", "role", "text"]
    ordered = events.select(F.col("conv_id").cast("long").alias("conv_id"), *columns[1:]).repartition("conv_id").sortWithinPartitions(*columns)
    return ordered.mapInArrow(_rendered(len(by)), _SEGMENTS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, begun = None, False
    turns = turn_hash = loss_chars = loss_hash = chars = None

    def ended() -> pa.RecordBatch:
        columns = ([conv], [turns], [turn_hash.hexdigest()], [loss_chars], [loss_hash.hexdigest()], [chars])
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        done = []
        for row_conv, segment, low, high in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_from", "loss_to")], strict=True):
            if not begun or row_conv != conv:
                if begun:
                    done.append(ended())
                conv, begun, turns, loss_chars, chars = row_conv, True, 0, 0, 0
                turn_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            role, text = read_turn(segment)
            turn_hash.update(f"{role}\n{text}\n".encode())
            if low is not None:
                learned = unescape(segment[low - chars : high - chars])
                loss_chars += len(learned)
                loss_hash.update(learned.encode())
            turns, chars = turns + 1, chars + len(segment)
        yield from done
    if begun:
        yield ended()


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of conversations from their formatted turns and loss masks alone.

    turns: conv_id, position, formatted, loss_from, loss_to as `formatted` gives them. Columns: conv_id, n_turns, turns_sha256
    (of role, line feed, text, line feed of each turn), loss_chars and loss_sha256 (of the unescaped text under the mask),
    formatted_chars. Raises where a turn was not rendered by this module. An empty table gives no rows.
    """
    columns = ["conv_id", "position", "formatted", "loss_from", "loss_to"]
    ordered = turns.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "position")
    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(_digests, kind)


def message_events(conversations: DataFrame) -> DataFrame:
    """The log of a table of finished turns (conv_id, turn, role, text): each row opens a message and streams its text.

    Messages are ordered by turn, ties by role and text; a row is a message of its own however often it comes.
    """
    row = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    row = row.withColumn("text_order", F.md5("text"))
    opened = F.struct(F.lit(0).cast("long").alias("seq"), F.lit(MESSAGE).alias("kind"), F.lit("").alias("text"))
    streamed = F.struct(F.lit(1).cast("long").alias("seq"), F.lit(DELTA).alias("kind"), F.col("text"))
    events = row.select("conv_id", "turn", "role", "text_order", "row", F.explode(F.array(opened, streamed)).alias("e"))
    return events.select("conv_id", "turn", "text_order", "row", "role", "e.seq", "e.kind", "e.text")


#: What orders the messages of `message_events`. A row's number settles nothing but the order of equal rows.
MESSAGE_ORDER = ("turn", "role", "text_order", "row")
