"""Chat formatting by event-sourced reconstruction.

A log holds events (conv_id, message, seq, kind, role, text):

* ``open``: the message begins, with its role;
* ``delta``: streamed text is appended;
* ``edit``: the text is replaced;
* ``regenerate``: the text is dropped and streamed anew.

An edit or regeneration forks the conversation: what later messages got
before it is void. Logs are partitioned by conversation and sorted by
message and sequence, and each partition is folded as a stream: one open
message is in memory, never a conversation. The template is

    ### <role>: <text></turn>\\n

with a backslash before every backslash, # and < of a text (and : of a
role), so that no control string stands inside a text and reading back is exact.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelens.llm.common import ROWS_OUT, record_batch, ship, text_or_empty

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"
SEGMENTS = "conv_id long, message long, role string, formatted string, loss_start long, loss_end long"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")
_TEXT, _ROLE, _BACK = re.compile(r"[\\#<]"), re.compile(r"[\\#<:]"), re.compile(r"(?s)\\(.)")
_TURN = re.compile(r"(?s)### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n")


def render(role: str, text: str) -> tuple[str, int, int]:
    """Formatted turn, and where its text starts and ends in it."""
    head = f"### {_ROLE.sub(r'\\\g<0>', role)}: "
    body = _TEXT.sub(r"\\\g<0>", text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def replay(conversations: DataFrame, piece: int = 1024) -> DataFrame:
    """Rows by turn as an event log: ``open``, then deltas of at most ``piece`` code points.

    Rows of equal (conv_id, turn) are separate messages, ordered by role and
    text; a null turn comes first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                text_or_empty("role").alias("role"), text_or_empty().alias("text"))
    parts = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % piece), F.lit(0))
    return (rows.withColumn("message", F.row_number().over(order).cast("long"))
            .select("conv_id", "message", "role", F.posexplode(F.concat(F.array(F.lit("")), parts)).alias("seq", "text"))
            .select("conv_id", "message", F.col("seq").cast("long").alias("seq"),
                    F.when(F.col("seq") == 0, "open").otherwise("delta").alias("kind"), "role", "text"))


def _fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted events to (conv_id, message, role, text) of the final messages."""
    conv = message = None
    void = fork = float("-inf")
    began, role, parts = False, "", []
    for c, m, seq, kind, who, text in events:
        seq = float("-inf") if seq is None else seq
        if not began or (c, m) != (conv, message):
            if began and parts is not None:
                yield conv, message, role, "".join(parts)
            void = max(void, fork) if began and c == conv else float("-inf")
            began, conv, message, role, parts, fork = True, c, m, "", None, float("-inf")
        if seq < void or kind not in ("open", "delta", "edit", "regenerate"):
            continue
        parts = [] if parts is None else parts
        if who is not None:
            role = who
        if kind in ("edit", "regenerate"):
            fork = max(fork, seq)
            parts = []
        if kind in ("delta", "edit") and text:
            parts.append(text)
    if began and parts is not None:
        yield conv, message, role, "".join(parts)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, chars) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for r in rows:
        out.append(r)
        size += chars(r)
        if len(out) >= ROWS_OUT or size > 4 << 20:
            yield record_batch(out, schema)
            out, size = [], 0
    if out:
        yield record_batch(out, schema)


def format_conversations(events: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row per final message: its formatted text and the loss range in it (code points; 0, 0 if masked).

    The segments of a conversation, in order of ``message``, joined give its
    formatted text; they stand in one partition in that order. Null
    conversations, messages and sequences form groups of their own that sort
    first; null text is empty, null role keeps the earlier one (or empty);
    unknown kinds are ignored; equal sequences order by kind, role and text.
    An empty log gives no rows.
    """
    ship(events.sparkSession)
    schema = events.sparkSession.createDataFrame([], SEGMENTS).toArrow().schema

    def run(batches):
        def segments():
            for conv, message, role, text in _fold(_rows(batches)):
                formatted, start, end = render(role, text)
                yield (conv, message, role, formatted, start, end) if role == learn_from else (
                    conv, message, role, formatted, 0, 0)
        yield from _batches(segments(), schema, lambda r: len(r[3]))

    names = ["conv_id", "message", "seq", "kind", "role", "text"]
    return (events.select(*names).repartition("conv_id").sortWithinPartitions(*names)
            .mapInArrow(run, SEGMENTS))


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation, what reading its formatted segments back gives (streams over the segments' own order)."""
    ship(segments.sparkSession)
    schema = segments.sparkSession.createDataFrame([], DIGESTS).toArrow().schema

    def run(batches):
        def convs():
            conv = state = None
            for c, _, _, formatted, start, end in _rows(batches):
                if state is None or c != conv:
                    if state:
                        yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_back(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                learned = unescape(formatted[start:end])
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(formatted)
            if state:
                yield conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
        yield from _batches(convs(), schema, lambda r: 1)

    return segments.mapInArrow(run, DIGESTS)
