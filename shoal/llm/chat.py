"""Chat formatting from an event log.

A log row is ``conv_id, msg_id, seq, kind, role, text``; per conversation the
rows are ordered by ``seq``.  Kinds:

=============  ==============================================================
``open``       starts message ``msg_id`` with ``role`` and first text
``delta``      appends text
``edit``       replaces the text; messages opened later are withdrawn
``regenerate`` empties the text for the deltas to come; messages opened later
               are withdrawn
``delete``     withdraws the message unless it is opened again
=============  ==============================================================

``fold`` keeps, per message, the events from the last one that sets the text
onward and joins their texts; whether a message was withdrawn by an earlier
message's edit is a running maximum over the conversation.  ``segments``
renders each message by itself and ``read_back`` streams a conversation's
segments in order with a parser that holds one turn at a time, so a
conversation that holds a third of the log needs no more memory than any
other (its turns have to be hashed in order, so one task reads them).

Template: ``### <role>: <text></turn>`` and a newline.  Inside role and text
``\\`` and ``#`` (in the role also ``:``) are preceded by ``\\`` and ``<`` is
written ``\\l``; so no control string occurs inside a turn, and undoing the
escapes restores it.
The loss mask covers the text of assistant turns.

Null rules: null text is empty, null role is the empty role, rows with null
conv_id form one conversation of their own, events of unknown or null kind
and messages never opened are left out, several deliveries of one
(conv_id, msg_id, seq) count once (least kind, role and text first).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoal.llm.common import ship, strings

CHUNK = 512
_SEQ_STEP = 1 << 32


def log_of(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The event log of finished turns: each opens a message and streams its
    text in deltas of ``chunk`` characters.  Turns are ordered by turn number
    (null first), then role and text; repeated rows are turns of their own."""
    base = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                       F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    place = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    base = base.withColumn("msg_id", F.row_number().over(place).cast("long"))
    parts = F.expr(f"transform(sequence(0, cast(ceil(length(text) / {chunk}) as int)), i -> "
                   f"if(i = 0, '', substring(text, (i - 1) * {chunk} + 1, {chunk})))")
    return (base.select("conv_id", "msg_id", "role", F.posexplode(parts).alias("n", "text"))
            .select("conv_id", "msg_id", (F.col("msg_id") * _SEQ_STEP + F.col("n")).alias("seq"),
                    F.when(F.col("n") == 0, "open").otherwise("delta").alias("kind"),
                    F.when(F.col("n") == 0, F.col("role")).alias("role"), "text"))


def fold(log: DataFrame) -> DataFrame:
    """Final messages ``conv_id, msg_id, opened, role, text`` of a log."""
    e = (log.select("conv_id", "msg_id", "seq", "kind", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
         .filter(F.col("kind").isin("open", "delta", "edit", "regenerate", "delete")))
    once = (e.repartition("conv_id", "msg_id").groupBy("conv_id", "msg_id", "seq")
            .agg(F.min(F.struct("kind", "role", "text")).alias("e"))
            .select("conv_id", "msg_id", "seq", "e.*"))
    whole = Window.partitionBy("conv_id", "msg_id")
    sets = F.when(F.col("kind").isin("open", "edit", "regenerate"), F.col("seq"))
    marked = (once.withColumn("reset", F.max(sets).over(whole))
              .withColumn("opened_last", F.max(F.when(F.col("kind") == "open", F.col("seq"))).over(whole)))
    kept = (F.col("seq") >= F.col("reset")) & F.col("kind").isin("open", "delta", "edit")
    messages = (marked.groupBy("conv_id", "msg_id")
                .agg(F.max("opened_last").alias("opened"),
                     F.max(F.when(F.col("seq") == F.col("opened_last"), F.col("role"))).alias("role"),
                     F.max(F.when(F.col("kind") == "delete", F.col("seq"))).alias("deleted"),
                     F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).alias("changed"),
                     F.array_sort(F.collect_list(F.when(kept, F.struct("seq", "text")))).alias("parts"))
                .filter("opened is not null")
                .withColumn("text", F.array_join(F.col("parts.text"), "")))
    before = (Window.partitionBy("conv_id").orderBy("opened", "msg_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (messages.withColumn("cut", F.max("changed").over(before))
            .filter("cut is null or cut < opened").filter("deleted is null or deleted < opened")
            .select("conv_id", "msg_id", "opened", "role", "text"))


def escaped(col, more: str = ""):
    for mark in ("\\", "#", "<", *more):
        col = F.replace(col, F.lit(mark), F.lit("\\" + ("l" if mark == "<" else mark)))
    return col


def unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: "<" if m[1] == "l" else m[1], text)


def segments(messages: DataFrame) -> DataFrame:
    """``conv_id, msg_id, opened, segment, loss_start, loss_end``: the
    formatted turn and the loss mask in it (code points, end exclusive; null
    where no text is trained on).  A conversation's formatted text is its
    segments in order of ``opened, msg_id``."""
    head = F.concat(F.lit("### "), escaped(F.col("role"), ":"), F.lit(": "))
    body = escaped(F.col("text"))
    trained = F.col("role") == "assistant"
    return messages.select(
        "conv_id", "msg_id", "opened", F.concat(head, body, F.lit("</turn>\n")).alias("segment"),
        F.when(trained, F.length(head)).cast("long").alias("loss_start"),
        F.when(trained, F.length(head) + F.length(body)).cast("long").alias("loss_end"))


_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError("not a formatted conversation")
        yield unescaped(m[1]), unescaped(m[2])
        at = m.end()


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of each conversation as parsed from its formatted text:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``."""
    ship(rendered.sparkSession)
    ordered = (rendered.select(F.col("conv_id").cast("long"), "opened", "msg_id", "segment", "loss_start", "loss_end")
               .repartition("conv_id").sortWithinPartitions("conv_id", "opened", "msg_id"))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    # Arrow, not pandas: beside a null id pandas would make the ids doubles
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], kind) for k, kind in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        conv, turns, loss, n, trained, chars = none, None, None, 0, 0, 0
        for b in batches:
            out = []
            for c, segment, start, end in zip(b.column(0).to_pylist(), strings(b.column(3)), b.column(4).to_pylist(),
                                              b.column(5).to_pylist()):
                if conv is none or c != conv:
                    if conv is not none:
                        out.append((conv, n, turns.hexdigest(), trained, loss.hexdigest(), chars))
                    conv, turns, loss, n, trained, chars = c, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                chars += len(segment)
                for role, text in parse(segment):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                if start is not None:
                    text = unescaped(segment[start:end])
                    trained += len(text)
                    loss.update(text.encode())
            if out:
                yield rows(out)
        if conv is not none:
            yield rows([(conv, n, turns.hexdigest(), trained, loss.hexdigest(), chars)])

    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long")


def formatted(rendered: DataFrame) -> DataFrame:
    """``conv_id, text``: each conversation as one string (a row's size is
    that of the conversation; use ``segments`` to stay below it)."""
    part = F.array_sort(F.collect_list(F.struct("opened", "msg_id", "segment")))
    return rendered.groupBy("conv_id").agg(F.array_join(part["segment"], "").alias("text"))
