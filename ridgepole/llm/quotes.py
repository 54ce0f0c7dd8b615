"""Quotation linking: replies find the messages they quote, and lose the quotes.

A message's lines have a quote level: the number of ``>`` they begin with.  Quoted lines
and the lines a message says itself are normalised (quote marks off, blanks joined, lower
case) and hashed.  A quoted line belongs to the latest earlier message of the conversation
that says it itself; the message whose lines at quote level 1 weigh most (in characters)
is the parent, of two the later one.  Deeper levels quote the parent's own quotes: they
are kept as links too, and decide where level 1 is missing.  Conversations come in reply
order: tree by tree in the order of their first messages, a parent before its replies.

A message is known by (conversation, turn).  Defined results: a null conversation is one
of its own; a message with a null turn is neither linked nor quoted and comes last; rows
of equal conversation and turn share their parent; a null text has no lines and an empty
text after parsing; a message that quotes nothing known starts a tree; an empty table
gives an empty table.  Columns of the input with the names of added ones are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgepole.llm.common import stored

_MARKS = re.compile(r"(?:[ \t]?>)+ ?")


def parse(text: str) -> list[tuple[int, str]]:
    """(quote level, line without its marks) of every line."""
    out = []
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        out.append((marks.group().count(">"), line[marks.end():]) if marks else (0, line))
    return out


def own_text(text: str | None) -> str:
    """What a message says itself."""
    return "\n".join(line for level, line in parse(text or "") if level == 0).strip("\n")


def passages(text: str | None) -> list[tuple[int, str, int]]:
    """(quote level, hash, characters) of a message's lines that are not blank."""
    out = []
    for level, line in parse(text or ""):
        if words := " ".join(line.lower().split()):
            out.append((level, hashlib.md5(words.encode("utf-8", "replace")).hexdigest(), len(words)))
    return out


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for thread, turn, text in zip(*[c.to_pylist() for c in batch.columns]):
            for level, key, weight in passages(text):
                for column, value in zip(out, (thread, turn, level, key, weight)):
                    column.append(value)
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["_thread", "_turn", "level", "key", "weight"])


def _said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = pa.array([own_text(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], own], names=batch.schema.names)


def links(messages: DataFrame) -> DataFrame:
    """``_thread, _turn, quote_level, parent_turn, weight``: what each message quotes, by level.

    ``messages`` has ``_thread``, ``_turn`` and ``_text``.  Each quoted line looks back to
    the last message that said it, so a line of thousands of messages makes no pairs.
    """
    lines = messages.where("_turn is not null").mapInArrow(_lines, "_thread string, _turn bigint, level int, key string, weight bigint")
    once = lines.groupBy("_thread", "key", "level", "_turn").agg(F.sum("weight").alias("weight"))
    before = Window.partitionBy("_thread", "key").orderBy("_turn").rangeBetween(Window.unboundedPreceding, -1)
    found = once.withColumn("parent_turn", F.max(F.when(F.col("level") == 0, F.col("_turn"))).over(before))
    quoted = found.where("level > 0 and parent_turn is not null")
    return quoted.groupBy("_thread", "_turn", F.col("level").alias("quote_level"), "parent_turn").agg(F.sum("weight").alias("weight"))


def _roots(nodes: DataFrame) -> DataFrame:
    """Add ``root_turn`` and ``depth`` to nodes with a ``parent_turn``, by pointer doubling.

    Only nodes that do not point at a root yet take part in a round.
    """
    far, is_root = F.coalesce("parent_turn", "_turn"), F.col("parent_turn").isNull()
    now = nodes.select("_thread", "_turn", "parent_turn", far.alias("root_turn"), (~is_root).cast("bigint").alias("depth"), is_root.alias("_done"))
    now = stored(now, "roots")
    while not now.where("not _done").isEmpty():
        up = now.select(F.col("_thread").alias("_t"), F.col("_turn").alias("_k"), F.col("root_turn").alias("_next"), F.col("depth").alias("_more"), F.col("_done").alias("_ends"))
        step = now.where("not _done").join(up, (F.col("_thread") == F.col("_t")) & (F.col("root_turn") == F.col("_k")))
        moved = step.select("_thread", "_turn", "parent_turn", F.col("_next").alias("root_turn"), (F.col("depth") + F.col("_more")).alias("depth"), F.col("_ends").alias("_done"))
        now = stored(now.where("_done").union(moved), "roots")
    return now.drop("_done")


def conversations(messages: DataFrame, thread: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """The messages without quotes, with ``parent_turn``, ``root_turn``, ``depth`` and ``position``.

    ``position`` counts a conversation's messages from 0 in reply order.
    """
    added = ["parent_turn", "root_turn", "depth", "position"]
    keep = [c for c in messages.columns if c not in {*added, text}]
    rows = messages.select(
        *[F.col(f"`{c}`") for c in keep],
        F.coalesce(F.concat(F.lit("="), F.col(f"`{thread}`").cast("string")), F.lit("-")).alias("_thread"),
        F.col(f"`{turn}`").cast("bigint").alias("_turn"),
        F.col(f"`{text}`").alias("_text"),
    )
    quoted = links(rows.select("_thread", "_turn", "_text"))
    best = F.min_by("parent_turn", F.struct(F.col("quote_level"), -F.col("weight"), -F.col("parent_turn")))
    parents = quoted.groupBy("_thread", "_turn").agg(best.alias("parent_turn"))
    nodes = rows.where("_turn is not null").select("_thread", "_turn").distinct().join(parents, ["_thread", "_turn"], "left")
    placed = _roots(nodes)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    said = rows.mapInArrow(_said, ", ".join([*fields, "_said string"]))
    joined = said.join(placed, ["_thread", "_turn"], "left")
    order = Window.partitionBy("_thread").orderBy(F.col("root_turn").asc_nulls_last(), F.col("_turn").asc_nulls_last(), "_said")
    numbered = joined.withColumn("position", (F.row_number().over(order) - 1).cast("bigint"))
    return numbered.select(*[F.col(f"`{c}`") for c in keep], F.col("_said").alias(text), *added)
