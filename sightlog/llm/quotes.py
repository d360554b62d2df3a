"""Conversations without quotes, in reply order.

The lines of a message are parsed into levels by their leading ``>`` marks.  A passage is a
stretch of lines of one level without blank lines between; it is known by a hash of its words in
lower case, and so is each of its lines.  A quoted passage is linked to the latest earlier
message of its conversation that says it itself, as a passage or by one of its lines.  A message
replies to the message that most of its level-1 text comes from, the later one among equals.
Threads follow replies up to a message without one, and a conversation is ordered by the turn
its threads begin with and then by turn, which puts every message behind the one it answers.

Earlier occurrences are found in blocks of turns: the last one within a block by a running
window, the one before by a running window over one row per block.  Places are counted within
blocks of a thread, over those within ranges of threads, and over the ranges.  So a line that a whole
conversation repeats, or a conversation that a third of all messages belong to, is spread over
many tasks, and no quote is paired with all its earlier occurrences.

Defined results: null text is empty; repeated rows are one message; messages without
conversation or turn are returned without links; several messages with one turn are linked
through the turn.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from sightlog.llm.common import scratch_folder, stored, with_columns

#: Turns by block.
BLOCK = 1024
MARK = re.compile(r"[ \t]*>")

PARTS = "array<struct<level:int,key:bigint,chars:int>>"


def levelled(line: str) -> tuple[int, str]:
    """Number of leading marks, and the rest of the line."""
    level, at = 0, 0
    while found := MARK.match(line, at):
        level, at = level + 1, found.end()
    return level, line[at:].strip() if level else line


def key_of(text: str) -> int:
    return xxhash.xxh64_intdigest(" ".join(text.lower().split()).encode("utf-8", "surrogatepass")) - (1 << 63)


def parse(text: str | None) -> tuple[str, list[dict]]:
    """The message's own text, and its passages and lines as (level, key, chars)."""
    body: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    open_level = None
    for line in (text or "").split("\n"):
        level, rest = levelled(line)
        if level == 0:
            body.append(line)
        if not rest.strip():
            open_level = None
        elif level == open_level:
            passages[-1][1].append(rest)
        else:
            passages.append((level, [rest]))
            open_level = level
    parts = []
    for level, lines in passages:
        whole = " ".join(lines)
        parts.append({"level": level, "key": key_of(whole), "chars": len(whole)})
        if len(lines) > 1 or level == 0:
            parts += [{"level": level, "key": key_of(x), "chars": len(x)} for x in lines]
    return "\n".join(body).strip("\n"), parts


def _compute(texts: list) -> list[pa.Array]:
    found = [parse(t) for t in texts]
    kind = pa.list_(pa.struct([("level", pa.int32()), ("key", pa.int64()), ("chars", pa.int32())]))
    return [pa.array([b for b, _ in found], pa.string()), pa.array([p for _, p in found], kind)]


def earlier(said: DataFrame, asked: DataFrame) -> DataFrame:
    """conv_id, key, turn and source of ``asked`` (conv_id, key, turn): the latest turn before
    it in which ``said`` (the same columns) has the key."""
    rows = said.withColumn("own", F.lit(1)).unionByName(asked.withColumn("own", F.lit(0)))
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    own_turn = F.when(F.col("own") == 1, F.col("turn"))
    key = ["conv_id", "key"]
    within = W.partitionBy(*key, "block").orderBy("turn", "own").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*key).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy(*key, "block").agg(F.max(own_turn).alias("last")).select(
        *key, "block", F.max("last").over(before).alias("carried")
    )
    found = rows.select(*key, "block", "turn", "own", F.last(own_turn, ignorenulls=True).over(within).alias("near"))
    return (
        found.where("own = 0").join(blocks, [*key, "block"])
        .select(*key, "turn", F.coalesce("near", "carried").alias("source"))
    )


def _roots(replies: DataFrame, folder: str) -> DataFrame:
    """conv_id, turn and root of messages (conv_id, turn, parent) that reply; every round doubles
    the distance to the parent that is known."""
    now, rounds = stored(replies.select("conv_id", "turn", F.col("parent").alias("root")), folder, "replies"), 0
    while True:
        up = now.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root").alias("above"))
        joined = now.join(up, (F.col("conv_id") == F.col("c")) & (F.col("root") == F.col("t")), "left")
        moved = joined.select("conv_id", "turn", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        moved = stored(moved, folder, f"roots-{rounds}")
        now, rounds = moved.drop("moved"), rounds + 1
        if moved.where("moved").isEmpty():
            return now


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body, reply_to, thread, n_quotes, n_linked and place, for each
    message of ``messages`` (conv_id, turn, role, text).

    ``place`` counts the messages of the conversation in reply order, from 0.
    """
    folder = scratch_folder(messages.sparkSession)
    once = messages.select("conv_id", "turn", "role", "text").distinct()
    parsed = stored(with_columns(once, "text", f"body string, parts {PARTS}", _compute).drop("text"), folder, "parsed")
    placed = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    parts = placed.select("conv_id", "turn", F.explode("parts").alias("p")).select("conv_id", "turn", "p.*")
    key = ["conv_id", "key"]
    quoted = parts.where("level > 0").groupBy(*key, "turn", "level").agg(F.max("chars").alias("chars"))
    quoted = stored(quoted, folder, "quoted")
    wanted = quoted.select(*key).distinct()
    said = parts.where("level = 0").select(*key, "turn").distinct().join(wanted, key, "left_semi")
    sources = earlier(said, quoted.select(*key, "turn").distinct())
    links = stored(
        quoted.join(sources, [*key, "turn"]).select("conv_id", "turn", "level", "chars", "source"), folder, "links"
    )
    by_source = links.where("level = 1 AND source IS NOT NULL").groupBy("conv_id", "turn", "source").agg(F.sum("chars").alias("chars"))
    replies = by_source.groupBy("conv_id", "turn").agg(F.max(F.struct("chars", "source")).alias("best")).select(
        "conv_id", "turn", F.col("best.source").alias("parent")
    )
    roots = _roots(replies, folder)
    counts = links.groupBy("conv_id", "turn").agg(F.count("*").alias("n_quotes"), F.count("source").alias("n_linked"))
    answers = stored(
        counts.join(replies, ["conv_id", "turn"], "left").join(roots, ["conv_id", "turn"], "left"), folder, "answers"
    )
    full = parsed.drop("parts").join(answers, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "body", F.col("parent").alias("reply_to"), F.coalesce("root", "turn").alias("thread"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )
    return with_place(full)


def with_place(full: DataFrame) -> DataFrame:
    """Number of each message in its conversation's order, by blocks of turns within threads."""
    block = [F.col("conv_id"), F.col("thread"), F.floor(F.col("turn") / BLOCK).alias("block")]
    order = [F.col("turn"), F.col("role"), F.xxhash64("body")]
    rows = full.select("*", block[-1])
    inside = W.partitionBy("conv_id", "thread", "block").orderBy(*order)
    span = F.floor(F.col("thread") / BLOCK).alias("span")
    before = W.partitionBy("conv_id", "span").orderBy("thread", "block").rowsBetween(W.unboundedPreceding, -1)
    spans_before = W.partitionBy("conv_id").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    spans = rows.groupBy("conv_id", span).agg(F.count("*").alias("n")).select(
        F.col("conv_id").alias("sc"), F.col("span").alias("ss"), F.coalesce(F.sum("n").over(spans_before), F.lit(0)).alias("ahead")
    )
    sizes = rows.groupBy("conv_id", "thread", "block").agg(F.count("*").alias("n")).select(
        "conv_id", "thread", "block", "n", span
    ).withColumn("own", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sizes = sizes.join(spans, F.col("conv_id").eqNullSafe(F.col("sc")) & F.col("span").eqNullSafe(F.col("ss"))).select(
        F.col("conv_id").alias("c"), F.col("thread").alias("t"), F.col("block").alias("b"), (F.col("own") + F.col("ahead")).alias("offset")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("thread").eqNullSafe(F.col("t")) & F.col("block").eqNullSafe(F.col("b"))
    numbered = rows.select("*", (F.row_number().over(inside) - 1).alias("nth")).join(sizes, same)
    return numbered.select(*full.columns, (F.col("nth") + F.col("offset")).alias("place"))
