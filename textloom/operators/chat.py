"""Conversations rendered as model context under a token budget.

Turns stay rows: a conversation may be longer than one task should hold.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom import fixed
from textloom.functions.text import strip_space
from textloom.operators.lookup import join_by_count, pick
from textloom.session import materialize

CHUNK_TURNS = 1024


def filter_turns(turns: DataFrame, rows_per_task: int = 1_000_000) -> DataFrame:
    """Drop blank user turns, and everything from the first quit word on."""
    is_user = F.col("role") == "user"
    quits = is_user & F.lower("text").isin(*fixed.QUIT_WORDS)
    # One row for a conversation; the minimum is taken before the shuffle.
    ends = turns.groupBy("conv_id").agg(
        F.min(F.when(quits, F.col("turn"))).alias("quit_turn"), F.count(F.lit(1)).alias("n"))
    kept = join_by_count(turns, ends.select("conv_id", "quit_turn"), "conv_id", ends.select("conv_id", "n"), rows_per_task)
    before = F.col("quit_turn").isNull() | (F.col("turn") < F.col("quit_turn"))
    blank = is_user & (strip_space(F.col("text")) == "")
    return kept.filter(before & ~blank).drop("quit_turn")


def render_turn() -> Column:
    """What a turn adds to the context; null for roles without a template."""
    return (
        F.when(F.col("role") == "user", F.concat(F.lit("\nUser: "), F.col("text"), F.lit("\nBot:")))
        .when(F.col("role") == "assistant", F.concat(F.lit(" "), strip_space(F.col("text"))))
    )


def render_conversation(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, piece``; the context is the pieces in order of turn."""
    return turns.select("conv_id", "turn", "role", render_turn().alias("piece")).filter(F.col("piece").isNotNull())


def _fold(chunk: Column, start: Column, budget: int) -> Column:
    """Tokens held after each turn of a chunk, from ``start`` tokens before it.

    After a reply that leaves more than ``budget`` tokens the context is cleared.
    The result keeps, for each turn, its number, the tokens held before a clear,
    and whether it cleared.
    """
    empty = F.array().cast("array<struct<turn:bigint,held:bigint,cleared:boolean>>")

    def step(state, t):
        held = state["held"] + t["tokens"]
        clear = t["reply"] & (held > budget)
        row = F.struct(t["turn"].alias("turn"), held.alias("held"), clear.alias("cleared"))
        return F.struct(F.when(clear, F.lit(0).cast("long")).otherwise(held).alias("held"),
                        F.concat(state["rows"], F.array(row)).alias("rows"))

    return F.aggregate(chunk, F.struct(start.cast("long").alias("held"), empty.alias("rows")), step)


def context_budget(pieces: DataFrame, budget: int, tokens: str = "tokens", chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """``conv_id, turn, held, cleared`` for rendered turns with a token count.

    ``held`` counts the tokens of the context with this turn.  Clearing depends on
    all turns before, so a conversation is a chain.  It is cut into chunks of at most
    ``chunk_turns`` turn numbers.  What a chunk leaves over is a step function of
    what it starts with; the functions of a conversation are applied one after the
    other, one row for a chunk, and each chunk is folded once with its right start.
    """
    chunks = pieces.groupBy("conv_id", F.floor(F.col("turn") / chunk_turns).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("turn").cast("long").alias("turn"), F.col(tokens).cast("long").alias("tokens"),
            (F.col("role") == "assistant").alias("reply")))).alias("turns"))
    chunks = materialize(chunks, "chunks")
    several = chunks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    starts = _starts(pick(chunks, several, "conv_id"), budget)
    started = chunks.join(starts, ["conv_id", "chunk"], "left")
    folded = started.select("conv_id", _fold(F.col("turns"), F.coalesce("start", F.lit(0)), budget).alias("fold"))
    return folded.select("conv_id", F.inline("fold.rows"))


def leftover_steps(tokens: Sequence[int], replies: Sequence[bool], budget: int) -> tuple[int, list[int], list[int]]:
    """What turns leave over: all their tokens more than they start with, unless a reply clears.

    Replies clear from a start of ``least`` on, the first of them first, and then
    ``left`` tokens remain, whatever the start was.
    """
    total, at = 0, []
    for n, reply in zip(tokens, replies):
        total += n
        if reply:
            at.append(total)
    left = [0] * len(at)
    for k in reversed(range(len(at))):
        following = bisect_right(at, at[k] + budget, k + 1)
        left[k] = left[following] if following < len(at) else total - at[k]
    return total, [budget - n + 1 for n in at], left


def _starts(chunks: DataFrame, budget: int) -> DataFrame:
    """``conv_id, chunk, start``: the tokens held before each chunk."""
    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [leftover_steps(t, r, budget) for t, r in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], longs), pa.array([r[2] for r in rows], longs)],
                ["conv_id", "chunk", "total", "least", "left"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held = None, 0
        for batch in batches:
            out = []
            for i, total, least, left in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                held = held if i == conv else 0
                conv = i
                out.append(held)
                # The first reply that clears: limits fall from reply to reply.
                k = bisect_left(least, True, key=lambda n: n <= held)
                held = left[k] if k < len(least) else held + total
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64())], ["conv_id", "chunk", "start"])

    key = "conv_id long, chunk long"
    of_turns = chunks.select("conv_id", "chunk", F.transform("turns", lambda t: t["tokens"]).alias("tokens"),
                             F.transform("turns", lambda t: t["reply"]).alias("replies"))
    found = of_turns.mapInArrow(steps, f"{key}, total long, least array<long>, left array<long>")
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(chained, f"{key}, start long")
