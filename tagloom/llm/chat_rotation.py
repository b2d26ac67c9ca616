"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once, with
that speaker as the assistant and everybody else as a named user; masks mark
the characters that the assistant wrote, to be trained on.

A long dialogue is rendered in pieces of PIECE_TURNS turns, so that no task
gathers a whole conversation however long; ``offset`` tells where a piece
starts in the dialogue, and the pieces in order are the dialogue. Turn texts
are shuffled once, to their piece; speakers join the pieces by small rows.

Turn numbers may repeat or be missing, so a range of PIECE_TURNS numbers may
hold any number of rows. Crowded ranges are cut by rows: their distinct rows
are counted and sorted over range partitions, every row learns its place in its
range from its partition and one summary row per partition before it, and a
piece gets the rows of PIECE_TURNS places.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import HASH_SLOTS, written

PIECE_TURNS = 64
#: Characters of a text that the sample for the range borders holds.
BORDER_CHARS = 256
#: The template (fixed values). ``<|`` inside a text or a name is spelled ``< |``.
ASSISTANT, USER, CLOSE, NAME_END, BODY_END = "<|assistant|>\n", "<|user", "|>\n", ":", "<|end|>\n"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _placed(names: list[str]):
    """Task function: how many rows of its range ``at`` stand before each row
    in its sorted partition, and at its end a summary row with the partition's
    first and last range and the rows of the last one."""

    def place(batches):
        part, first, last, done, out = TaskContext.get().partitionId(), None, None, 0, None
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            if out is None:
                out = pa.schema([*(batch.schema.field(c) for c in names), ("part", pa.int64()), ("start", pa.int64()),
                                 ("first", pa.string()), ("last", pa.string())])
            at, n = batch.column("at"), batch.column("n").to_numpy()
            new = np.ones(rows, dtype=bool)
            if rows > 1:
                new[1:] = pc.not_equal(at.slice(1), at.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
            run = np.maximum.accumulate(np.where(new, np.arange(rows), 0))
            before = np.cumsum(n) - n
            start = before - before[run]
            if at[0].as_py() == last:
                start[run == 0] += done
            first, last, done = first or at[0].as_py(), at[rows - 1].as_py(), int(start[-1] + n[-1])
            empty = pa.nulls(rows, pa.string())
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(np.full(rows, part)), pa.array(start),
                                   empty, empty], schema=out)
        if out is not None:
            ends = {"n": done, "part": part, "first": first, "last": last}
            yield pa.record_batch([pa.array([ends.get(f.name)], f.type) for f in out], schema=out)

    return place


def _cut_by_rows(rows: DataFrame, piece_turns: int) -> DataFrame:
    """Rows (conv_id, piece, turn, role, body) -> distinct rows of each part of
    a piece, with the place of the first and the copies (part, start, n)."""
    counted = rows.groupBy("conv_id", "piece", "turn", "role", "body").agg(F.count("*").alias("n")).withColumn(
        "at", F.to_json(F.struct("conv_id", "piece")))
    order = ["conv_id", "piece", "turn", "role"]
    # a prefix cuts the ranges as the text does; equal rows are one by now
    ranged = counted.repartitionByRange(*order, F.substring("body", 1, BORDER_CHARS)).sortWithinPartitions(*order, "body")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema)
    placed = written(ranged.mapInArrow(_placed(counted.columns), f"{schema}, part long, start long, first string, last string"), "chat-places")
    # one row per partition: what the partitions before hold of its first range
    by_part = Window.orderBy("part")
    ends = placed.where("first is not null").withColumn("held", F.sum("n").over(Window.partitionBy("last").orderBy("part")))
    base = F.when(F.lag("last").over(by_part) == F.col("first"), F.lag("held").over(by_part))
    bases = ends.select("part", F.col("first").alias("at"), F.coalesce(base, F.lit(0)).alias("base"))
    start = F.col("start") + F.coalesce("base", F.lit(0))
    laid = placed.where("first is null").drop("first", "last").join(F.broadcast(bases), ["part", "at"], "left").select(
        *order, "body", start.alias("start"), (start + F.col("n")).alias("end"))
    laid = laid.withColumn("part", F.explode(F.expr(f"sequence(start div {piece_turns}, (end - 1) div {piece_turns})")))
    low, high = F.col("part") * piece_turns, (F.col("part") + 1) * piece_turns
    return laid.select(*order, "body", "part", F.greatest("start", low).alias("start"),
                       (F.least("end", high) - F.greatest("start", low)).cast("int").alias("n"))


def rotate(turns: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """One row per conversation, participant and piece: conv_id, speaker,
    piece, offset, n_turns, text, masks (array of start and end, in characters
    of the piece, end exclusive).

    A piece holds the rows of ``piece_turns`` turn numbers. Where these are more
    than ``piece_turns`` rows, as turns repeat or are null, they give several
    rows of output of at most ``piece_turns`` turns each, told apart and ordered
    by ``offset``.

    Participants are the distinct non-null roles. A turn without a role is an
    unnamed user's; conversations without any role give no rows. Null texts
    are empty turns. Turns stand in order of turn, role and text, null turns
    first, in a piece of their own (-1); repeated rows are repeated turns. A
    null conv_id is a conversation like any other. No rows give no rows; other
    columns are ignored.
    """
    rows = turns.select(
        "conv_id", F.coalesce(F.floor(F.col("turn") / piece_turns), F.lit(-1)).cast("long").alias("piece"),
        "turn", F.col("role").cast("string").alias("role"), _plain(F.coalesce(F.col("text"), F.lit(""))).alias("body"))
    # small rows: how long the pieces are for whoever reads them, and who takes part
    sizes = rows.groupBy("conv_id", "piece", "role").agg(
        F.sum(F.length("body")).alias("body"), F.count("*").alias("n"))
    sizes = written(sizes, "chat-sizes")
    speakers = written(sizes.where("role is not null").select("conv_id", F.col("role").alias("speaker")).distinct(), "chat-speakers")
    # ranges go by hash slots, at most HASH_SLOTS of them: a range that shares
    # a crowded one's slot is placed as well, with the same result
    slot = F.pmod(F.xxhash64("conv_id", "piece"), F.lit(HASH_SLOTS)).alias("slot")
    crowded = sizes.groupBy("conv_id", "piece").agg(F.sum("n").alias("n")).where(F.col("n") > piece_turns)
    crowded = written(crowded.select(slot).distinct(), "chat-crowded")
    cut = None if crowded.isEmpty() else _cut_by_rows(
        rows.withColumn("slot", slot).join(F.broadcast(crowded), "slot", "left_semi").drop("slot"), piece_turns)
    if cut is not None:
        rows, sizes = (d.withColumn("slot", slot).join(F.broadcast(crowded), "slot", "left_anti").drop("slot") for d in (rows, sizes))
    part = F.lit(0).cast("long").alias("part")
    pieces = rows.groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "body"))).alias("turns")).select(
        "conv_id", "piece", part, "turns")
    sizes = sizes.select("conv_id", "piece", part, "role", "body", "n")
    if cut is not None:
        many = F.sort_array(F.collect_list(F.struct("start", "turn", "role", "body", "n")))
        pieces = pieces.unionByName(cut.groupBy("conv_id", "piece", "part").agg(F.flatten(F.transform(
            many, lambda t: F.array_repeat(F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["body"].alias("body")), t["n"]))).alias("turns")))
        sizes = sizes.unionByName(cut.groupBy("conv_id", "piece", "part", "role").agg(
            F.sum(F.length("body") * F.col("n").cast("long")).alias("body"), F.sum("n").alias("n")))
    user = F.lit(len(USER + CLOSE)) + F.coalesce(F.length(_plain(F.col("role"))) + len(NAME_END), F.lit(0))
    head = F.when(F.col("role").eqNullSafe(F.col("speaker")), F.lit(len(ASSISTANT))).otherwise(user)
    right = speakers.withColumnRenamed("conv_id", "_c")
    read = sizes.join(right, sizes["conv_id"].eqNullSafe(right["_c"])).groupBy("conv_id", "speaker", "piece", "part").agg(
        F.sum(F.col("body") + F.col("n") * (head + len(BODY_END))).alias("length"))
    before = Window.partitionBy("conv_id", "speaker").orderBy("piece", "part").rowsBetween(Window.unboundedPreceding, -1)
    read = written(read.select("conv_id", "speaker", "piece", "part", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")), "chat-offsets")
    small = read.select(F.col("conv_id").alias("_c"), F.col("piece").alias("_p"), F.col("part").alias("_n"), "speaker", "offset")
    both = pieces.join(small, pieces["conv_id"].eqNullSafe(small["_c"]) & (pieces["piece"] == small["_p"]) & (pieces["part"] == small["_n"]))

    def render(t: Column) -> Column:
        name = F.coalesce(F.concat(F.lit(NAME_END), _plain(t["role"])), F.lit(""))
        return F.when(t["role"].eqNullSafe(F.col("speaker")), F.lit(ASSISTANT)).otherwise(
            F.concat(F.lit(USER), name, F.lit(CLOSE)))

    parts = F.transform("turns", lambda t: F.struct(
        render(t).alias("head"), t["body"].alias("body"), t["role"].eqNullSafe(F.col("speaker")).alias("own")))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(BODY_END))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("masks"))

    def mask(acc: Column, p: Column) -> Column:
        first = acc["at"] + F.length(p["head"])
        end = first + F.length(p["body"]) + len(BODY_END) - 1  # the end mark is the speaker's, its line end is not
        span = F.array(F.struct(first.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(p["own"], F.concat(acc["masks"], span)).otherwise(acc["masks"]).alias("masks"))

    return both.withColumn("parts", parts).select(
        "conv_id", "speaker", "piece", F.col("offset").cast("long").alias("offset"), F.size("turns").alias("n_turns"),
        text.alias("text"), F.aggregate("parts", start, mask)["masks"].alias("masks"))
