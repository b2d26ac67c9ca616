"""Exact dedup by deterministic block naming.

Every normalised text is cut into fixed-size byte blocks. A global sort gives
each distinct block an integer name (its rank); then names of adjacent blocks
are paired, the pairs sorted and ranked again, and so on until a document has
one name. Two texts are equal exactly when they finish in the same round with
the same name: names are ranks of compared contents, so nothing can collide.

Scale: block contents are shuffled once. The sort is range-partitioned on
(digest of the content, document, position), so a block that a third of all
documents share is cut over as many tasks as its rows need; a name that
crosses a partition border is mended from one summary row per partition. The
sample that finds the range borders holds digests, not contents. Later rounds
move two integers per pair.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tagloom.llm.common import written

BLOCK_BYTES = 4096
FLUSH_BYTES = 8 << 20


def text_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (doc_id, sha, n_blocks, pos, block) of the normalised texts (A-Z
    lower-cased; null counts as empty; an empty text is one empty block)."""

    def cut(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.binary()), ("n_blocks", pa.int64()),
                            ("pos", pa.int64()), ("block", pa.binary())])
        out, held = [[] for _ in schema], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = (raw.as_py() or b"").lower()  # bytes.lower() changes A-Z only
                sha = hashlib.sha256(text).digest()
                n = max(1, -(-len(text) // block_bytes))
                for pos in range(n):
                    block = text[pos * block_bytes:(pos + 1) * block_bytes]
                    for column, value in zip(out, (doc_id, sha, n, pos, block)):
                        column.append(value)
                    held += len(block) + 64
                    if held > FLUSH_BYTES:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
                        out, held = [[] for _ in schema], 0
        if out[0]:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        cut, "doc_id long, sha binary, n_blocks long, pos long, block binary")


@F.arrow_udf(StringType())
def text_key(text: pa.Array) -> pa.Array:
    """``text_sha256`` of texts given as binary."""
    return pa.array([hashlib.sha256((x.as_py() or b"").lower()).hexdigest() for x in text], pa.string())


def _ranked(keys: list[str], names: list[str]):
    """Task function: ranks of the distinct keys of one sorted partition, and
    at its end a summary row with the partition's first and last key."""

    def key_of(batch, row):
        values = [batch.column(k)[row].as_py() for k in keys]
        return values[0] if len(keys) == 1 else struct.pack(f">{len(values)}q", *values)

    def rank(batches):
        part, done, first, last = TaskContext.get().partitionId(), 0, None, None
        types, out = None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if types is None:
                types = [batch.schema.field(c).type for c in names]
                out = pa.schema([*zip(names, types), ("part", pa.int64()), ("rank", pa.int64()),
                                 ("first", pa.binary()), ("last", pa.binary())])
            new = np.zeros(n, dtype=bool)
            for k in keys:
                column = batch.column(k)
                if n > 1:
                    new[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            head = key_of(batch, 0)
            new[0] = head != last or done == 0
            if first is None:
                first = head
            ranks = done + np.cumsum(new)
            done, last = int(ranks[-1]), key_of(batch, n - 1)
            empty = pa.nulls(n, pa.binary())
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(np.full(n, part)), pa.array(ranks),
                                   empty, empty], schema=out)
        if done:
            yield pa.record_batch([*(pa.nulls(1, t) for t in types), pa.array([part]), pa.array([done]),
                                   pa.array([first], pa.binary()), pa.array([last], pa.binary())], schema=out)

    return rank


def name_by_rank(df: DataFrame, keys: list[str], ties: list[str], first: tuple[str, ...] = ()) -> DataFrame:
    """Replace the key columns by ``name``: the rank of the key among all
    distinct keys, from 1, in the order of ``first`` (short functions of the
    key that the ranges are cut by; default: the key) and the key. ``ties``
    cut rows of one key over partitions."""
    rest = [c for c in df.columns if c not in keys and c not in first]
    ranges = list(first) or keys
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in rest)
    ranked = written(
        df.repartitionByRange(*ranges, *ties).sortWithinPartitions(*first, *keys, *ties)
        .mapInArrow(_ranked(keys, rest), f"{schema}, part long, rank long, first binary, last binary"), "names")
    order = Window.orderBy("part")
    # one row per partition: a key cut by a border counts once
    same = F.coalesce(F.lag("last").over(order) == F.col("first"), F.lit(False)).cast("long")
    borders = ranked.where("first is not null").withColumn("same", same)
    before = F.sum(F.col("rank") - F.col("same")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    offsets = borders.select("part", (F.coalesce(before, F.lit(0)) - F.col("same")).alias("base"))
    return ranked.where("first is null").join(F.broadcast(offsets), "part").select(
        *rest, (F.col("base") + F.col("rank")).alias("name"))


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty and equal each other. Of equal texts the row
    with the largest doc_id is kept, null ids ranking lowest; of rows that
    repeat an id and a text one is kept. A repeated id with another text is
    another document. No rows give no rows; other columns are ignored.
    """
    blocks = text_blocks(docs, block_bytes).withColumn("digest", F.unhex(F.sha2("block", 256)))
    names = name_by_rank(blocks, ["block"], ["doc_id", "sha", "pos"], ("digest",))
    names = names.withColumn("copies", F.lit(1).cast("long"))
    longest = names.agg(F.max("n_blocks")).first()[0] or 1
    ids, level = [], 0
    while True:
        ids.append(names.where("n_blocks = 1").select(
            "doc_id", "sha", F.lit(level).alias("level"), "name", "copies"))
        if longest == 1:
            break
        left = F.col("pos") % 2 == 0
        pairs = names.where("n_blocks > 1").groupBy(
            "doc_id", "sha", F.ceil(F.col("n_blocks") / 2).alias("n_blocks"), F.floor(F.col("pos") / 2).alias("pos")
        ).agg(F.max(F.when(left, F.col("name"))).alias("a"),
              F.coalesce(F.max(F.when(~left, F.col("name"))), F.lit(0)).alias("b"),
              F.sum(F.when(left, F.col("copies"))).alias("copies"))
        names = name_by_rank(pairs, ["a", "b"], ["doc_id", "sha", "pos"])
        longest, level = -(-longest // 2), level + 1
    every = ids[0]
    for more in ids[1:]:
        every = every.unionByName(more)
    every = written(every.groupBy("doc_id", "sha", "level", "name").agg(F.sum("copies").alias("copies")), "identities")
    groups = written(every.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"),
                                                        F.sum("copies").alias("group_size")), "groups")
    joined = every.join(groups, ["level", "name"]).select(
        "doc_id", "sha", "keep_id", "group_size",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return joined.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
