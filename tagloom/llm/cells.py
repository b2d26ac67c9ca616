"""Comparing all rows of each bucket, however large, in cells of bounded size.

A bucket's rows are dealt to blocks by a hash; every pair of blocks is a cell,
one unit of work. A row goes to as many cells as its bucket has blocks, so no
task ever holds a whole bucket, and no pair leaves its cell: cells return
counts per row and a few links that connect what they found.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 256


def to_cells(rows: DataFrame, bucket: str, members: str, by: Column, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows with their bucket and its size (column ``members``) -> rows with
    ``cell`` (bucket, i, j) and ``block`` (of the row)."""
    blocks = F.ceil(F.col(members) / block_rows).cast("int")
    own = F.pmod(by, F.col("_n")).cast("int")
    dealt = rows.withColumn("_n", blocks).withColumn("block", own)
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    return dealt.withColumn("_o", other).withColumn(
        "cell", F.struct(F.col(bucket).alias("bucket"), F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"))
    ).drop("_n", "_o", members, bucket)


def over_cells(cells: DataFrame, work: Callable[[pa.Table], list[pa.RecordBatch]], ddl: str) -> DataFrame:
    """Apply ``work`` to the rows of each cell. Cells are dealt by their key
    and read in sorted order, several per batch; only one is held at a time."""
    keyed = cells.withColumn("_key", F.xxhash64("cell.bucket", "cell.i", "cell.j"))
    dealt = keyed.repartition("_key").sortWithinPartitions("_key", "cell.bucket", "cell.i", "cell.j")

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell")
            b, i, j = (cell.field(k) for k in range(3))
            n = batch.num_rows
            new = [0]
            if n > 1:
                differs = None
                for column in (b, i, j):
                    d = pc.not_equal(column.slice(1), column.slice(0, n - 1))
                    differs = d if differs is None else pc.or_(differs, d)
                new += [int(k) + 1 for k in pc.indices_nonzero(differs).to_pylist()]
            for a, z in zip(new, [*new[1:], n]):
                key = (b[a].as_py(), i[a].as_py(), j[a].as_py())
                if key != last and held:
                    yield from work(pa.Table.from_batches(held))
                    held = []
                last = key
                held.append(batch.slice(a, z - a))
        if held:
            yield from work(pa.Table.from_batches(held))

    return dealt.drop("_key").mapInArrow(run, ddl)
