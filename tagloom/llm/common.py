"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import scratch_path

#: Hash values that ``likely`` broadcasts at most, 8 bytes each.
HASH_SLOTS = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: the rows
    survive lost executors, the lineage is cut, and joins of the result get
    plain exchanges, whose large partitions adaptive execution can split."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove ``written`` tables that nothing reads any more: what was made of
    them must have been written as well."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_HELD: dict = {}


def release() -> None:
    """Drop what another operator has kept in this Python worker."""
    _HELD.clear()


def worker_state(build, *args):
    """``build(*args)``, kept in the Python worker for its next task. Workers
    serve one operator after another, so only the last one's is kept."""
    key = build, *args
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build(*args)
    return _HELD[key]


def likely(rows: DataFrame, column: str, wanted: DataFrame, other: str) -> DataFrame:
    """Rows whose ``column`` may be among ``wanted``'s ``other``: a filter that
    lets through all wanted rows and few others, for use before a shuffle.

    At most HASH_SLOTS hash values are broadcast, however many are wanted; with
    more than that the filter only lets more rows through.
    """
    def slot(name: str):
        return F.pmod(F.xxhash64(name), F.lit(HASH_SLOTS))

    slots = wanted.select(slot(other).alias("_slot")).distinct()
    return rows.withColumn("_slot", slot(column)).join(F.broadcast(slots), "_slot", "left_semi").drop("_slot")
