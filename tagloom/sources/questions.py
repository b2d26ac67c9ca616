"""The question table on storage: Parquet partitioned by Year and Month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.etl import layout_by_month


def save_questions(questions: DataFrame, path: str, mode: str = "overwrite",
                   dynamic_overwrite: bool = False, num_partitions: int | None = None,
                   max_records_per_file: int | None = None) -> None:
    """Write the question table partitioned by Year, Month.

    ``dynamic_overwrite`` replaces only the months present in ``questions``
    (incremental loads); otherwise the whole table is replaced.
    """
    w = layout_by_month(questions, num_partitions).write.mode(mode).partitionBy("Year", "Month")
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)


def load_questions(spark: SparkSession, path: str, columns=("Id", "label", "Title"),
                   year: int | None = None, month: int | None = None) -> DataFrame:
    """Read the question table; only ``columns`` are read from the files and
    Year / Month predicates prune whole partition folders."""
    df = spark.read.parquet(path)
    if year is not None:
        df = df.where(F.col("Year") == year)
    if month is not None:
        df = df.where(F.col("Month") == month)
    return df.select(*columns) if columns else df
