"""Tag arriving posts with a fitted pipeline (Structured Streaming).

The same ``PipelineModel`` that scores tables scores a stream: every stage
(tokenizer, stop words, hashed TF, IDF, the binary-relevance members and the
index/tag expressions) is a per-row projection with no action, so the
streaming plan is a stateless map: each micro-batch is read and scored once.
Rejected requests keep their reason and get no tags; the checkpoint makes the
file sink exactly-once across restarts and executor loss.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.operators.scoring import json_request_status, parse_requests, reply_json, request_status


def read_request_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path)


def files_per_batch(spark: SparkSession, waiting: int) -> int:
    """Files of a micro-batch, for so many that wait: one for each core, as
    fewer leave cores idle while a batch lasts; but a quarter of them at most,
    and 2 at least."""
    return max(2, min(spark.sparkContext.defaultParallelism, waiting // 4))


def score_stream(requests: DataFrame, model: PipelineModel, keep=("Id",),
                 tags_col: str = "predictionLabel") -> DataFrame:
    """Streaming DataFrame of (kept columns, reason, tags, reply).

    Invalid requests keep a reason and NULL tags and reply; rows of
    ``parse_requests`` are rejected for malformed texts as well. Every row goes
    through the model once, with empty text where it is missing.
    """
    status = json_request_status() if "malformed" in requests.columns else request_status()
    rows = requests.withColumn("reason", status)
    for c in ("Title", "Body"):
        rows = rows.withColumn(c, F.coalesce(c, F.lit("")))
    valid = F.col("reason").isNull()
    return model.transform(rows).select(*keep, "reason", F.when(valid, F.col(tags_col)).alias("tags"),
                                        F.when(valid, reply_json(tags_col)).alias("reply"))


def start_scoring(requests: DataFrame, model: PipelineModel, output_path: str, checkpoint_path: str,
                  keep=("Id",), available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """Start the scoring stream into a file sink (append mode)."""
    out = score_stream(requests, model, keep)
    w = (out.writeStream.format(fmt).option("path", output_path)
         .option("checkpointLocation", checkpoint_path).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_json_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Arriving text files, one JSON request a line, as parsed requests."""
    return parse_requests(read_request_stream(spark, path, "value string", "text", max_files_per_trigger))


def start_scoring_tables(requests: DataFrame, model: PipelineModel, output_path: str, checkpoint_path: str,
                         keep=("Id",), available_now: bool = True) -> StreamingQuery:
    """Start the scoring stream into two tables, ``outcome=tags`` and
    ``outcome=rejects`` under one folder.

    Both are one file sink, whose log is keyed by the batch id: a batch that is
    replayed after a failure changes neither table, and a batch's tags and
    rejects appear together. Read them with ``scored_tables``.
    """
    out = score_stream(requests, model, keep).withColumn(
        "outcome", F.when(F.col("reason").isNull(), F.lit("tags")).otherwise(F.lit("rejects")))
    w = (out.writeStream.format("parquet").option("path", output_path).partitionBy("outcome")
         .option("checkpointLocation", checkpoint_path).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def scored_tables(spark: SparkSession, output_path: str) -> tuple[DataFrame, DataFrame]:
    """(tags, rejects) that ``start_scoring_tables`` has written: whole batches
    only. Each read prunes the other's folder."""
    table = spark.read.parquet(output_path)
    return (table.where("outcome = 'tags'").drop("outcome", "reason"),
            table.where("outcome = 'rejects'").drop("outcome", "tags", "reply"))
