"""The ``posts`` fixture: a post dump derived from the driver tables.

``documents`` left-joined with ``labels`` becomes a table shaped like the rows
of a post dump (every attribute a string, ``_``-prefixed names):

* every fifth document (``doc_id`` divisible by 5) is an answer (type 2), the
  others are questions (type 1);
* every post is tagged ``<lang><source>`` plus ``<Quality>`` / ``<Toxic>``
  when a label says so;
* the title is the first line of the text, the body the whole text;
* the creation date is spread over 900 days from 2018-01-01 by ``doc_id``;
* ``_ViewCount`` holds the text ``n/a`` for German documents, so the typed
  conversion has malformed cells to turn into NULL.

The same derivation is written in DuckDB SQL in ``tagloom.plans.oracle`` so the
two engines start from identical input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import spread_thin_input
from tagloom.sources.schema import RAW_POST_FIELDS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def posts_fixture(spark: SparkSession, sf_dir: str, spread: bool = False,
                  prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Raw post rows (all-string columns, dump attribute names).

    ``spread`` is for work on the texts: a table in fewer parts than there are
    cores is dealt over them first. ``prepare`` adds columns to the documents
    before their flags are joined; the posts have them too. What is made of a
    text alone is made there, and the texts are not shuffled for the join.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    if spread:
        docs = spread_thin_input(docs, "doc_id")
    given = docs.columns
    if prepare:
        docs = prepare(docs)
    flags = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("l_doc_id"), "quality", "toxic")
    # labels is narrow (three integers per row); Spark broadcasts it only when
    # its measured size is under the broadcast threshold, otherwise both sides
    # are shuffled on doc_id (unique keys: no hot key on this join).
    j = docs.join(flags, docs.doc_id == flags.l_doc_id, "left")
    is_question = F.col("doc_id") % 5 != 0
    created = F.concat(
        F.date_format(F.date_add(F.lit("2018-01-01").cast("date"),
                                 F.pmod(F.col("doc_id"), F.lit(900)).cast("int")), "yyyy-MM-dd"),
        F.lit("T21:42:52.667"))
    tags = F.concat(
        F.lit("<"), F.col("lang"), F.lit("><"), F.col("source"), F.lit(">"),
        F.when(F.col("quality") == 1, F.lit("<Quality>")).otherwise(F.lit("")),
        F.when(F.col("toxic") == 1, F.lit("<Toxic>")).otherwise(F.lit("")))
    null = F.lit(None).cast("string")
    values = {
        "_Id": F.col("doc_id").cast("string"),
        "_PostTypeId": F.when(is_question, F.lit("1")).otherwise(F.lit("2")),
        "_CreationDate": created,
        "_Score": F.col("n_chars").cast("string"),
        "_ViewCount": F.when(F.col("lang") == "de", F.lit("n/a"))
                       .otherwise(F.length(F.split_part(F.col("text"), F.lit("\n"), F.lit(1))).cast("string")),
        "_Body": F.col("text"),
        "_OwnerDisplayName": F.col("source"),
        "_LastActivityDate": created,
        "_Title": F.split_part(F.col("text"), F.lit("\n"), F.lit(1)),
        "_Tags": tags,
    }
    return j.select([values.get(name, null).alias(name) for name, _ in RAW_POST_FIELDS]
                    + [c for c in docs.columns if c not in given])
