"""The corpus pipeline: toxicity filter, exact dedup, near-duplicate removal,
source mix, and BPE encoding of what is left.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written
and read again as the next one's ``docs``; all but the last return the columns
of ``documents``, further columns of the input included. Each works on all
rows its predecessor kept. Empty tables go through every stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.bpe_tree import round_trip
from tagloom.llm.common import read, written
from tagloom.llm.exact_dedup import exact_dedup, text_key
from tagloom.llm.queries import tokenizer_file
from tagloom.llm.shingle_join import raw_key, similar_texts
from tagloom.llm.source_mix import mixed_documents
from tagloom.llm.toxicity import learn, toxic_score

#: The filter learns its weights and the near-duplicate join draws tokens: no SQL.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; null and empty texts stay."""
    model = learn(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxic_score(model) < 0.5)


def _only(docs: DataFrame, key: Column, kept: DataFrame, kept_key: Column) -> DataFrame:
    """Rows whose doc_id and key were kept; of rows that repeat both, one (the
    least by the other columns, then the text)."""
    # the row travels as one struct: its columns may have any names
    rows = docs.select(F.struct("*").alias("doc"), F.concat_ws(":", F.col("doc_id").cast("long"), key).alias("at"))
    names = [c.replace("`", "``") for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map" not in kind]
    rest = [F.col(f"doc.`{c}`") for c in names]
    # copies meet before they are moved, so no task holds all rows of an id or a text
    one = rows.groupBy("at").agg(F.min_by("doc", F.struct(*rest, F.col("doc.text"))).alias("doc"))
    at = kept.select(F.concat_ws(":", "doc_id", kept_key).alias("at"))
    return one.join(at, "at", "left_semi").select("doc.*")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in either case) the row with the largest doc_id
    stays, null ids ranking lowest. Ids may repeat: rows that share only the id
    are told apart by their texts."""
    kept = exact_dedup(docs).where("kept")
    return _only(docs, text_key(F.col("text").cast("binary")), kept, F.col("text_sha256"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similarity 0.8 the smallest doc_id stays, null
    ids ranking highest, and one text where several of the group have that id.
    Texts without words have no similarity and stay."""
    kept = similar_texts(docs, named=True).where("kept")
    kept = kept.groupBy("doc_id", F.coalesce("root", "sha")).agg(F.min("sha").alias("sha"))
    return _only(docs, F.hex(raw_key(F.col("text"))), kept, F.hex("sha"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0, 1 or 2 times): the whole
    passes over its shard, and once more for the documents that a seeded even
    choice along their sizes picks to fill the quota."""
    return mixed_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and whether the ids decode to the text."""
    coded = round_trip(docs, tokenizer_file("byte_bpe_50k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("source_mix", mix_stage),
    ("bpe", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
