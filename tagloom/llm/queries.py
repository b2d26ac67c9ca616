"""Registered queries of the training-data operators, one per operator.

Each applies its operator with production parameters to its whole table and
derives the digest columns from the operator's output. Tokenizer files are
looked up by name; operators take their path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.bpe_tree import round_trip
from tagloom.llm.chat_repair import damage, repair, summaries
from tagloom.llm.chat_rotation import rotate
from tagloom.llm.common import read
from tagloom.llm.embedding_neardup import near_vectors
from tagloom.llm.exact_dedup import exact_dedup
from tagloom.llm.language_id import identify
from tagloom.llm.piece_rounds import piece_round_trip
from tagloom.llm.prefix_tokens import prefix_tokens, tokens_of
from tagloom.llm.ranked_search import ranked_search
from tagloom.llm.secret_scan import find_secrets
from tagloom.llm.shingle_join import similar_texts
from tagloom.llm.source_mix import mix_sources
from tagloom.llm.toxicity import toxicity

TOKEN_LIMIT = 4096


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_texts(read(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op5_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation, speaker and piece, with digests of the
    rendered text and its masks."""
    spans = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return rotate(read(spark, sf_dir, "conversations")).select(
        "conv_id", "speaker", "piece", "offset", "n_turns", F.length("text").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"), spans.alias("masks"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = prefix_tokens(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", tokens_of("prefix_tokens").alias("n_tokens")).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(round_trip(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")))


def _digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")

    counts = [count("assign"), count("access"), count("hex")]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op11_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations without a row left have zeros and the digest of nothing."""
    conversations = read(spark, sf_dir, "conversations")
    found = summaries(repair(damage(conversations))).withColumnRenamed("conv_id", "of")
    rows = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return rows.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"))


def op13_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digests(piece_round_trip(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model")))


LLM_QUERIES = {
    "op1_embedding_neardup": op1_embedding_neardup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_source_mix": op3_source_mix,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_chat_rotation": op5_chat_rotation,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_bpe_round_trip": op9_bpe_round_trip,
    "op10_secret_scan": op10_secret_scan,
    "op11_chat_repair": op11_chat_repair,
    "op12_ranked_search": op12_ranked_search,
    "op13_piece_round_trip": op13_piece_round_trip,
}
