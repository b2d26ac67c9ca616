"""Text features: the ML stages of the tagging pipeline and exact-term TF-IDF.

``feature_stages`` builds tokenizer -> stop words -> hashed TF -> IDF, all
built-in JVM stages. ``exact_tfidf`` is the same weighting over real terms
(no hash collisions) written as DataFrame aggregates; it is the checkable
twin of the hashed stages and the input of SQL-side linear scoring.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.text import remove_stop_words, stop_words, tokenize
from tagloom.session import written

# A document-frequency table of at most this many rows is broadcast; larger
# ones are joined by shuffle, where both sides are plain exchanges and AQE
# splits the partition of a hot term.
BROADCAST_TERMS = 200_000
#: Tags counted or summed side by side: a row has a column for each.
TAG_BLOCK = 32


def text_tokenizer(input_col: str = "Title", output_col: str = "TitleSplitted") -> Tokenizer:
    return Tokenizer(inputCol=input_col, outputCol=output_col)


def stop_words_remover(input_col: str = "TitleSplitted", output_col: str = "TitleStop",
                       words: list[str] | None = None) -> StopWordsRemover:
    return StopWordsRemover(inputCol=input_col, outputCol=output_col,
                            stopWords=list(stop_words() if words is None else words))


def hashing_tf(num_features: int = 1000, input_col: str = "TitleStop",
               output_col: str = "TFOut") -> HashingTF:
    return HashingTF(numFeatures=num_features, inputCol=input_col, outputCol=output_col)


def idf(min_doc_freq: int = 2, input_col: str = "TFOut", output_col: str = "features") -> IDF:
    return IDF(minDocFreq=min_doc_freq, inputCol=input_col, outputCol=output_col)


def feature_stages(text_col: str = "Title", num_features: int = 1000, min_doc_freq: int = 2,
                   features_col: str = "features"):
    """Tokenizer -> StopWordsRemover -> HashingTF -> IDF (4 stages)."""
    return [
        text_tokenizer(text_col, "TitleSplitted"),
        stop_words_remover("TitleSplitted", "TitleStop"),
        hashing_tf(num_features, "TitleStop", "TFOut"),
        idf(min_doc_freq, "TFOut", features_col),
    ]


def _tokens(text_col: str, drop_stop_words: bool):
    toks = tokenize(text_col)
    return remove_stop_words(toks) if drop_stop_words else toks


def distinct_terms(text_col: str, drop_stop_words: bool = True):
    """Distinct terms of a text, as an array: what several passes read can be
    written, and the texts are split once."""
    toks = F.array_distinct(tokenize(text_col))
    return remove_stop_words(toks) if drop_stop_words else toks


def terms(df: DataFrame, id_col: str, text_col: str, drop_stop_words: bool = True) -> DataFrame:
    """(id, term) rows: one per distinct term of a document. ``text_col`` is a
    text, or its ``distinct_terms``.

    Repeats are removed inside the row, so nothing is shuffled for it.
    """
    known = isinstance(df.schema[text_col].dataType, T.ArrayType)
    distinct = F.col(text_col) if known else distinct_terms(text_col, drop_stop_words)
    # the optimizer puts a filter on the array below a plain explode, and would split each text for it too
    rows = df.select(F.col(id_col).alias("id"), F.explode_outer(distinct).alias("term"))
    return rows.where(F.col("term").isNotNull())


def term_frequencies(df: DataFrame, id_col: str, text_col: str,
                     drop_stop_words: bool = True) -> DataFrame:
    """(id, term, tf): occurrences of each term in each document.

    Counted inside the row: the sorted tokens are cut where the term changes.
    A document is one row, so no shuffle is needed.
    """
    rows = df.select(F.col(id_col).alias("id"), F.array_sort(_tokens(text_col, drop_stop_words)).alias("s"))
    return _counted_runs(rows).select("id", "r.term", "r.tf")


def _counted_runs(rows: DataFrame) -> DataFrame:
    """(id, s: sorted array) -> (id, r: struct of term and tf), one per run."""
    new = F.transform("s", lambda t, i: F.when((i == 0) | (F.get("s", i - 1) != t), i))
    rows = rows.withColumn("at", F.filter(new, lambda i: i.isNotNull()))
    runs = F.transform("at", lambda i, k: F.struct(
        F.get("s", i).alias("term"),
        (F.coalesce(F.get("at", k + 1), F.size("s")) - i).cast("bigint").alias("tf")))
    return rows.select("id", F.explode(runs).alias("r"))


def document_frequencies(df: DataFrame, id_col: str, text_col: str, drop_stop_words: bool = True) -> DataFrame:
    """(term, df): documents containing each term. One exchange, with partial
    counts per partition before it."""
    return terms(df, id_col, text_col, drop_stop_words).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def label_term_counts(df: DataFrame, vocabulary: Sequence[str], terms_col: str = "terms", label_col: str = "label") -> DataFrame:
    """(label, term, a): rows with both the tag of place ``label`` in the
    vocabulary and the term, for pairs that occur. A row's terms are counted
    for TAG_BLOCK tags side by side: one group per term, not one per pair."""
    blocks = []
    for low in range(0, len(vocabulary), TAG_BLOCK):
        on = [F.coalesce(F.array_contains(label_col, t), F.lit(False)) for t in vocabulary[low:low + TAG_BLOCK]]
        blocks.append(F.struct(F.lit(low // TAG_BLOCK).alias("block"), F.array(*on).alias("on")))
    empty = F.array().cast("array<struct<block:int,on:array<boolean>>>")
    blocks = F.filter(F.array(*blocks) if blocks else empty, lambda b: F.exists(b["on"], lambda x: x))
    rows = df.select(F.col(terms_col).alias("terms"), F.explode_outer(blocks).alias("b")).where("b is not null")
    rows = rows.select(F.explode("terms").alias("term"), "b.block", "b.on")
    width = min(TAG_BLOCK, max(1, len(vocabulary)))
    counts = rows.groupBy("term", "block").agg(*[F.sum(F.when(F.get("on", F.lit(j)), 1).otherwise(0)).alias(f"a{j}") for j in range(width)])
    pairs = counts.select("term", "block", F.posexplode(F.array(*[f"a{j}" for j in range(width)])).alias("place", "a")).where("a > 0")
    return pairs.select((F.col("block") * TAG_BLOCK + F.col("place")).alias("label"), "term", "a")


def join_by_term(rows: DataFrame, table: DataFrame, n_rows: int, col: str = "term") -> DataFrame:
    """``rows`` joined to a per-term ``table`` of ``n_rows`` rows (a written
    table): broadcast below BROADCAST_TERMS, by shuffle beyond."""
    return rows.join(F.broadcast(table) if n_rows <= BROADCAST_TERMS else table, col)


def exact_tfidf(df: DataFrame, id_col: str, text_col: str, min_doc_freq: int = 0,
                drop_stop_words: bool = True) -> DataFrame:
    """(id, term, tf, df, idf, tfidf) with Spark IDF's weighting.

    idf = ln((N + 1) / (df + 1)), and 0 for terms in fewer than
    ``min_doc_freq`` documents; N counts every input document (also those
    without terms). The df table is written, so that its size is known and its
    join has plain exchanges.
    """
    n_docs = df.select(id_col).count()
    dfreq = written(document_frequencies(df, id_col, text_col, drop_stop_words), "doc-freq")
    tf = term_frequencies(df, id_col, text_col, drop_stop_words)
    weight = F.when(F.col("df") >= min_doc_freq,
                    F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0))).otherwise(F.lit(0.0))
    return (join_by_term(tf, dfreq, dfreq.count())
            .select("id", "term", "tf", "df", weight.alias("idf"))
            .withColumn("tfidf", F.col("tf") * F.col("idf")))


def legacy_bucket(word, num_features: int = 1000):
    """Bucket of a word under the hash that HashingTF had before Spark 3 (the
    one of SQL's ``hash``: Murmur3 with single trailing bytes, seed 42). The
    current stage hashes trailing bytes together, so words whose length in
    bytes is no multiple of four mostly fall into other buckets."""
    return F.pmod(F.hash(word), F.lit(num_features))


def legacy_term_frequencies(df: DataFrame, id_col: str, tokens_col: str, num_features: int = 1000) -> DataFrame:
    """(id, bucket, tf) under the older hash, counted inside the row."""
    rows = df.select(F.col(id_col).alias("id"), F.array_sort(F.transform(tokens_col, lambda w: legacy_bucket(w, num_features))).alias("s"))
    return _counted_runs(rows).select("id", F.col("r.term").alias("bucket"), "r.tf")
