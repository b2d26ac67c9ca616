"""Label-set operators: filter tags, vocabulary, counts, targets, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.tags import keep_tags, target_column
from tagloom.session import written

# Dictionaries up to this many rows are broadcast (their table is written, so
# the count is known); larger ones are joined by shuffle.
BROADCAST_TAGS = 200_000
#: Items that the heavy-hitter sketch of a partition tracks.
SKETCH_ITEMS = 8192
#: Tags that may reach the driver: one binary model each.
MAX_TAGS = 100_000


def filter_tags(df: DataFrame, tags: Sequence[str], label_col: str = "label") -> DataFrame:
    """Keep only ``tags`` in the label arrays and drop rows left with none.

    A NULL label array gives a NULL filtered array; ``size(NULL)`` is NULL, so
    the row is dropped as well.
    """
    return (df.withColumn(label_col, keep_tags(label_col, tags))
              .where(F.size(label_col) > 0))


def label_counts(df: DataFrame, label_col: str | None = "label") -> DataFrame:
    """(label, n): how often each tag is assigned (``label_col`` None: the tags
    are rows of a column ``label`` already).

    ``groupBy`` aggregates partially on every partition before the shuffle, so
    a tag present on a third of all rows still sends one row per partition.
    """
    tags = df.select(F.explode(label_col).alias("label")) if label_col else df
    return tags.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def label_vocabulary(df: DataFrame, label_col: str = "label", min_support: int = 1,
                     top_n: int | None = None) -> list[str]:
    """Sorted distinct tags (the label -> index coding of a model).

    The result has one entry per model member, so its size is the model size;
    only that list reaches the driver. More than MAX_TAGS tags are refused
    (``top_n`` or ``min_support`` bound them; ``tag_dictionary`` codes any
    number). Ordering is by tag text, so index i is stable across runs.
    """
    if top_n is not None:
        return sorted(r["label"] for r in top_labels(df, top_n, label_col, min_support).collect())
    counts = label_counts(df, label_col)
    if min_support > 1:
        counts = counts.where(F.col("n") >= min_support)
    found = counts.select("label").limit(MAX_TAGS + 1).collect()
    if len(found) > MAX_TAGS:
        raise ValueError(f"more than {MAX_TAGS} tags: give top_n or min_support")
    return sorted(r["label"] for r in found)


def top_labels(df: DataFrame, n: int, label_col: str = "label", min_support: int = 1,
               sketch_items: int = SKETCH_ITEMS) -> DataFrame:
    """(label, n) of the ``n`` most frequent tags, exactly; ties by tag text.

    A mergeable heavy-hitter sketch of every partition names candidates, and
    only these are counted, so that rare tags (most of them, in a large dump)
    are never shuffled. The counts prove the answer: either the candidates hold
    all assignments, or the n-th is above what a tag can have that the sketch
    does not name (7 / ``sketch_items`` of all: it has been off by half of that
    at most, twice). Otherwise all tags are counted.
    """
    tags = df.select(F.explode(label_col).alias("label")).where("label is not null")
    size = 1 << max(4, (int(sketch_items) - 1).bit_length())
    sketch = F.expr(f"approx_top_k(label, {size * 3 // 4}, {size})")     # all that it holds
    named = tags.agg(F.count(F.lit(1)).alias("total"), sketch.alias("items")).first()
    names = [(r["item"],) for r in named["items"] or []]
    candidates = df.sparkSession.createDataFrame(names, "label string")
    counted = label_counts(tags.join(F.broadcast(candidates), "label"), None).collect()
    best = sorted((r for r in counted if r["n"] >= min_support), key=lambda r: (-r["n"], r["label"]))[:n]
    if sum(r["n"] for r in counted) == named["total"] or len(best) == n and best[-1]["n"] > 7 * named["total"] / size:
        return df.sparkSession.createDataFrame(best, "label string, n long")
    order = F.col("n").desc(), F.col("label")
    return label_counts(tags, None).where(F.col("n") >= min_support).orderBy(*order).limit(n)


def tag_dictionary(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Written table (tag, code): every distinct tag with its place in the
    order of the tag texts, from 0.

    Tags are sorted over range partitions; a partition's first index is the
    number of tags in the partitions before it. Nothing but those counts, one
    a partition, is gathered.
    """
    tags = label_counts(df, label_col).select(F.col("label").alias("tag")).where("tag is not null")
    dealt = tags.repartitionByRange("tag").select("tag", F.spark_partition_id().alias("part"))
    dealt = written(dealt.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("tag"))), "sorted-tags")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    coded = dealt.join(F.broadcast(starts), "part")     # a row per partition
    return written(coded.select("tag", (F.col("start") + F.col("place") - 1).cast("int").alias("code")), "tag-dictionary")


def _through(df: DataFrame, dictionary: DataFrame, col: str, out: str, have: str, give: str, value: Column, missing: Column | None,
             id_col: str | None) -> DataFrame:
    """``col``'s elements looked up in the dictionary, in order. Rows meet their
    elements again by ``id_col``, or by a number of their own; numbers are
    written first, as two readings of a plan may number differently."""
    if id_col is None:
        numbered = written(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    else:
        numbered = df.withColumn("__row", F.col(id_col))
    items = numbered.select("__row", F.posexplode(col).alias("__pos", "__item"))
    table = dictionary.select(F.col(have).alias("__key"), value.alias("__value"))
    if dictionary.count() <= BROADCAST_TAGS:
        table = F.broadcast(table)
    found = items.join(table, items["__item"] == table["__key"], "left")
    element = F.col("__value") if missing is None else F.coalesce("__value", missing)
    lists = found.where(element.isNotNull()).groupBy("__row").agg(
        F.array_sort(F.collect_list(F.struct("__pos", element.alias("__value")))).alias("__list"))
    coded = F.transform("__list", lambda x: x["__value"])
    empty = F.array().cast(f"array<{give}>")
    joined = numbered.join(lists, "__row", "left")
    return joined.select(*[c for c in df.columns if c != out], F.when(F.col(col).isNotNull(), F.coalesce(coded, empty)).alias(out))


def encode_labels(df: DataFrame, dictionary: DataFrame, label_col: str = "label", out: str = "indexes",
                  keep_unknown: bool = False, id_col: str | None = None) -> DataFrame:
    """Tag arrays -> array<double> of dictionary codes, order and repeats
    kept; unknown tags are dropped, or coded -1.0. Equal to
    ``label_indexes`` for dictionaries of any size: the plan holds no tag.
    ``id_col``: a unique column without nulls, if there is one; it saves
    writing the rows with numbers."""
    return _through(df, dictionary, label_col, out, "tag", "double", F.col("code").cast("double"), F.lit(-1.0) if keep_unknown else None, id_col)


def decode_labels(df: DataFrame, dictionary: DataFrame, index_col: str = "prediction", out: str = "predictionLabel",
                  id_col: str | None = None) -> DataFrame:
    """Index arrays -> tag arrays by the dictionary table; indexes that it has
    not are dropped. ``id_col`` as in ``encode_labels``."""
    return _through(df, dictionary, index_col, out, "code", "string", F.col("tag"), None, id_col)


def num_labels(df: DataFrame, label_col: str = "label") -> int:
    """Number of distinct tags."""
    return df.select(F.explode(label_col).alias("l")).agg(F.count_distinct("l")).first()[0]


def label_cardinality(df: DataFrame, label_col: str = "label", id_col: str = "Id") -> DataFrame:
    """One row: distinct tags, posts, assignments, mean tags per post.

    One aggregate over the exploded rows: per-post quantities are counted on
    the first position only (or on the NULL row of an empty set).
    """
    ex = df.select(F.posexplode_outer(label_col).alias("pos", "lbl"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    return ex.agg(
        F.count_distinct("lbl").cast("bigint").alias("n_labels"),
        F.sum(F.when(first, 1).otherwise(0)).cast("bigint").alias("n_posts"),
        F.count("lbl").cast("bigint").alias("n_assignments"),
    ).withColumn("mean_labels", F.col("n_assignments") / F.col("n_posts"))


def with_targets(df: DataFrame, vocabulary: Sequence[str], label_col: str = "label",
                 prefix: str = "target_") -> DataFrame:
    """Add one 0/1 double target column per vocabulary tag."""
    return df.select("*", *[target_column(label_col, t).alias(f"{prefix}{i}")
                            for i, t in enumerate(vocabulary)])


def target_string(vocabulary: Sequence[str], label_col: str = "label"):
    """'0101…': the binary-relevance target vector of a row as text."""
    vocab = F.array(*[F.lit(t) for t in vocabulary])
    return F.array_join(F.transform(vocab, lambda t: F.when(
        F.coalesce(F.array_contains(F.col(label_col), t), F.lit(False)), F.lit("1")).otherwise(F.lit("0"))), "")


def split_column(id_col: str = "Id", ratio: float = 0.8, seed: int = 0, method: str = "hash"):
    """Deterministic train/test assignment from the row id.

    Unlike ``randomSplit`` the side of a row does not depend on partitioning
    or task retries, so a lost executor recomputes exactly the same split.
    ``method='hash'`` uses xxhash64 (well mixed); ``'arith'`` a multiplicative
    rule that other engines can evaluate too.
    """
    cut = int(round(ratio * 1000))
    if method == "hash":
        bucket = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1000))
    elif method == "arith":
        # reduced before the product: large ids do not overflow
        low = F.pmod(F.col(id_col).cast("bigint"), F.lit(1000))
        bucket = F.pmod(low * F.lit(7919) + F.lit(seed * 104729), F.lit(1000))
    else:
        raise ValueError(f"unknown split method {method!r}")
    return F.when(bucket < cut, F.lit("train")).otherwise(F.lit("test"))


def stable_split(df: DataFrame, ratio: float = 0.8, seed: int = 0, id_col: str = "Id",
                 method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """(train, test) by :func:`split_column`."""
    side = split_column(id_col, ratio, seed, method)
    return df.where(side == "train"), df.where(side == "test")
