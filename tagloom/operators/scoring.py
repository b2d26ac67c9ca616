"""Scoring: validate requests, tag posts with a saved pipeline, JSON replies.

The web-service path of a tagging model becomes table (and stream) scoring:
requests are rows, invalid ones go to a rejects table with a reason, valid
ones are scored by the fitted ``PipelineModel`` and written with their reply.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.features import TAG_BLOCK
from tagloom.operators.labels import decode_labels
from tagloom.session import scratch_path, written

# Rejection reasons of a scoring request.
REASON_NO_TITLE = "title is required"
REASON_NO_BODY = "body is required"
REASON_NO_JSON = "request is no JSON object"
REASON_WRONG_TYPE = "title and body must be text"


def request_status(title_col: str = "Title", body_col: str = "Body") -> Column:
    """NULL for a valid request, else the reason it is rejected.

    A title must hold a character beyond blanks and control characters (up to
    U+0020); a body must be present (any text, also empty).
    """
    blank = ~F.coalesce(F.col(title_col).rlike(r"[^\x00-\x20]"), F.lit(False))
    return (F.when(blank, F.lit(REASON_NO_TITLE))
             .when(F.col(body_col).isNull(), F.lit(REASON_NO_BODY)))


def json_request_status() -> Column:
    """As ``request_status``, for the rows of ``parse_requests``."""
    return F.coalesce(F.col("malformed"), request_status())


def parse_requests(df: DataFrame, text_col: str = "value") -> DataFrame:
    """JSON texts, one request each -> Id, Title, Body, text (as it came) and
    malformed: a reason where the text is no JSON object, or where a value has
    the wrong type. Absent keys give NULL, which ``request_status`` judges.
    A projection only, for tables and streams alike."""
    parsed = F.from_json(F.col(text_col), "Id long, Title variant, Body variant, _corrupt string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    kinds = [F.schema_of_variant(F.col(f"request.{c}")) for c in ("Title", "Body")]
    # an absent key and a null are no text of another type
    typed = [F.coalesce(k.isin("STRING", "VOID"), F.lit(True)) for k in kinds]
    broken = F.col("request").isNull() | F.col("request._corrupt").isNotNull()
    malformed = (F.when(F.col("text").isNull() | ~F.coalesce(F.col("text").rlike(r"^\s*\{"), F.lit(False)), REASON_NO_JSON)
                  .when(broken, REASON_NO_JSON).when(~(typed[0] & typed[1]), REASON_WRONG_TYPE))
    rows = df.select(F.col(text_col).alias("text"), parsed.alias("request"))
    texts = [F.try_variant_get(F.col(f"request.{c}"), "$", "string") for c in ("Title", "Body")]
    return rows.select(F.when(~broken, F.col("request.Id")).alias("Id"), *[F.when(malformed.isNull(), t).alias(c) for t, c in zip(texts, ("Title", "Body"))],
                       "text", malformed.alias("malformed"))


def split_requests(df: DataFrame, title_col: str = "Title", body_col: str = "Body"):
    """(valid, rejects): rejects carry a ``reason`` column."""
    reason = request_status(title_col, body_col)
    return df.where(reason.isNull()), df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def reply_json(tags_col: str = "predictionLabel") -> Column:
    """``{"tags":[...]}`` for each scored row."""
    return F.to_json(F.struct(F.col(tags_col).alias("tags")))


def score(model: PipelineModel, df: DataFrame, keep=("Id",), tags_col: str = "predictionLabel") -> DataFrame:
    """Tag rows with a fitted pipeline: kept columns, tags and JSON reply."""
    out = model.transform(df)
    return out.select(*keep, F.col(tags_col).alias("tags"), reply_json(tags_col).alias("reply"))


def score_table(model_path: str, requests: DataFrame, output_path: str, rejects_path: str | None = None,
                keep=("Id",), fmt: str = "parquet", block: bool = False) -> None:
    """Batch scoring job: load the saved pipeline, split off invalid requests,
    score the rest and write both tables. ``block``: score linear members by
    their block matrix, for models of many tags (the first of ``keep`` is the
    unique id)."""
    model = PipelineModel.load(model_path)
    valid, rejects = split_requests(requests)
    scored = score_by_block(model, valid, keep, keep[0]) if block else score(model, valid, keep)
    scored.write.mode("overwrite").format(fmt).save(output_path)
    if rejects_path:
        rejects.select(*keep, "reason").write.mode("overwrite").format(fmt).save(rejects_path)


# ------------------------------------------------------- linear SQL scorer ----
# For many tags the chained member transforms grow the plan by one projection
# per tag. Linear members can instead be scored as relational algebra over a
# (tag, feature, weight) table: one join, one grouped sum, one comparison.

import math  # noqa: E402

# Weight tables up to this size are broadcast (their size is known exactly on
# the driver: they are built from fitted parameters). Larger ones are joined
# by shuffle, where AQE splits a hot feature's partition.
BROADCAST_WEIGHTS_MAX_BYTES = 64 * 1024 * 1024
FEATURE_BLOCK = 4096
_BYTES_PER_WEIGHT_ROW = 24      # label, feature number, weight
_BYTES_PER_BLOCK_ROW = TAG_BLOCK * 8 + 64


def logit(p: float) -> float:
    """Margin threshold equivalent to a probability threshold."""
    if p <= 0.0:
        return -math.inf
    if p >= 1.0:
        return math.inf
    return math.log(p / (1.0 - p))


def linear_weight_tables(spark, model):
    """(weights, bias) DataFrames from a BinaryRelevanceModel of linear members:
    weights (label int, i int, w double) for non-zero coefficients, bias
    (label int, b double, cut double: the member's own margin threshold).
    Returns also the number of weight rows."""
    rows, bias = [], []
    for k, m in enumerate(model.models):
        coef = m.coefficients
        idx = coef.indices if hasattr(coef, "indices") else range(len(coef))
        vals = coef.values if hasattr(coef, "values") else coef
        for i, w in zip(idx, vals):
            if w != 0.0:
                rows.append((k, int(i), float(w)))
        bias.append((k, float(m.intercept), logit(m.getThreshold())))
    weights = spark.createDataFrame(rows, "label int, i int, w double")
    return weights, spark.createDataFrame(bias, "label int, b double, cut double"), len(rows)


def sparse_entries(df, id_col: str, features_col: str):
    """(id, i, v) for the non-zero entries of a vector column: the stored
    entries of a sparse vector, the positions of a dense one."""
    u = F.unwrap_udt(F.col(features_col))
    v = df.select(F.col(id_col).alias("id"), u.alias("u"))
    places = F.coalesce(F.col("u.indices"), F.sequence(F.lit(0), F.greatest(F.size("u.values") - 1, F.lit(0))))
    pairs = F.arrays_zip(places.alias("i"), F.col("u.values").alias("v"))
    return v.select("id", F.explode(pairs).alias("e")).select("id", "e.i", "e.v").where("v != 0.0")


def _side_by_side(weights, width: int):
    """(label, i, w) -> a row per feature and block of ``width`` labels, with
    w0 .. (NULL: no weight). ``n``, the uses of a feature, stays where known."""
    place = F.pmod("label", F.lit(width))
    uses = [F.max("n").alias("n")] if "n" in weights.columns else []
    return weights.groupBy("i", F.floor(F.col("label") / width).cast("int").alias("block")).agg(
        *[F.sum(F.when(place == j, F.col("w"))).alias(f"w{j}") for j in range(width)], *uses)


def _sums(met, width: int):
    """(id, block, dots): sums of v * w0 .. of each id and block (NULL: none).
    Plain sums of a fixed number of columns: one row per document leaves a
    task, however many entries and tags it has."""
    sums = met.groupBy("id", "block").agg(*[F.sum(F.col("v") * F.col(f"w{j}")).alias(f"d{j}") for j in range(width)])
    return sums.select("id", "block", F.array(*[f"d{j}" for j in range(width)]).alias("dots"))


def _often_used(rows):
    """Condition for the most used features, as many as may be broadcast (by
    quarter octaves of their uses)."""
    level = F.floor(F.log2("n") * 4).cast("int")
    n_bytes = F.sum(F.octet_length(F.col("i").cast("string")) + F.lit(_BYTES_PER_BLOCK_ROW))
    left, least = BROADCAST_WEIGHTS_MAX_BYTES, 1 << 30
    for r in sorted(rows.groupBy(level.alias("level")).agg(n_bytes.alias("n_bytes")).collect(), reverse=True):
        left -= r["n_bytes"]
        if left < 0:
            break
        least = r["level"]
    return level >= least


def _met_weights(entries, weights, width: int, weight_bytes: int | None):
    """Entries joined to the weights of their feature, side by side. Weights
    known to be small are broadcast. Of others the most used features are,
    which have most of the entries; only the entries of the rest are shuffled."""
    rows = _side_by_side(weights, width)
    # a row of one weight becomes a block of them at most
    if weight_bytes is not None and weight_bytes // _BYTES_PER_WEIGHT_ROW * _BYTES_PER_BLOCK_ROW <= BROADCAST_WEIGHTS_MAX_BYTES:
        return entries.join(F.broadcast(rows), "i")
    if "n" not in rows.columns:
        rows = rows.join(entries.groupBy("i").agg(F.count(F.lit(1)).alias("n")), "i")
    rows = written(rows, "weight-blocks")
    often = _often_used(rows)
    seldom = entries.join(F.broadcast(rows.where(often).select("i").distinct()), "i", "left_anti")
    return entries.join(F.broadcast(rows.where(often)), "i").unionByName(seldom.join(rows.where(~often), "i"))


def linear_decisions(entries, weights, bias, threshold: float, weight_bytes: int | None = None,
                     ids=None):
    """Positive (id, label) pairs of a linear multi-label model, in SQL.

    entries (id, i, v), weights (label, i, w, and optionally n: the entries
    that feature i has), bias (label, b, and optionally cut). margin(id, label)
    = b + sum(v * w); positive iff margin > the label's cut, by default
    logit(threshold) — the members' rule probability > threshold.

    Only pairs with evidence (a shared non-zero feature) are aggregated. A
    pair without evidence has margin b, so it is positive only for the
    "default-on" labels whose bias alone clears the cut; those pairs are
    added for the documents in ``ids`` (one ``id`` column; default: documents
    with entries) that have no evidence row for the label. An entry meets the
    weights of TAG_BLOCK labels in one row: rows grow with the entries and the
    output, not with documents x all labels.
    """
    cut = logit(threshold)
    if "cut" not in bias.columns:
        bias = bias.withColumn("cut", F.lit(cut))
    biases = sorted((r["label"], r["b"], r["cut"]) for r in bias.collect())     # k rows: one per tag
    bias_df = bias.sparkSession.createDataFrame(biases, "label int, b double, cut double")
    width = max(1, min(TAG_BLOCK, max((k for k, _, _ in biases), default=0) + 1))
    sums = _sums(_met_weights(entries, weights, width, weight_bytes), width)
    default_on: dict[int, list[int]] = {}
    for k, b, at in biases:
        if b > at:
            default_on.setdefault(k // width, []).append(k)
    if default_on:
        sums = written(sums, "evidence")        # read twice
    dots = sums.select("id", "block", F.posexplode("dots").alias("place", "dot")).where("dot is not null")
    scored = dots.select("id", (F.col("block") * width + F.col("place")).alias("label"), "dot").join(
        F.broadcast(bias_df), "label")         # k rows, bounded by the model
    positive = scored.where(F.col("dot") + F.col("b") > F.col("cut")).select("id", "label")
    if not default_on:
        return positive
    docs = ids if ids is not None else entries.select("id").distinct()
    blocks = [F.struct(F.lit(block).alias("block"), F.array(*[F.lit(k) for k in on]).alias("on")) for block, on in default_on.items()]
    cand = docs.select("id", F.inline(F.array(*blocks)))
    silent = cand.join(sums, ["id", "block"], "left").select("id", F.explode(
        F.filter("on", lambda k: F.get("dots", k - F.col("block") * width).isNull())).alias("label"))
    return positive.unionByName(silent)


def decisions_to_arrays(decisions, vocabulary, id_col: str = "id"):
    """(id, prediction array<double> ascending, predictionLabel array<string>)."""
    from tagloom.functions.tags import decode_indexes
    g = decisions.groupBy(id_col).agg(F.array_sort(F.collect_list(F.col("label").cast("double"))).alias("prediction"))
    return g.withColumn("predictionLabel", decode_indexes("prediction", vocabulary))


def block_weights(spark, model):
    """(table, rows, bytes): one row per feature, (i, w) with the k members'
    weights as one vector; feature -1 holds intercept less cut, so that a
    margin above 0 is a positive. Built of FEATURE_BLOCK features at a time."""
    members = [m.coefficients.toArray() for m in model.models]
    base = [m.intercept - logit(m.getThreshold()) for m in model.models]
    n_features = len(members[0]) if members else 0
    path = scratch_path(spark, "block-weights")
    schema = "i int, w array<double>"
    spark.createDataFrame([(-1, [float(x) for x in base])], schema).write.parquet(path)
    rows = 1
    for low in range(0, n_features, FEATURE_BLOCK):
        block = [(low + j, column) for j, column in enumerate(zip(*(m[low:low + FEATURE_BLOCK].tolist() for m in members))) if any(column)]
        rows += len(block)
        spark.createDataFrame([(i, list(w)) for i, w in block], schema).write.mode("append").parquet(path)
    blocks = max(1, math.ceil(len(members) / TAG_BLOCK))
    return spark.read.schema(schema).parquet(path), rows, rows * blocks * _BYTES_PER_BLOCK_ROW


def block_margins(entries, weights, n_bytes: int):
    """(id, margins): of every id the vector of its k margins.

    entries (id, i, v) with a row (id, -1, 1.0) for every id; weights (i, w).
    One join, and one sum per document and block of TAG_BLOCK tags: the plan
    does not grow with the tags, and a document is one row again.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.size("w"), F.lit(1)), F.lit(TAG_BLOCK))
    table = weights.select(F.col("i").alias("j"), F.posexplode(F.transform(starts, lambda at: F.slice("w", at, TAG_BLOCK))).alias("block", "w"))
    table = table.select("j", "block", *[F.get("w", F.lit(j)).alias(f"w{j}") for j in range(TAG_BLOCK)])
    if n_bytes <= BROADCAST_WEIGHTS_MAX_BYTES:
        table = F.broadcast(table)
    sums = _sums(entries.join(table, entries["i"] == table["j"]), TAG_BLOCK)
    whole = sums.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("block", "dots"))).alias("blocks"))
    # the last block's places beyond the tags are NULL
    margins = F.filter(F.flatten(F.transform("blocks", lambda b: b["dots"])), lambda m: m.isNotNull())
    return whole.select("id", margins.alias("margins"))


def score_block_model(model, df, dictionary=None, id_col: str = "Id", features_col: str = "features"):
    """(id, prediction, predictionLabel) of a BinaryRelevanceModel of logistic
    regressions by one block matrix: the decisions of ``model.transform``,
    in a plan of the same size for any number of tags. ``dictionary``: table
    (tag, code) of the vocabulary; by default it is made of the model's.
    """
    spark = df.sparkSession
    weights, _, n_bytes = block_weights(spark, model)
    start = df.select(F.col(id_col).alias("id"), F.lit(-1).alias("i"), F.lit(1.0).alias("v"))
    margins = block_margins(sparse_entries(df, id_col, features_col).unionByName(start), weights, n_bytes)
    picked = F.filter(F.transform("margins", lambda m, k: F.when(m > 0, k.cast("double")).otherwise(-1.0)), lambda k: k >= 0)
    scored = written(margins.select("id", picked.alias("prediction")), "block-scored")
    if dictionary is None:
        dictionary = written(spark.createDataFrame(list(enumerate(model.vocabulary)), "code int, tag string"), "vocabulary")
    return decode_labels(scored, dictionary, id_col="id")


def score_by_block(model: PipelineModel, df: DataFrame, keep=("Id",), id_col: str = "Id") -> DataFrame:
    """As ``score``, for a pipeline that ends in linear members, by their block
    matrix: for many tags. Ids must be unique; the features are written."""
    br = model.stages[-1]
    features = PipelineModel(model.stages[:-1]).transform(df).select(*dict.fromkeys([*keep, id_col, br.getFeaturesCol()]))
    features = written(features, "block-features")
    tags = score_block_model(br, features, id_col=id_col, features_col=br.getFeaturesCol()).select(
        F.col("id").alias("__id"), F.col("predictionLabel").alias("tags"))
    scored = features.join(tags, features[id_col] == tags["__id"])
    return scored.select(*keep, "tags", reply_json("tags").alias("reply"))


def score_linear_model(model, df, id_col: str = "Id", features_col: str = "features",
                       threshold: float | None = None):
    """Score a BinaryRelevanceModel of logistic-regression members through
    :func:`linear_decisions` (same decisions as ``model.transform``)."""
    spark = df.sparkSession
    weights, bias, n = linear_weight_tables(spark, model)
    if threshold is not None:      # one threshold instead of each member's own
        bias = bias.drop("cut")
    entries = sparse_entries(df, id_col, features_col)
    dec = linear_decisions(entries, weights, bias, 0.5 if threshold is None else threshold, n * _BYTES_PER_WEIGHT_ROW,
                           ids=df.select(F.col(id_col).alias("id")))
    return decisions_to_arrays(dec, model.vocabulary)
