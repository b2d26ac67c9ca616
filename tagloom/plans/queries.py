"""The registered queries: one per operator group, each over whole tables.

Every query reads the driver tables (through the ``posts`` fixture) and
returns a lazy DataFrame with scalar, named columns so it can be compared with
the DuckDB statement of the same name in ``tagloom.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.tags import split_tags
from tagloom.functions.text import remove_stop_words, tokenize
from tagloom.operators.etl import questions_from_posts
from tagloom.session import scratch_path, side_session, written
from tagloom.sources.fixtures import posts_fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def questions(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return questions_from_posts(posts_fixture(spark, sf_dir, spread))


def _date_text(col: str):
    return F.date_format(F.col(col), "yyyy-MM-dd").alias(col)


@register
def q_questions_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump rows -> typed question table (filter, try-casts, dates, tag split)."""
    q = questions(spark, sf_dir)
    return q.select(
        F.col("Id").cast("bigint").alias("Id"),
        _date_text("CreationDate"), _date_text("LastActivityDate"),
        F.col("Year").cast("bigint").alias("Year"), F.col("Month").cast("bigint").alias("Month"),
        F.col("Score").cast("bigint").alias("Score"), F.col("ViewCount").cast("bigint").alias("ViewCount"),
        "OwnerDisplayName", "Title", "Body",
        F.array_join("label", "|").alias("tags"))


# ---------------------------------------------------------------- labels ----

# Tags kept by the tag-filter query (a parameter of the operator).
FILTER_TAGS = ["en", "de", "toxic"]


@register
def q_tag_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (post, position, tag) of the split tag text."""
    q = questions(spark, sf_dir)
    return q.select(F.col("Id").cast("bigint").alias("Id"),
                    F.posexplode("label").alias("pos", "tag")) \
            .withColumn("pos", F.col("pos").cast("bigint"))


@register
def q_tag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag sets reduced to FILTER_TAGS; posts left with none are dropped."""
    from tagloom.operators.labels import filter_tags
    q = filter_tags(questions(spark, sf_dir).select("Id", "label"), FILTER_TAGS)
    return q.select(F.col("Id").cast("bigint").alias("Id"), F.array_join("label", "|").alias("tags"),
                    F.size("label").cast("bigint").alias("n_tags"))


@register
def q_label_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary-relevance targets (the columns the fits use) of every post over
    the sorted tag vocabulary, as one text of 0 and 1."""
    from tagloom.operators.labels import label_vocabulary, with_targets
    q = questions(spark, sf_dir).select("Id", "label")
    vocab = label_vocabulary(q)
    t = with_targets(q, vocab)
    bits = [F.col(f"target_{i}").cast("int").cast("string") for i in range(len(vocab))]
    return t.select(F.col("Id").cast("bigint").alias("Id"), F.concat(*bits).alias("targets"))


@register
def q_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.operators.labels import label_counts
    return label_counts(questions(spark, sf_dir).select("label")) \
        .withColumn("n", F.col("n").cast("bigint"))


@register
def q_top_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most frequent tags of all posts, named by a sketch and counted
    exactly."""
    from tagloom.operators.labels import top_labels
    return top_labels(_tagged_posts(spark, sf_dir).select("label"), 5)


@register
def q_label_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.operators.labels import label_cardinality
    return label_cardinality(questions(spark, sf_dir).select("Id", "label"))


@register
def q_stable_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train/test side of every post (deterministic, 80/20, seed 7)."""
    from tagloom.operators.labels import split_column
    q = questions(spark, sf_dir)
    return q.select(F.col("Id").cast("bigint").alias("Id"),
                    split_column("Id", 0.8, 7, method="arith").alias("side"))


@register
def q_hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default (hash) split: every post on one side, about four fifths on
    the training side."""
    from tagloom.operators.labels import stable_split
    q = questions(spark, sf_dir).select("Id")
    train, test = stable_split(q, 0.8, 7)
    both = train.withColumn("t", F.lit(1)).unionByName(test.withColumn("t", F.lit(0)))
    per = both.groupBy("Id").agg(F.count(F.lit(1)).alias("sides"), F.max("t").alias("t"))
    return per.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("sides") != 1, 1).otherwise(0)).alias("n_twice"),
                   (F.abs(F.avg("t") - 0.8) < 0.06).alias("near_ratio"))


@register
def q_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``randomSplit`` of every post: each on one side, about four fifths on
    the training side."""
    from tagloom.plans.experiment import random_split
    posts = written(_tagged_posts(spark, sf_dir).select("Id"), "split-ids")
    train, test = random_split(posts, 0.8, 7)
    both = train.withColumn("t", F.lit(1)).unionByName(test.withColumn("t", F.lit(0)))
    per = both.groupBy("Id").agg(F.count(F.lit(1)).alias("sides"), F.max("t").alias("t"))
    return per.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("sides") != 1, 1).otherwise(0)).alias("n_twice"),
                   (F.abs(F.avg("t") - 0.8) < 0.09).alias("near_ratio"))


# ------------------------------------------------------------------ text ----

def _tagged_posts(spark, sf_dir, prepare=None):
    """Every post, questions and answers, with id, tags, title and whole text
    (the body holds the complete document), and the columns that ``prepare``
    adds to the documents."""
    posts = posts_fixture(spark, sf_dir, spread=True, prepare=prepare)
    return posts.select(
        F.col("_Id").cast("bigint").alias("Id"), split_tags("_Tags").alias("label"), F.col("_Title").alias("Title"), F.col("_Body").alias("Body"),
        *[c for c in posts.columns if not c.startswith("_")])


def _post_text(spark, sf_dir):
    return _tagged_posts(spark, sf_dir).select("Id", F.col("Body").alias("text"))


@register
def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenizer stage over whole texts: one row per (post, position, token)."""
    from tagloom.operators.features import text_tokenizer
    t = text_tokenizer("text", "toks").transform(_post_text(spark, sf_dir))
    return t.select("Id", F.posexplode("toks").alias("pos", "token")) \
            .withColumn("pos", F.col("pos").cast("bigint"))


@register
def q_tokens_nostop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenizer + StopWordsRemover stages: tokens left after stop words."""
    from tagloom.operators.features import stop_words_remover, text_tokenizer
    t = text_tokenizer("text", "toks").transform(_post_text(spark, sf_dir))
    t = stop_words_remover("toks", "kept").transform(t)
    return t.select("Id", F.posexplode("kept").alias("pos", "token")) \
            .withColumn("pos", F.col("pos").cast("bigint"))


@register
def q_doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, df): documents containing each non-stop term."""
    from tagloom.operators.features import document_frequencies
    return document_frequencies(_post_text(spark, sf_dir), "Id", "text")


@register
def q_tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-term TF-IDF with minimum document frequency 2."""
    from tagloom.operators.features import exact_tfidf
    w = exact_tfidf(_post_text(spark, sf_dir), "Id", "text", min_doc_freq=2)
    return w.select(F.col("id").alias("Id"), "term", F.col("tf").cast("bigint").alias("tf"),
                    F.col("df").cast("bigint").alias("df"),
                    "idf", "tfidf")


@register
def q_hashing_tf_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HashingTF invariant: the vector's total mass equals the token count."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    from tagloom.operators.features import hashing_tf, stop_words_remover, text_tokenizer
    stages = [text_tokenizer("text", "toks"), stop_words_remover("toks", "kept"),
              hashing_tf(1000, "kept", "tf")]
    t = Pipeline(stages=stages).fit(_post_text(spark, sf_dir)).transform(_post_text(spark, sf_dir))
    mass = F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, x: a + x)
    return t.select("Id", F.size("kept").cast("bigint").alias("n_tokens"),
                    mass.cast("bigint").alias("mass"))


@register
def q_idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HashingTF and IDF stages over whole texts: document frequency and weight
    of every bucket, as learned."""
    from pyspark.ml import Pipeline
    from tagloom.operators.features import feature_stages
    stage = Pipeline(stages=feature_stages("text")).fit(_post_text(spark, sf_dir)).stages[-1]
    learned = [(i, int(d), float(w)) for i, (d, w) in enumerate(zip(stage.docFreq, stage.idf.toArray()))]
    return spark.createDataFrame(learned, "i int, df bigint, idf double")


@register
def q_legacy_hash_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets of the older word hash: posts and occurrences in each."""
    from tagloom.operators.features import legacy_term_frequencies
    t = _post_text(spark, sf_dir).select("Id", remove_stop_words(tokenize("text")).alias("toks"))
    return legacy_term_frequencies(t, "Id", "toks").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf"))


# --------------------------------------------------------------- metrics ----

def _pseudo_predictions(spark, sf_dir):
    """(Id, Year, prediction, label) index arrays from a fixed rule.

    The rule (drop 'toxic', add 'quality' when the text is longer than 2000
    characters, possibly twice) gives right, wrong, missing and repeated
    predictions; both arrays are coded to indexes of the sorted vocabulary.
    """
    from tagloom.functions.tags import label_indexes
    from tagloom.operators.labels import label_vocabulary
    q = questions(spark, sf_dir).select("Id", "Year", "Score", "label")
    vocab = label_vocabulary(q)
    pred = F.concat(F.filter("label", lambda t: t != "toxic"),
                    F.when(F.col("Score") > 2000, F.array(F.lit("quality")))
                     .otherwise(F.array().cast("array<string>")))
    return q.select("Id", "Year", label_indexes(pred, vocab).alias("prediction"),
                    label_indexes("label", vocab).alias("label")), vocab


_ROW_METRICS = ["precision", "recall", "f1", "accuracy", "hammingLoss", "subsetAccuracy"]


@register
def q_metrics_rowwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.operators.metrics import rowwise_metrics
    pl, _ = _pseudo_predictions(spark, sf_dir)
    return rowwise_metrics(pl)


@register
def q_metrics_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.operators.metrics import rowwise_metrics
    pl, _ = _pseudo_predictions(spark, sf_dir)
    return rowwise_metrics(pl, group_cols=["Year"]).withColumn("Year", F.col("Year").cast("bigint"))


@register
def q_metrics_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All row-wise metrics (exact-match rate among them) per true tag-set size."""
    from tagloom.operators.metrics import rowwise_metrics
    pl, _ = _pseudo_predictions(spark, sf_dir)
    pl = pl.withColumn("n_true", F.size("label").cast("bigint"))
    return rowwise_metrics(pl, group_cols=["n_true"])


@register
def q_metrics_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.operators.metrics import micro_metrics
    pl, _ = _pseudo_predictions(spark, sf_dir)
    return micro_metrics(pl)


@register
def q_metrics_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.functions.tags import decode_indexes
    from tagloom.operators.metrics import by_label_metrics
    pl, vocab = _pseudo_predictions(spark, sf_dir)
    m = by_label_metrics(pl)
    return m.select(decode_indexes(F.array("label"), vocab)[0].alias("tag"), "tp", "fp", "fn",
                    "precision", "recall", "f1")


@register
def q_evaluator_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric of the Evaluator and whether larger is better."""
    from tagloom.operators.metrics import MultilabelEvaluator
    pl, _ = _pseudo_predictions(spark, sf_dir)
    ev = MultilabelEvaluator(predictionCol="prediction", labelCol="label")
    found = ev.getMetrics(pl)
    rows = [(name, found[name], ev.setMetricName(name).isLargerBetter()) for name in _ROW_METRICS + ["microPrecision", "microRecall", "microF1"]]
    return spark.createDataFrame(rows, "metric string, value double, larger_is_better boolean")


@register
def q_metrics_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric measured while the predictions are written: no second job
    reads them. Tags are compared as text."""
    from tagloom.functions.tags import decode_indexes
    from tagloom.operators.metrics import ObservedMetrics
    pl, vocab = _pseudo_predictions(side_session(spark), sf_dir)
    tags = pl.select("Id", decode_indexes("prediction", vocab).alias("predictionLabel"), decode_indexes("label", vocab).alias("label"))
    watch = ObservedMetrics(vocab)
    written(watch.watch(tags), "observed")
    found = watch.get()
    rows = [(m, float(found[m])) for m in [*_ROW_METRICS, "microPrecision", "microRecall", "microF1", "n", "n_labels"]]
    return spark.createDataFrame(rows, "metric string, value double")


# ------------------------------------------------------- sources / sinks ----

_XML_COLS = ["_Id", "_PostTypeId", "_CreationDate", "_Score", "_ViewCount", "_Body",
             "_OwnerDisplayName", "_LastActivityDate", "_Title", "_Tags"]


def _written_posts_xml(spark, sf_dir, max_records=None):
    from tagloom.sources.xml import write_posts_xml
    path = scratch_path(spark, "posts-xml")
    write_posts_xml(posts_fixture(spark, sf_dir), path, max_records_per_file=max_records)
    return path


@register
def q_xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts written as an XML dump and read back, each file as one document,
    with the all-text schema."""
    from tagloom.sources.xml import read_posts_document
    return read_posts_document(spark, _written_posts_xml(spark, sf_dir)).select(*_XML_COLS)


def _spoiled_dump(spark, sf_dir):
    """The dump with damaged rows: a bare ampersand (Id ending in 3), a row cut
    over two lines (4), a row without Id (6), and a child element (7)."""
    lines = spark.read.text(_written_posts_xml(spark, sf_dir))
    at = F.regexp_extract("value", r'<row Id="\d*(\d)"', 1)
    v = F.col("value")
    spoiled = (F.when(at == "3", F.replace(v, F.lit("<row "), F.lit('<row Note="a & b" ')))
               .when(at == "4", F.replace(v, F.lit(" PostTypeId="), F.lit("\n PostTypeId=")))
               .when(at == "6", F.regexp_replace(v, r'<row Id="\d+"', "<row"))
               .when(at == "7", F.regexp_replace(v, "/>$", "><tag>x</tag></row>"))
               .otherwise(v))
    path = scratch_path(spark, "spoiled-xml")
    lines.select(spoiled.alias("value")).write.text(path)
    return path


@register
def q_xml_linewise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole rows of a partly damaged dump, read line by line."""
    from tagloom.sources.xml import read_posts_xml
    return read_posts_xml(spark, _spoiled_dump(spark, sf_dir)).select(*_XML_COLS)


@register
def q_xml_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the damaged dump that are no whole row, per reason."""
    from tagloom.sources.xml import xml_rejects
    return xml_rejects(spark, _spoiled_dump(spark, sf_dir)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _multiline_dump(spark, sf_dir):
    """The dump with every attribute on a line of its own, and with damaged
    rows: a bare ampersand (Id ending in 3), a row that never ends (4), a row
    without Id (6), and a child element over lines (7)."""
    lines = spark.read.text(_written_posts_xml(spark, sf_dir))
    at = F.regexp_extract("value", r'<row Id="\d*(\d)"', 1)
    v = F.col("value")
    spoiled = (F.when(at == "3", F.replace(v, F.lit("<row "), F.lit('<row Note="a & b" ')))
               .when(at == "4", F.regexp_replace(v, "/>$", ""))
               .when(at == "6", F.regexp_replace(v, r'<row Id="\d+"', "<row"))
               .when(at == "7", F.regexp_replace(v, "/>$", ">\n<tag>x</tag>\n</row>"))
               .otherwise(v))
    path = scratch_path(spark, "multiline-xml")
    lines.select(F.regexp_replace(spoiled, r'" (\w+=")', '"\n    $1').alias("value")).write.text(path)
    return path


@register
def q_xml_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole rows of a partly damaged dump whose elements span lines, cut
    at row tags and read in parallel."""
    from tagloom.sources.xml import read_posts_xml
    return read_posts_xml(spark, _multiline_dump(spark, sf_dir), line_wise=False).select(*_XML_COLS)


@register
def q_xml_multiline_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of the damaged multi-line dump that are no whole row."""
    from tagloom.sources.xml import xml_rejects
    return xml_rejects(spark, _multiline_dump(spark, sf_dir), line_wise=False).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@register
def q_xml_rechunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump re-chunked into files of at most 250 rows, read back."""
    from tagloom.sources.xml import read_posts_xml
    return read_posts_xml(spark, _written_posts_xml(spark, sf_dir, 250)).select(*_XML_COLS)


@register
def q_questions_parquet_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question table saved partitioned by Year/Month; 2019 read back by
    partition pruning, three columns projected."""
    from tagloom.sources.questions import load_questions, save_questions
    path = scratch_path(spark, "questions")
    save_questions(questions(spark, sf_dir), path)
    q = load_questions(spark, path, columns=("Id", "Month", "label", "Title"), year=2019)
    return q.select(F.col("Id").cast("bigint").alias("Id"), F.col("Month").cast("bigint").alias("Month"),
                    "Title", F.array_join("label", "|").alias("tags"))


# --------------------------------------------------------------- scoring ----

@register
def q_decode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag arrays coded to indexes and back by a dictionary table, which holds
    every tag: no tag is in the plan."""
    from tagloom.operators.labels import decode_labels, encode_labels, tag_dictionary
    q = questions(spark, sf_dir).select("Id", "Score", "label")
    words = tag_dictionary(q)
    pred = F.concat(F.filter("label", lambda t: t != "toxic"),
                    F.when(F.col("Score") > 2000, F.array(F.lit("quality"))).otherwise(F.array().cast("array<string>")))
    coded = encode_labels(q.select("Id", pred.alias("tags")), words, "tags", "indexes", id_col="Id")
    names = decode_labels(written(coded, "coded"), words, "indexes", "names", id_col="Id")
    return names.select(F.col("Id").cast("bigint").alias("Id"), F.array_join("names", "|").alias("tags"))


@register
def q_score_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON reply {"tags": [...]} of each scored post."""
    from tagloom.functions.tags import decode_indexes
    from tagloom.operators.scoring import reply_json
    pl, vocab = _pseudo_predictions(spark, sf_dir)
    return pl.select(F.col("Id").cast("bigint").alias("Id"),
                     decode_indexes("prediction", vocab).alias("t")) \
             .select("Id", reply_json("t").alias("reply"))


def _requests(spark, sf_dir):
    """Every post as a scoring request; some come without a title (NULL,
    empty, one tab) or without a body."""
    p = posts_fixture(spark, sf_dir)
    k = F.col("_Id").cast("bigint") % 20
    title = F.when(k == 7, F.lit("")).when(k == 8, F.lit("\t")).when(k != 9, F.col("_Title"))
    return p.select(F.col("_Id").cast("bigint").alias("Id"), title.alias("Title"),
                    F.when(k != 10, F.col("_Body")).alias("Body"))


@register
def q_request_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request: accepted, or rejected with a reason."""
    from tagloom.operators.scoring import request_status
    st = request_status()
    return _requests(spark, sf_dir).select(
        "Id", F.when(st.isNull(), F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"), st.alias("reason"))


def _json_requests(spark, sf_dir):
    """Every post as a line of JSON; some are cut off (3), no object (11), or
    have a number for a title (4), no body (6), a list for a body (12)."""
    r = _requests(spark, sf_dir)
    k = F.col("Id") % 20
    line = F.to_json(F.struct("Id", F.when(~k.isin(4), F.col("Title")).alias("Title"), F.when(~k.isin(6, 12), F.col("Body")).alias("Body")))
    line = (F.when(k == 3, F.expr("substring(line, 1, length(line) - 1)")).when(k == 11, F.concat(F.lit("["), F.col("line"), F.lit("]")))
            .when(k == 4, F.concat(F.lit('{"Title":7,'), F.substring("line", 2, 1 << 30)))
            .when(k == 12, F.concat(F.lit('{"Body":["x"],'), F.substring("line", 2, 1 << 30))).otherwise(F.col("line"))).alias("value"), line
    return r.select("Id", line[1].alias("line")).select(line[0])


@register
def q_json_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as JSON texts, some malformed: each accepted, or rejected with
    a reason and its text."""
    from tagloom.operators.scoring import json_request_status, parse_requests
    p = parse_requests(_json_requests(spark, sf_dir)).withColumn("reason", json_request_status())
    return p.select("Id", "reason", F.col("text").isNotNull().alias("has_text"))


# ------------------------------------------------------------- models ----

_SPLIT_SEED = 7
LANGUAGES = ["de", "en", "es", "fr"]
# Tags of the end-to-end experiment (its tag filter).
EXPERIMENT_TAGS = [*LANGUAGES, "quality", "toxic"]


def _model_data(spark, sf_dir, prepare=None):
    """(train, all): the training side of the split, and every post (each
    carrying its ``side``) with its whole tag set. Models are fitted on the
    training side; every post is scored."""
    from tagloom.operators.labels import split_column
    q = _tagged_posts(spark, sf_dir, prepare)
    q = q.withColumn("side", split_column("Id", 0.8, _SPLIT_SEED, method="arith"))
    return q.where(F.col("side") == "train"), q


def _counted_data(spark, sf_dir, counter, counts_col):
    """As ``_model_data``, without texts: with the term counts that the stages
    of ``counter`` make of them. Texts are split once, before the posts meet
    their flags: the join moves counts, not texts."""
    return _model_data(spark, sf_dir, lambda docs: counter.transform(docs.withColumn("Body", F.col("text"))).select(*docs.columns, counts_col))


def _classifier():
    """Member of the model queries; regularised, as texts have more terms than
    most tags have posts."""
    from pyspark.ml.classification import LogisticRegression
    return LogisticRegression(threshold=0.5, maxIter=100, tol=0.01, regParam=0.05)


def fitted_model(spark, sf_dir, train=None):
    """Tagging pipeline of every tag, fitted on the training side (``train``:
    its posts, where they are written already)."""
    from tagloom.plans.experiment import fit_on_counts, tagging_pipeline
    if train is None:
        train, _ = _model_data(spark, sf_dir)
    return fit_on_counts(tagging_pipeline("Body", _classifier(), parallelism=8), train)


@register
def q_br_fit_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary relevance against one separately fitted logistic regression per
    tag: per tag the posts, the training posts that have it, those where the
    two disagree, and whether a language tag is ever predicted."""
    from pyspark.ml import PipelineModel
    from tagloom.functions.tags import target_column
    from tagloom.operators.relevance import IO_THREADS, BinaryRelevanceModel, few_parts, fits_at_once, in_threads, vector_bytes
    from tagloom.plans.experiment import fit_counted, tagging_pipeline, term_counter
    pipeline = tagging_pipeline("Body", _classifier(), parallelism=8)
    counts_col = pipeline.getStages()[-2].getInputCol()
    _, posts = _counted_data(spark, sf_dir, term_counter(pipeline), counts_col)
    posts = written(posts.select("Id", "label", "side", counts_col), "term-counts")
    model = fit_counted(pipeline, posts.where(F.col("side") == "train"))
    br = model.stages[-1]
    scored = written(PipelineModel(model.stages[-2:]).transform(posts).select("Id", "label", "side", "features", "prediction"), "scored")
    fit_rows = scored.where(F.col("side") == "train").select("features", "label").persist()
    n_bytes = vector_bytes(fit_rows, "features")
    threads = fits_at_once(spark, n_bytes, IO_THREADS, kept=True)
    few = few_parts(fit_rows, n_bytes, threads)

    def one(i: int):
        return _classifier().setLabelCol("y").fit(few.select("features", target_column("label", br.vocabulary[i]).alias("y")))

    apart = in_threads(spark, len(br.vocabulary), one, threads)
    fit_rows.unpersist()
    both = BinaryRelevanceModel(labels=br.vocabulary, models=apart).setPredictionCol("own").transform(scored)
    code = F.col("i").cast("double")
    names = spark.createDataFrame(list(enumerate(br.vocabulary)), "i int, tag string")
    per = both.select("label", "side", "prediction", "own", F.explode(F.sequence(F.lit(0), F.lit(len(apart) - 1))).alias("i")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.array_contains("prediction", code) != F.array_contains("own", code), 1).otherwise(0)).alias("n_mismatch"),
        (F.sum(F.when(F.array_contains("prediction", code), 1).otherwise(0)) > 0).alias("predicted"))
    trained = scored.where(F.col("side") == "train").select(F.explode(F.array_distinct("label")).alias("tag")).groupBy("tag").agg(
        F.count(F.lit(1)).alias("n_train"))
    return written(per.join(names, "i").join(trained, "tag").select(
        "tag", "n_rows", "n_train", "n_mismatch", F.when(F.col("tag").isin(LANGUAGES), F.col("predicted")).alias("predicted")), "br-fit")


@register
def q_br_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-wise multi-label metrics on the training and the held-out side: what
    SQL can tell of them, and that the model beats predicting nothing (whose
    Hamming loss is the mean share of tags set) where it was fitted."""
    from tagloom.operators.metrics import rowwise_metrics
    _, posts = _model_data(spark, sf_dir)
    scored = written(fitted_model(spark, sf_dir).transform(posts).select("side", "label", "predictionLabel"), "scored")
    m = rowwise_metrics(scored, "predictionLabel", "label", group_cols=["side"])
    tags = scored.groupBy("side").agg(F.sum(F.size("label")).alias("tags"))
    nothing = F.col("tags") / (F.col("n") * F.col("n_labels"))
    within = [F.col(c).between(0.0, 1.0) for c in ("precision", "recall", "f1", "accuracy", "subsetAccuracy")]
    return m.join(tags, "side").select(
        "side", "n", "n_labels", nothing.alias("nothing_loss"),
        F.when(F.col("side") == "train", F.col("hammingLoss") < nothing).alias("beats_nothing"),
        (within[0] & within[1] & within[2] & within[3] & within[4]).alias("within_bounds"))


def _mismatches(a: DataFrame, b: DataFrame, posts: DataFrame) -> DataFrame:
    """(n_rows, n_mismatch, most_tagged) of two (Id, tags) tables joined on Id,
    and the tags that the posts were given."""
    given = posts.agg(F.sum(F.size("label")).alias("n_given"))
    j = a.alias("a").join(b.alias("b"), F.col("a.Id") == F.col("b.Id"), "full_outer")
    differs = ~F.col("a.tags").eqNullSafe(F.col("b.tags")) | F.col("a.Id").isNull() | F.col("b.Id").isNull()
    return j.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.sum(F.when(differs, 1).otherwise(0)).cast("bigint").alias("n_mismatch"),
                 (F.sum(F.when(F.col("a.tags") != "", 1).otherwise(0)) * 2 > F.count(F.lit(1))).alias("most_tagged")).join(given)


def _tags(scored: DataFrame) -> DataFrame:
    return scored.select("Id", F.array_join("predictionLabel", "|").alias("tags"))


@register
def q_br_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted pipeline saved and reloaded: predictions must not change, and
    most posts must have some."""
    from pyspark.ml import PipelineModel
    _, posts = _model_data(spark, sf_dir)
    model = fitted_model(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    return _mismatches(_tags(model.transform(posts)), _tags(PipelineModel.load(path).transform(posts)), posts)


@register
def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every post streamed through the fitted pipeline equals batch scoring."""
    from tagloom.streaming.score_stream import files_per_batch, read_request_stream, start_scoring
    _, posts = _model_data(spark, sf_dir)
    src, out, ck = (scratch_path(spark, n) for n in ("requests", "scored", "ckpt"))
    # texts meet their flags once: the fit, the stream and batch scoring read what is written
    posts.select("Id", "Title", "Body", "label", "side").write.parquet(src)
    posts = spark.read.parquet(src)
    model = fitted_model(spark, sf_dir, posts.where(F.col("side") == "train"))
    requests = read_request_stream(spark, src, posts.select("Id", "Title", "Body").schema,
                                   max_files_per_trigger=files_per_batch(spark, len(posts.inputFiles())))
    q = start_scoring(requests, model, out, ck)
    q.awaitTermination()
    streamed = spark.read.parquet(out).select("Id", F.array_join("tags", "|").alias("tags"))
    return _mismatches(streamed, _tags(model.transform(posts)), posts)


@register
def q_stream_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON requests streamed into a table of tags and one of rejects: each
    request's outcome, and whether its tags are those of batch scoring."""
    from tagloom.operators.scoring import parse_requests
    from tagloom.plans.experiment import tagging_pipeline
    from tagloom.streaming.score_stream import read_json_stream, scored_tables, start_scoring_tables
    train, _ = _model_data(spark, sf_dir)
    model = tagging_pipeline("Body", _classifier(), parallelism=4, labels=LANGUAGES).fit(train)
    src, out, ck = (scratch_path(spark, n) for n in ("json", "streamed", "ckpt"))
    _json_requests(spark, sf_dir).write.text(src)
    start_scoring_tables(read_json_stream(spark, src, 2), model, out, ck).awaitTermination()
    tags, rejects = scored_tables(spark, out)
    asked = parse_requests(spark.read.text(src)).where("malformed is null").withColumn("Body", F.coalesce("Body", F.lit("")))
    batch = model.transform(asked).select("Id", F.col("predictionLabel").alias("want"))
    good = tags.join(batch, "Id", "left").select("Id", F.lit(None).cast("string").alias("reason"), F.col("tags").eqNullSafe(F.col("want")).alias("as_batch"))
    return good.unionByName(rejects.select("Id", "reason", F.lit(True).alias("as_batch")))


@register
def q_table_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scoring from a saved pipeline: each request in one of the two
    tables written, scored ones with a JSON reply."""
    from tagloom.operators.scoring import score_table
    path, tags, rejects = (scratch_path(spark, n) for n in ("model", "tags", "rejects"))
    fitted_model(spark, sf_dir).write().overwrite().save(path)
    score_table(path, _requests(spark, sf_dir), tags, rejects)
    good = spark.read.parquet(tags).select("Id", F.lit(None).cast("string").alias("reason"),
                                           F.get_json_object("reply", "$.tags").isNotNull().alias("replied"))
    bad = spark.read.parquet(rejects).select("Id", "reason", F.lit(False).alias("replied"))
    return good.unionByName(bad)


def _tuning_features(spark, sf_dir, method="arith"):
    from pyspark.ml import PipelineModel
    from tagloom.operators.features import feature_stages
    from tagloom.operators.tuning import features_for_tuning
    *plain, idf = feature_stages("Body")
    train, _ = _counted_data(spark, sf_dir, PipelineModel(plain), idf.getInputCol())
    counts = written(train.select("Id", "label", idf.getInputCol()), "term-counts")
    return features_for_tuning(counts, [idf], 0.8, 11, method=method)


@register
def q_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 6-point grid (maxIter 100 x tol {0.01, 0.1} x threshold {0.5, 0.65,
    0.8}) evaluated with 2 fits per tag instead of 6, and its Hamming loss
    counted again, member by member, from their probabilities."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    from tagloom.operators.labels import split_column
    from tagloom.operators.relevance import BinaryRelevance
    from tagloom.operators.tuning import reference_grid, threshold_sweep
    lr = LogisticRegression(regParam=0.05)
    br = BinaryRelevance(classifier=lr, parallelism=8)
    feats = written(_tuning_features(spark, sf_dir), "tuning-features")
    fitted: dict = {}       # params -> model
    sweep = threshold_sweep(br, feats, reference_grid(lr), 0.8, 11, method="arith", fitted=fitted)
    side = split_column("Id", 0.8, 11, "arith")
    again = None
    for params_text, model in fitted.items():
        probs = feats.where(side == "test").withColumn("set", F.lit(0))
        wrong = [F.lit(0)]
        for i, m in enumerate(model.models):
            params = model.member_params(i, f"p{i}")
            params[m.probabilityCol] = f"q{i}"
            probs = m.transform(probs, params).drop(f"p{i}")
            own = F.coalesce(F.array_contains("label", model.vocabulary[i]), F.lit(False))
            wrong.append(F.when((vector_to_array(F.col(f"q{i}"))[1] > F.col("t")) != own, 1).otherwise(0))
        unknown = F.size(F.array_except("label", F.array(*[F.lit(v) for v in model.vocabulary])))
        counted = probs.withColumn("t", F.explode(F.array(*[F.lit(t) for t in (0.5, 0.65, 0.8)]))).groupBy("t").agg(
            F.sum(sum(wrong[1:], wrong[0]) + unknown).alias("wrong"))
        counted = counted.select(F.lit(params_text).alias("params"), F.col("t").alias("threshold"), "wrong")
        again = counted if again is None else again.unionByName(counted)
    n_labels = F.col("n_labels")
    return sweep.join(again, ["params", "threshold"]).select(
        "params", "threshold", "n", "n_labels",
        (F.abs(F.col("hammingLoss") - F.col("wrong") / (F.col("n") * n_labels)) < 1e-9).alias("same_loss"))


@register
def q_tvs_best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TrainValidationSplit over the binary-relevance stage (features fitted
    once), Hamming loss: grid points, whether the winner's params are those of
    the least loss, and whether every loss is a share."""
    from pyspark.ml.classification import LogisticRegression
    from tagloom.operators.relevance import BinaryRelevance
    from tagloom.operators.tuning import reference_grid, tag_evaluator, train_validation
    lr = LogisticRegression(regParam=0.05)
    br = BinaryRelevance(classifier=lr, parallelism=8, stringPredictionCol="predictionLabel")
    grid = reference_grid(lr)
    feats = written(_tuning_features(spark, sf_dir), "tuning-features")
    tvs = train_validation(br, grid, tag_evaluator("hammingLoss"), seed=11, parallelism=2).fit(feats)
    losses = list(tvs.validationMetrics)
    best = grid[losses.index(min(losses))]
    member = tvs.bestModel.models[0]
    right = all(member.getOrDefault(p.name) == v for p, v in best.items())
    return feats.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(losses)).cast("bigint").alias("n_grid"), F.lit(right).alias("winner_has_least_loss"),
        F.lit(all(0 < x < 1 for x in losses)).alias("losses_are_shares"))


@register
def q_experiment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end-to-end experiment: question table on storage -> tag filter ->
    split -> threshold-sweep tuning -> refit -> held-out metrics: test rows,
    the loss of predicting nothing, whether the model beats it, and whether
    the chosen params are grid points (one row)."""
    from tagloom.plans.experiment import run_experiment
    from tagloom.sources.questions import save_questions
    path = scratch_path(spark, "questions")
    save_questions(questions(spark, sf_dir), path)
    _, predictions, metrics, _ = run_experiment(spark, path, tags=EXPERIMENT_TAGS, text_col="Body", parallelism=6,
                                                split="arith")
    tags = predictions.agg(F.sum(F.size("label")).alias("tags"))
    nothing = F.col("tags") / (F.col("n") * F.col("n_labels"))
    return metrics.join(F.broadcast(tags)).select(
        "n", "n_labels", nothing.alias("nothing_loss"), (F.col("hammingLoss") < nothing).alias("beats_nothing"),
        (F.col("tol").isin(0.01, 0.1) & F.col("threshold").isin(0.5, 0.65, 0.8) & (F.col("maxIter") == 100)).alias("on_grid"))


def _persistence_promises(spark, data, lr, model) -> dict:
    """Promises of saving, loading, refusing and resuming."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.util import MLWritable
    from tagloom.operators.metrics import MultilabelEvaluator
    from tagloom.operators.relevance import BinaryRelevance, BinaryRelevanceModel
    places = [scratch_path(spark, n) for n in ("estimator", "evaluator", "refused", "journal")]
    est = BinaryRelevance(classifier=lr, topN=3, minSupport=2, stringPredictionCol="names")
    est.write().overwrite().save(places[0])
    back = BinaryRelevance.load(places[0])
    ev = MultilabelEvaluator(metricName="hammingLoss", labelCol="l", emptyAs="zero")
    ev.write().overwrite().save(places[1])
    ev2 = MultilabelEvaluator.load(places[1])

    class Bare:     # a member that cannot be written
        pass

    try:
        BinaryRelevanceModel(labels=["x"], models=[Bare()]).write().save(places[2])
        refused = False
    except ValueError:
        refused = True
    fits = []

    class Counted(LogisticRegression):
        def _fit(self, dataset):
            fits.append(1)
            return super()._fit(dataset)

    resumable = BinaryRelevance(classifier=Counted(maxIter=2), labels=["de", "en"], journal=places[3])
    first, before = resumable.fit(data), len(fits)
    again = BinaryRelevance(classifier=Counted(maxIter=2), labels=["de", "en", "fr"], journal=places[3]).fit(data)
    plain = model.transform(data)
    return {
        "estimator loads as saved": (back.getClassifier().getMaxIter(), back.getOrDefault(back.topN), back.getStringPredictionCol()) == (
            lr.getMaxIter(), 3, "names"),
        "evaluator loads as saved": (ev2.getMetricName(), ev2.getLabelCol(), ev2.isLargerBetter()) == ("hammingLoss", "l", False),
        "refuses what cannot be written": refused and isinstance(model, MLWritable),
        "no columns but the declared": plain.columns == [*data.columns, "prediction", "names", "raw"],
        "a frame the caller keeps stays kept": _stays_kept(data, lr),
        "a restarted fit fits what is left": (before, len(fits)) == (2, 3) and all(
            a.coefficients == b.coefficients for a, b in zip(first.models, again.models)),
    }


def _stays_kept(data, lr) -> bool:
    from pyspark import StorageLevel
    from tagloom.operators.relevance import BinaryRelevance
    kept = data.persist()
    BinaryRelevance(classifier=lr, labels=["en"]).fit(kept)
    stays = kept.storageLevel != StorageLevel.NONE
    kept.unpersist()
    return stays and kept.storageLevel == StorageLevel.NONE


@register
def q_br_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimator's contract on the post table, one row per promise: params
    reach the members, vocabulary options, raw scores, declared schemas,
    weights, and refusals."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LinearSVC, LogisticRegression
    from tagloom.operators.features import feature_stages
    from tagloom.operators.labels import label_counts
    from tagloom.operators.relevance import BinaryRelevance
    train, posts = _model_data(spark, sf_dir)
    features = Pipeline(stages=feature_stages("Body")).fit(train)
    data = written(features.transform(posts).select("Id", "label", "features", F.lit(2.0).alias("w")), "features")
    lr = LogisticRegression(maxIter=5)
    br = BinaryRelevance(classifier=lr, topN=3, parallelism=3, stringPredictionCol="names", rawPredictionCol="raw", weightCol="w")
    tuned = br.copy({lr.threshold: 0.7, lr.maxIter: 3})
    model = tuned.fit(data)
    out = model.transform(data)
    top = [r["label"] for r in label_counts(data).orderBy(F.col("n").desc(), "label").limit(3).collect()]
    checks = _persistence_promises(spark, data, lr, model) | {
        "copy reaches the base learner": tuned.getClassifier().getThreshold() == 0.7 and lr.getMaxIter() == 5,
        "members have the params": all(m.getThreshold() == 0.7 for m in model.models),
        "top tags in order": model.vocabulary == sorted(top),
        "declared schema": model.transformSchema(data.schema).simpleString() == out.schema.simpleString()
                           == tuned.transformSchema(data.schema).simpleString(),
        "raw scores tell the predictions": out.where(F.exists(F.transform("raw", lambda r, i: (
            (1 / (1 + F.exp(-r)) > 0.7) != F.array_contains("prediction", i.cast("double")))), lambda x: x)).isEmpty(),
        "names of the indexes": out.where(F.size("names") != F.size("prediction")).isEmpty(),
        "any classifier": len(BinaryRelevance(classifier=LinearSVC(maxIter=2), labels=["en", "de"]).fit(data).models) == 2,
    }
    for name, wrong in (("refuses a missing column", data.drop("features")), ("refuses labels that are no arrays", data.withColumn("label", F.lit("x")))):
        try:
            br.fit(wrong)
            checks[name] = False
        except (ValueError, TypeError):
            checks[name] = True
    try:
        BinaryRelevance().fit(data)
        checks["asks for a classifier"] = False
    except ValueError:
        checks["asks for a classifier"] = True
    rows = spark.createDataFrame(sorted(checks.items()), "promise string, kept boolean")
    return rows.join(F.broadcast(data.agg(F.count(F.lit(1)).alias("n_rows"))))


@register
def q_linear_score_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear multi-label scoring as SQL (join + grouped sum + compare).

    Coefficients come from a fixed rule over the data: for tag L and term t,
    w = ln((a+1)/(n_L+2)) - ln((b+1)/(n_other+2)) with a / b the posts with /
    without L containing t, bias = ln(n_L / n_other), +inf where every post
    has L; a post gets L when bias + sum of w over its distinct terms >
    logit(0.5). Output: the positive (Id, tag) pairs over all posts.
    """
    from tagloom.operators.features import distinct_terms, document_frequencies, join_by_term, label_term_counts, terms
    from tagloom.operators.labels import label_vocabulary
    from tagloom.operators.scoring import linear_decisions
    # posts meet their flags and texts are split once, not in every pass
    q = written(_tagged_posts(spark, sf_dir).select("Id", F.array_distinct("label").alias("label"), distinct_terms("Body").alias("terms")), "post-terms")
    vocab = label_vocabulary(q)
    codes = spark.createDataFrame(list(enumerate(vocab)), "label int, tag string")
    a = label_term_counts(q, vocab)
    dfreq = written(document_frequencies(q, "Id", "terms"), "doc-freq")
    n_docs = q.count()
    stats = q.select(F.explode("label").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n_l"))
    stats = written(stats.withColumn("n_o", F.lit(n_docs) - F.col("n_l")).join(codes, "tag"), "tag-stats")
    w = join_by_term(written(a, "tag-terms"), dfreq, dfreq.count()).join(stats, "label").select(
        "label", F.col("term").alias("i"), F.col("df").alias("n"),
        (F.log((F.col("a") + 1.0) / (F.col("n_l") + 2.0))
         - F.log((F.col("df") - F.col("a") + 1.0) / (F.col("n_o") + 2.0))).alias("w"))
    w = written(w, "weights")
    odds = F.try_divide(F.col("n_l"), F.col("n_o"))
    bias = stats.select("label", F.coalesce(F.log(odds), F.lit(float("inf"))).alias("b"))
    entries = terms(q, "Id", "terms").select("id", F.col("term").alias("i"), F.lit(1.0).alias("v"))
    n_bytes = w.agg(F.sum(F.octet_length("i") + 48)).first()[0]      # term, numbers, row overhead
    dec = linear_decisions(entries, w, bias, 0.5, n_bytes, ids=q.select(F.col("Id").alias("id")))
    names = F.array(*[F.lit(t) for t in vocab])
    return dec.select(F.col("id").cast("bigint").alias("Id"),
                      F.element_at(names, F.col("label") + 1).alias("tag"))


@register
def q_br_linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted model's logistic-regression members scored in SQL form (one
    join on the feature index, one grouped sum, one comparison), by (document,
    tag) and by the block matrix of all tags: both must equal the chained
    member transforms on every post."""
    from pyspark.ml import PipelineModel
    from tagloom.operators.scoring import score_block_model, score_linear_model
    from tagloom.plans.experiment import fit_counted, tagging_pipeline, term_counter
    pipeline = tagging_pipeline("Body", _classifier(), parallelism=8)
    counts_col = pipeline.getStages()[-2].getInputCol()
    _, posts = _counted_data(spark, sf_dir, term_counter(pipeline), counts_col)
    posts = written(posts.select("Id", "label", "side", counts_col), "term-counts")
    model = fit_counted(pipeline, posts.where(F.col("side") == "train"))
    scored = PipelineModel(model.stages[-2:]).transform(posts)
    feats = written(scored.select("Id", "features", "predictionLabel"), "scored")
    sql = score_linear_model(model.stages[-1], feats)
    b = feats.select("Id").join(sql.select(F.col("id").alias("Id"), "predictionLabel"), "Id", "left") \
             .select("Id", F.array_join(F.coalesce("predictionLabel", F.array().cast("array<string>")), "|")
                     .alias("tags"))
    block = _tags(score_block_model(model.stages[-1], feats).withColumnRenamed("id", "Id"))
    by_block = _mismatches(_tags(feats), block, posts).select(F.col("n_mismatch").alias("n_block_mismatch"))
    return _mismatches(_tags(feats), b, posts).join(by_block)
