"""End-to-end jobs: the tagging pipeline, the experiment, the flagship query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, SparkSession

from tagloom.operators.etl import questions_from_posts
from tagloom.operators.features import feature_stages
from tagloom.operators.labels import filter_tags, stable_split
from tagloom.operators.relevance import BinaryRelevance
from tagloom.session import side_session, written, written_path
from tagloom.sources.fixtures import posts_fixture

# Fixed values of the reference experiment: 1000 hash buckets, IDF minimum
# document frequency 2, logistic regression members with threshold 0.8.
NUM_FEATURES = 1000
MIN_DOC_FREQ = 2
THRESHOLD = 0.8
# Columns of the feature stages that scored tables leave out.
FEATURE_COLUMNS = ["TitleSplitted", "TitleStop", "TFOut", "features"]


def base_classifier(threshold: float = THRESHOLD, max_iter: int = 100, tol: float = 1e-6):
    return LogisticRegression(threshold=threshold, maxIter=max_iter, tol=tol)


def tagging_pipeline(text_col: str = "Title", classifier=None, num_features: int = NUM_FEATURES,
                     min_doc_freq: int = MIN_DOC_FREQ, parallelism: int = 4,
                     string_prediction_col: str = "predictionLabel", **br_params) -> Pipeline:
    """Tokenizer -> stop words -> HashingTF -> IDF -> BinaryRelevance."""
    br = BinaryRelevance(classifier=classifier or base_classifier(), labelCol="label",
                         featuresCol="features", predictionCol="prediction",
                         stringPredictionCol=string_prediction_col, parallelism=parallelism,
                         **br_params)
    return Pipeline(stages=[*feature_stages(text_col, num_features, min_doc_freq), br])


def fit_on_counts(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """``pipeline.fit(train)`` of a ``tagging_pipeline``, its texts split once:
    the term counts are written, the IDF and the members are fitted on them."""
    *_, idf, br = pipeline.getStages()
    counts = term_counter(pipeline).transform(train).select(br.getLabelCol(), idf.getInputCol())
    return fit_counted(pipeline, written(counts, "term-counts"))


def term_counter(pipeline: Pipeline) -> PipelineModel:
    """The stages of a ``tagging_pipeline`` that learn nothing: text -> term
    counts."""
    return PipelineModel(pipeline.getStages()[:-2])


def fit_counted(pipeline: Pipeline, counts: DataFrame) -> PipelineModel:
    """``pipeline.fit`` of a ``tagging_pipeline`` on its texts' term counts."""
    *plain, idf, br = pipeline.getStages()
    scale = idf.fit(counts)
    return PipelineModel([*plain, scale, br.fit(scale.transform(counts))])


def training_posts(spark: SparkSession, sf_dir: str, tags: Sequence[str] | None = None) -> DataFrame:
    """Questions of the posts fixture: Id, label, Title, Body (optionally
    reduced to ``tags``)."""
    q = questions_from_posts(posts_fixture(spark, sf_dir, spread=True)).select("Id", "label", "Title", "Body")
    return filter_tags(q, tags) if tags else q


# Fixed value: the language tags of the fixture, used by the flagship.
LANG_TAGS = ["de", "en", "es", "fr"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the tagging pipeline on the language tags (training side: 80% of
    the posts, whole texts) and tag every post: (Id, label, predictionLabel)."""
    data = training_posts(spark, sf_dir, LANG_TAGS)
    train, _ = stable_split(data, 0.8, seed=7)
    model = tagging_pipeline("Body", base_classifier(tol=0.1)).fit(train)
    return model.transform(data).select("Id", "label", "predictionLabel")


def random_split(df: DataFrame, ratio: float = 0.8, seed: int | None = None):
    """``randomSplit`` into (train, test); use ``stable_split`` when the split
    must not depend on partitioning."""
    train, test = df.randomSplit([ratio, 1.0 - ratio], seed)
    return train, test


def run_experiment(spark: SparkSession, questions_path: str | None = None, *, data: DataFrame | None = None,
                   tags: Sequence[str] | None = None, text_col: str = "Title", train_ratio: float = 0.8,
                   seed: int = 7, grid_tol=(0.01, 0.1), grid_threshold=(0.5, 0.65, 0.8), max_iter: int = 100,
                   tuning: str = "sweep", parallelism: int = 4, split: str = "hash"):
    """Train, tune and evaluate a tagging model end to end.

    Reads the question table (``questions_path``, only Id/label/text columns)
    or takes ``data``; keeps ``tags``; splits train/test by id; tunes the
    member logistic regressions on a validation part of train by Hamming loss
    (``tuning='sweep'``: one fit per tol, thresholds swept; ``'tvs'``:
    TrainValidationSplit over every grid point); refits the whole pipeline on
    all of train with the chosen params; scores test.

    The features of the tuning step are fitted once, on its fitting rows.

    Returns ``(model, predictions, metrics, micro)``: the fitted
    PipelineModel, the scored test rows, a one-row DataFrame of the row-wise
    metrics with the chosen params, and a one-row DataFrame of the micro
    metrics.
    """
    from tagloom.operators.metrics import ObservedMetrics
    from tagloom.operators.tuning import (best_of_sweep, features_for_tuning, reference_grid, tag_evaluator,
                                          threshold_sweep, train_validation)
    from tagloom.sources.questions import load_questions

    if data is not None:
        questions_path = None
    elif questions_path is None:
        raise ValueError("give questions_path or data")
    else:
        data = load_questions(spark, questions_path, columns=("Id", "label", text_col))
    if tags:
        data = filter_tags(data, tags)
    train, test = stable_split(data, train_ratio, seed, method=split)
    # features are computed once for all grid points, and kept
    feats = features_for_tuning(train, feature_stages(text_col), train_ratio, seed + 1, method=split).persist(
        StorageLevel.MEMORY_AND_DISK)
    lr = LogisticRegression()
    br = BinaryRelevance(classifier=lr, parallelism=parallelism, stringPredictionCol="predictionLabel")
    grid = reference_grid(lr, (max_iter,), grid_tol, grid_threshold)
    try:
        if tuning == "sweep":
            best = best_of_sweep(threshold_sweep(br, feats, grid, train_ratio, seed + 1, method=split))
            chosen = dict(x.split("=") for x in best["params"].split(", "))
            params = {"maxIter": int(chosen["maxIter"]), "tol": float(chosen["tol"]),
                      "threshold": float(best["threshold"])}
        elif tuning == "tvs":
            tvs = train_validation(br, grid, tag_evaluator("hammingLoss"), train_ratio, seed + 1).fit(feats)
            i = min(range(len(grid)), key=lambda j: tvs.validationMetrics[j])
            params = {p.name: v for p, v in grid[i].items()}
        else:
            raise ValueError("tuning must be 'sweep' or 'tvs'")
    finally:
        feats.unpersist()
    clf = base_classifier(threshold=params["threshold"], max_iter=params["maxIter"], tol=params["tol"])
    model = tagging_pipeline(text_col, clf, parallelism=parallelism).fit(train)
    # scored, written and measured in one job, in a session of its own
    side = side_session(spark)
    if questions_path is None:
        test = side.read.parquet(written_path(test, "held-out"))
    else:
        rows = load_questions(side, questions_path, columns=("Id", "label", text_col))
        test = stable_split(filter_tags(rows, tags) if tags else rows, train_ratio, seed, method=split)[1]
    watch = ObservedMetrics(model.stages[-1].vocabulary)
    path = written_path(watch.watch(model.transform(test).drop(*FEATURE_COLUMNS)), "predictions")
    predictions = spark.read.parquet(path)
    found = watch.get()
    micro_names = ("tp", "fp", "fn", "microPrecision", "microRecall", "microF1")
    row = {k: v for k, v in found.items() if k not in micro_names}
    metrics = spark.createDataFrame([{**row, **params}])
    micro = spark.createDataFrame([{k: found[k] for k in micro_names}])
    return model, predictions, metrics, micro


def main(argv: list[str] | None = None) -> int:
    """``python -m tagloom.plans.experiment QUESTIONS_PATH [TAG ...]``

    Trains and evaluates on a saved question table and prints the chosen
    parameters and the held-out metrics (Hamming loss, f1, precision, recall).
    """
    import sys

    from tagloom.session import get_session
    args = list(sys.argv[1:] if argv is None else argv)
    if not args:
        print("usage: python -m tagloom.plans.experiment QUESTIONS_PATH [TAG ...]", file=sys.stderr)
        return 2
    spark = get_session()
    _, _, metrics, micro = run_experiment(spark, args[0], tags=args[1:] or None)
    row = metrics.first().asDict()
    row.update(micro.first().asDict())
    for key in ("maxIter", "tol", "threshold", "hammingLoss", "f1", "precision", "recall", "accuracy",
                "subsetAccuracy", "microPrecision", "microRecall", "microF1"):
        print(f"{key:16s} {row[key]}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
