import math
import os
import re

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tagloom.operators.features import feature_stages
from tagloom.operators.labels import stable_split
from tagloom.operators.relevance import BinaryRelevance, BinaryRelevanceModel
from tagloom.plans.experiment import LANG_TAGS, training_posts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feats(spark):
    data = training_posts(spark, SF, LANG_TAGS + ["quality"])
    fm = Pipeline(stages=feature_stages("Body")).fit(data)
    df = fm.transform(data).select("Id", "label", "Title", "features").cache()
    df.count()
    yield df
    df.unpersist()


def _br(**kw):
    lr = LogisticRegression(maxIter=50, tol=1e-4, threshold=0.5)
    return BinaryRelevance(classifier=lr, stringPredictionCol="predictionLabel", parallelism=3, **kw)


@pytest.fixture(scope="module")
def fitted(feats):
    train, test = stable_split(feats, 0.8, 7)
    return _br().fit(train), train, test


def test_fit_transform_shape(fitted):
    model, _, test = fitted
    assert model.vocabulary == sorted(LANG_TAGS + ["quality"])
    out = model.transform(test)
    assert out.columns == test.columns + ["prediction", "predictionLabel"]
    assert out.schema["prediction"].dataType.simpleString() == "array<double>"
    assert out.schema["predictionLabel"].dataType.simpleString() == "array<string>"
    rows = out.collect()
    assert len(rows) == test.count()
    for r in rows:
        assert list(r["prediction"]) == sorted(r["prediction"])
        assert r["predictionLabel"] == [model.vocabulary[int(i)] for i in r["prediction"]]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_matches_separate_fits(fitted, spark):
    model, train, test = fitted
    out = {r["Id"]: list(r["prediction"]) for r in model.transform(test).collect()}
    expected = {i: [] for i in out}
    for i, tag in enumerate(model.vocabulary):
        t = train.withColumn("y", F.array_contains("label", tag).cast("double"))
        lr = LogisticRegression(maxIter=50, tol=1e-4, threshold=0.5, labelCol="y")
        for r in lr.fit(t).transform(test).select("Id", "prediction").collect():
            if r["prediction"] == 1.0:
                expected[r["Id"]].append(float(i))
    assert out == expected


def test_input_prediction_column_is_replaced(fitted):
    model, _, test = fitted
    pre = test.withColumn("prediction", F.lit(1))
    out = model.transform(pre)
    assert out.columns.count("prediction") == 1
    assert out.schema["prediction"].dataType.simpleString() == "array<double>"


def test_save_load_model_and_pipeline(fitted, feats, tmp_path):
    model, train, test = fitted
    p = str(tmp_path / "br")
    model.save(p)
    assert os.path.isdir(os.path.join(p, "model_0")) and os.path.isdir(os.path.join(p, "classifier"))
    back = BinaryRelevanceModel.load(p)
    assert back.vocabulary == model.vocabulary
    a = sorted(map(tuple, model.transform(test).select("Id", "prediction").collect()))
    b = sorted(map(tuple, back.transform(test).select("Id", "prediction").collect()))
    assert a == b
    # as a stage of a fitted pipeline
    data = training_posts(model and test.sparkSession, SF, LANG_TAGS)
    pm = Pipeline(stages=[*feature_stages("Body"), _br()]).fit(data)
    pp = str(tmp_path / "pm")
    pm.save(pp)
    back_pm = PipelineModel.load(pp)
    a = sorted(map(tuple, pm.transform(data).select("Id", "predictionLabel").collect()))
    b = sorted(map(tuple, back_pm.transform(data).select("Id", "predictionLabel").collect()))
    assert a == b


def test_save_load_estimator(tmp_path):
    br = _br(minSupport=2)
    p = str(tmp_path / "est")
    br.save(p)
    back = BinaryRelevance.load(p)
    assert back.getOrDefault(back.minSupport) == 2
    assert back.getStringPredictionCol() == "predictionLabel"
    assert back.getClassifier().getThreshold() == 0.5


def test_refuses_unwritable_classifier(tmp_path):
    br = BinaryRelevance(classifier=object())
    with pytest.raises(ValueError, match="not MLWritable"):
        br.save(str(tmp_path / "x"))


def test_copy_reaches_classifier():
    lr = LogisticRegression(threshold=0.5)
    br = BinaryRelevance(classifier=lr)
    c = br.copy({lr.threshold: 0.9, lr.maxIter: 7})
    assert c.getClassifier().getThreshold() == 0.9
    assert c.getClassifier().getMaxIter() == 7
    assert br.getClassifier().getThreshold() == 0.5


def test_grid_point_changes_members(feats):
    lr = LogisticRegression(maxIter=50, tol=1e-4, threshold=0.5)
    br = BinaryRelevance(classifier=lr)
    model = br.fit(feats, {lr.threshold: 0.9})
    assert all(m.getThreshold() == 0.9 for m in model.models)


def test_constant_target(spark, feats):
    # every row carries 'x': the member predicts the constant
    df = feats.withColumn("label", F.array_union("label", F.array(F.lit("x"))))
    model = _br(labels=["x"]).fit(df)
    preds = {tuple(r["prediction"]) for r in model.transform(df).collect()}
    assert preds == {(0.0,)}


def test_top_n_and_weight(feats):
    m = _br(topN=2).fit(feats)
    assert len(m.vocabulary) == 2
    w = feats.withColumn("w", F.lit(1.0))
    m2 = _br(weightCol="w", labels=["en"]).fit(w)
    assert m2.models[0].getWeightCol() == "w"


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_linear_sql_scorer_equals_chained(feats, threshold):
    from tagloom.operators.scoring import score_linear_model
    train, test = stable_split(feats, 0.8, 7)
    lr = LogisticRegression(maxIter=50, tol=1e-4, threshold=threshold)
    model = BinaryRelevance(classifier=lr).fit(train)
    chained = {r["Id"]: list(r["prediction"]) for r in model.transform(test).collect()}
    sql = {r["id"]: list(r["prediction"]) for r in score_linear_model(model, test).collect()}
    assert {k: v for k, v in chained.items() if v} == sql


def test_linear_scorer_keeps_each_members_threshold(feats):
    from tagloom.operators.scoring import score_linear_model
    model = _br().fit(feats)
    model.models[0].setThreshold(0.95)
    chained = {r["Id"]: list(r["prediction"]) for r in model.transform(feats).collect()}
    sql = {r["id"]: list(r["prediction"]) for r in score_linear_model(model, feats).collect()}
    assert {k: v for k, v in chained.items() if v} == sql


def test_sparse_entries_of_both_kinds(spark):
    from pyspark.ml.linalg import Vectors

    from tagloom.operators.scoring import sparse_entries
    rows = [(1, Vectors.sparse(2**18, {5: 1.0, 70000: 2.0})), (2, Vectors.dense([0.0, 3.0])), (3, Vectors.sparse(9, {})), (4, Vectors.dense([]))]
    got = sorted(tuple(r) for r in sparse_entries(spark.createDataFrame(rows, ["id", "f"]), "id", "f").collect())
    assert got == [(1, 5, 1.0), (1, 70000, 2.0), (2, 1, 3.0)]


def test_raw_scores_and_declared_schema(feats):
    br = _br(rawPredictionCol="raw")
    model = br.fit(feats)
    out = model.transform(feats)
    assert out.columns[-3:] == ["prediction", "predictionLabel", "raw"]
    declared = model.transformSchema(feats.schema)
    assert declared.simpleString() == out.schema.simpleString() == br.transformSchema(feats.schema).simpleString()
    for r in out.limit(30).collect():
        assert list(r["prediction"]) == [float(i) for i, x in enumerate(r["raw"]) if x > 0]


def test_asks_for_a_classifier(feats):
    with pytest.raises(ValueError, match="needs a classifier"):
        BinaryRelevance().fit(feats)


def test_cached_input_is_not_cached_again(spark, feats):
    from tagloom.operators.relevance import _reads_cache
    assert _reads_cache(feats) and _reads_cache(feats.select("features", "label").where("Id > 3"))
    assert not _reads_cache(spark.range(5))


def test_a_stopped_fit_goes_on(feats, tmp_path):
    """Stopped after some members, started again: fits the rest, and gives the
    model of an undisturbed fit."""
    fits = []

    class Stopping(LogisticRegression):
        def _fit(self, dataset):
            if len(fits) == 2:
                raise RuntimeError("executor lost")
            fits.append(1)
            return super()._fit(dataset)

    tags, journal = ["de", "en", "es", "fr"], str(tmp_path / "journal")
    with pytest.raises(Exception, match="executor lost"):
        BinaryRelevance(classifier=Stopping(maxIter=5), labels=tags, journal=journal).fit(feats)
    fits2 = []

    class Stopping(LogisticRegression):  # noqa: F811  (same name, so the same journal)
        def _fit(self, dataset):
            fits2.append(1)
            return super()._fit(dataset)

    model = BinaryRelevance(classifier=Stopping(maxIter=5), labels=tags, journal=journal).fit(feats)
    assert len(fits) + len(fits2) == 4 and len(fits2) == 2
    plain = BinaryRelevance(classifier=LogisticRegression(maxIter=5), labels=tags).fit(feats)
    assert [m.coefficients for m in model.models] == [m.coefficients for m in plain.models]
    # other params, other rows: nothing is taken over
    fits2.clear()
    BinaryRelevance(classifier=Stopping(maxIter=4), labels=tags, journal=journal).fit(feats)
    BinaryRelevance(classifier=Stopping(maxIter=5), labels=tags, journal=journal).fit(feats.where("Id % 2 = 0"))
    assert len(fits2) == 8


def test_half_written_member_is_fitted_again(feats, tmp_path):
    journal = tmp_path / "journal"
    br = BinaryRelevance(classifier=LogisticRegression(maxIter=2), labels=["de"], journal=str(journal))
    first = br.fit(feats)
    marks = list(journal.glob("*/*/_DONE"))
    assert len(marks) == 1
    marks[0].unlink()
    assert br.fit(feats).models[0].coefficients == first.models[0].coefficients and marks[0].exists()


def test_block_matrix_equals_chain(spark, feats):
    """500 members: same decisions as chained transforms, in a plan whose size
    does not depend on their number."""
    from tagloom.operators.scoring import score_block_model
    base = BinaryRelevance(classifier=LogisticRegression(maxIter=3), labels=["de", "en", "es", "fr"]).fit(feats)
    members = [m.copy({m.threshold: 0.02 + (k % 97) / 100}) for k in range(125) for m in base.models]
    model = BinaryRelevanceModel(labels=[f"t{k}" for k in range(500)], models=members)
    rows = feats.select("Id", "features").limit(60)
    rows = rows.unionByName(rows.limit(1).selectExpr("-1L AS Id", "features"))
    got = {r.id: (r.prediction, r.predictionLabel) for r in score_block_model(model, rows).collect()}
    # the chain, whose plan does grow, for the first members; the rule itself for all
    part = BinaryRelevanceModel(labels=model.vocabulary[:24], models=members[:24])
    chained = {r.Id: [int(x) for x in r.prediction] for r in part.transform(rows).collect()}
    assert {k: [int(x) for x in p if x < 24] for k, (p, _) in got.items()} == chained
    margins = {r.Id: r.raw for r in base.copy({base.rawPredictionCol: "raw"}).transform(rows).collect()}
    want = {k: [i for i, m in enumerate(members) if 1 / (1 + math.exp(-raw[i % 4])) > m.getThreshold()] for k, raw in margins.items()}
    assert {k: [int(x) for x in p] for k, (p, _) in got.items()} == want
    assert all(names == [f"t{int(x)}" for x in p] for p, names in got.values())


def test_block_plan_does_not_grow(spark, feats):
    from tagloom.operators.scoring import block_margins, block_weights, sparse_entries
    base = BinaryRelevance(classifier=LogisticRegression(maxIter=2), labels=["de", "en"]).fit(feats)
    sizes = []
    for k in (2, 200):
        model = BinaryRelevanceModel(labels=[f"t{i}" for i in range(k)], models=(base.models * k)[:k])
        weights, _, n_bytes = block_weights(spark, model)
        plan = block_margins(sparse_entries(feats, "Id", "features"), weights, n_bytes)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan))
    assert abs(sizes[0] - sizes[1]) < 100


def test_threads_do_not_share_job_properties(spark):
    """Each call has properties of its own: what one sets, no other sees."""
    import threading
    from tagloom.operators.relevance import in_threads
    sc, meet = spark.sparkContext, threading.Barrier(4)

    def work(i):
        sc.setLocalProperty("tagloom.test", str(i))
        meet.wait()
        return sc.getLocalProperty("tagloom.test")

    assert in_threads(spark, 4, work, 4) == ["0", "1", "2", "3"]
    assert in_threads(spark, 0, work) == []


def _entries_and_weights(spark):
    """70 tags, 40 features: feature f has weights for the tags that 1 + f % 3
    divides; the first feature is in every row, the last ones in few."""
    weights = [(k, f"f{f}", ((k * 7 + f * 13) % 17 - 8) / 4) for f in range(40) for k in range(70) if k % (1 + f % 3) == 0]
    entries = [(d, f"f{f}", 1.0 + d % 3) for d in range(60) for f in range(40) if (d * 31 + f * 17) % (f + 1) == 0]
    bias = [(k, (k % 5 - 2) / 2) for k in range(70)]
    return entries, weights, bias


@pytest.mark.parametrize("broadcast_max, weight_bytes", [(1 << 26, 24 * 3000), (1 << 26, None), (3000, None), (0, None)])
def test_decisions_by_blocks_of_tags(spark, monkeypatch, broadcast_max, weight_bytes):
    """Side-by-side sums decide as the rule does, whether all weights are
    broadcast, the most used features' only, or none; ids without entries get
    the tags that are on by default."""
    from tagloom.operators import scoring
    monkeypatch.setattr(scoring, "BROADCAST_WEIGHTS_MAX_BYTES", broadcast_max)
    entries, weights, bias = _entries_and_weights(spark)
    ids = [*range(60), 99]
    got = scoring.linear_decisions(
        spark.createDataFrame(entries, "id int, i string, v double"), spark.createDataFrame(weights, "label int, i string, w double"),
        spark.createDataFrame(bias, "label int, b double"), 0.5, weight_bytes, spark.createDataFrame([(i,) for i in ids], "id int"))
    margin = {(d, k): b for d in ids for k, b in bias}
    of = {}
    for k, f, w in weights:
        of.setdefault(f, []).append((k, w))
    for d, f, v in entries:
        for k, w in of[f]:
            margin[d, k] += v * w
    assert sorted((r.id, r.label) for r in got.collect()) == sorted(p for p, m in margin.items() if m > 0)


def test_sums_leave_a_task_once_per_document(spark):
    """One group per document, not one per (document, tag), and sums that need
    no sorting; a split of the weights shuffles only the rest's entries."""
    from tagloom.operators.scoring import block_margins, linear_decisions
    entries, weights, bias = _entries_and_weights(spark)
    e = spark.createDataFrame(entries, "id int, i string, v double")
    plan = linear_decisions(e, spark.createDataFrame(weights, "label int, i string, w double"),
                            spark.createDataFrame([(k, -1.0) for k, _ in bias], "label int, b double"), 0.5, 24 * 3000)
    text = plan._jdf.queryExecution().sparkPlan().toString()
    assert "keys=[id" in text and "block" in text and not re.search(r"keys=\[id#\d+L?, label", text)
    table = spark.createDataFrame([(i, [0.5] * 70) for i in range(-1, 40)], "i int, w array<double>")
    rows = spark.createDataFrame([(d, i, -1.0) for d in range(9) for i in range(-1, 5)], "id int, i int, v double")
    margins = block_margins(rows, table, 1)
    assert "aggregate_metrics" not in margins._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r.margins) for r in margins.collect()} == {(-3.0,) * 70}


def test_members_at_a_time_fit_in_memory(feats, monkeypatch):
    """Fits that run together share the storage memory: with room for
    three copies of the rows (which the caller keeps), three run at a time."""
    from tagloom.operators import relevance
    asked = []
    run = relevance.in_threads
    monkeypatch.setattr(relevance, "in_threads", lambda spark, n, work, threads=8: asked.append(threads) or run(spark, n, work, threads))
    for room, want in ((3.5, 3), (0.5, 1), (100, 4)):
        def sized(self, n=1000):
            return n
        monkeypatch.setattr(relevance._Projection, "size", sized)
        monkeypatch.setattr(relevance, "_storage_bytes", lambda spark, room=room: int(room * 1000 / relevance.FIT_SHARE))
        BinaryRelevance(classifier=LogisticRegression(maxIter=1), labels=["de", "en", "es", "fr"], parallelism=8).fit(feats)
        assert asked.pop() == want
    monkeypatch.undo()
    assert relevance._storage_bytes(feats.sparkSession) > 1 << 20


def test_fit_on_counts_is_the_pipelines_fit(spark):
    from tagloom.plans.experiment import base_classifier, fit_on_counts, tagging_pipeline
    data = training_posts(spark, "/root/testdata/sf0.001", LANG_TAGS)
    pipeline = tagging_pipeline("Body", base_classifier(max_iter=5), labels=["de", "en"])
    one, two = fit_on_counts(pipeline, data), pipeline.fit(data)
    assert [type(s) for s in one.stages] == [type(s) for s in two.stages]
    for a, b in zip(one.stages[-1].models, two.stages[-1].models):
        assert abs(a.coefficients.toArray() - b.coefficients.toArray()).max() < 1e-6


def _columns_joined(node):
    """Columns of the sides of all joins in a plan."""
    children = [node.children().apply(i) for i in range(node.children().size())]
    found = {c.split("#")[0] for child in children for c in child.output().mkString(",").split(",")} if node.nodeName() == "Join" else set()
    return found.union(*[_columns_joined(child) for child in children])


def test_linear_score_joins_counts_not_texts(spark, tmp_path, monkeypatch):
    """Posts meet their flags with term counts: no text is moved for it, also
    where the flags are too large to be broadcast. Documents and flags repeat."""
    from tagloom import session
    from tagloom.plans import queries
    docs = [(d % 57, f"{'der und die' if d % 2 else 'the and of'} word{d % 7} word{d % 3}", "de" if d % 2 else "en", f"s{d % 3}", 20) for d in range(60)]
    flags = [(d % 40, d % 4 // 3, d % 5 // 4) for d in range(45)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(flags, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    joined, write = [], session.written_path

    def watched(df, name):
        joined.append(_columns_joined(df._jdf.queryExecution().optimizedPlan()))
        return write(df, name)

    monkeypatch.setattr(session, "written_path", watched)
    monkeypatch.setattr(queries, "_classifier", lambda: LogisticRegression(threshold=0.5, maxIter=3, regParam=0.05))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        posts = queries._tagged_posts(spark, str(tmp_path))
        df = queries.QUERIES["br_linear_score"](spark, str(tmp_path))
        joined.append(_columns_joined(df._jdf.queryExecution().optimizedPlan()))
        assert any("quality" in columns for columns in joined)
        assert not any(columns & {"text", "_Body", "Body", "TitleSplitted", "TitleStop"} for columns in joined)
        assert posts.columns == ["Id", "label", "Title", "Body"]
        assert df.first().n_given == posts.agg(F.sum(F.size("label"))).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _repeated_tables(spark, folder):
    """Documents and flags that repeat."""
    docs = [(d % 57, f"{'der und die' if d % 2 else 'the and of'} word{d % 7} word{d % 3}", "de" if d % 2 else "en", f"s{d % 3}", 20) for d in range(60)]
    flags = [(d % 40, d % 4 // 3, d % 5 // 4) for d in range(45)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(flags, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


@pytest.fixture
def joined(spark, monkeypatch):
    """Columns of the joins of every table written, with no broadcast."""
    from tagloom import session
    seen, write = [], session.written_path

    def watched(df, name):
        seen.append(_columns_joined(df._jdf.queryExecution().optimizedPlan()))
        return write(df, name)

    monkeypatch.setattr(session, "written_path", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield seen
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


TEXTS = {"text", "_Body", "Body", "TitleSplitted", "TitleStop"}


def test_fit_predict_splits_texts_once_and_bounds_the_separate_fits(spark, tmp_path, monkeypatch, joined):
    """Posts meet their flags with term counts, once; the members fitted apart
    are as many at a time as memory holds."""
    from tagloom.operators import relevance
    from tagloom.plans import queries
    _repeated_tables(spark, tmp_path)
    asked, run = [], relevance.in_threads
    monkeypatch.setattr(relevance, "in_threads", lambda spark, n, work, threads=8: asked.append(threads) or run(spark, n, work, threads))
    monkeypatch.setattr(relevance, "_storage_bytes", lambda spark: 1)
    monkeypatch.setattr(queries, "_classifier", lambda: LogisticRegression(threshold=0.5, maxIter=3, regParam=0.05))
    posts = queries._tagged_posts(spark, str(tmp_path))
    rows = queries.QUERIES["br_fit_predict"](spark, str(tmp_path)).collect()
    assert sum("quality" in columns for columns in joined) == 1
    assert not any(columns & TEXTS for columns in joined)
    assert asked == [1, 1]
    given = {r.tag for r in posts.select(F.explode("label").alias("tag")).distinct().collect()}
    assert {r.tag for r in rows} == given and {(r.n_rows, r.n_mismatch) for r in rows} == {(posts.count(), 0)}


def test_separate_fits_read_few_partitions(spark):
    """Small rows in many partitions cost more tasks than work; large ones stay."""
    from tagloom.operators.relevance import FIT_BYTES, few_parts
    rows = spark.range(0, 100, 1, 20)
    assert few_parts(rows, 10, 4).rdd.getNumPartitions() == 1
    assert few_parts(rows, 10, 1).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert few_parts(rows, FIT_BYTES * 9, 4).rdd.getNumPartitions() == 9
    assert few_parts(rows, FIT_BYTES * 99, 4) is rows
