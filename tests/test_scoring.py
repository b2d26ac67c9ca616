import os
import json

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tagloom.operators.features import feature_stages
from tagloom.operators.scoring import (REASON_NO_BODY, REASON_NO_TITLE, reply_json, score_table,
                                       split_requests)
from tagloom.plans.experiment import LANG_TAGS, base_classifier, tagging_pipeline, training_posts
from tagloom.streaming.score_stream import read_request_stream, start_scoring

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def saved_model(spark, tmp_path_factory):
    data = training_posts(spark, SF, LANG_TAGS)
    model = tagging_pipeline("Title", base_classifier(threshold=0.5, tol=0.1)).fit(data)
    path = str(tmp_path_factory.mktemp("m") / "model")
    model.save(path)
    return path, data


def test_request_validation(spark):
    df = spark.createDataFrame([(1, "t", "b"), (2, "", "b"), (3, "  ", "b"), (4, None, "b"), (5, "t", None),
                                (6, "t", ""), (7, "\t\x01 ", "b"), (8, "\u00a0", "b")], "Id long, Title string, Body string")
    valid, rejects = split_requests(df)
    assert sorted(r["Id"] for r in valid.collect()) == [1, 6, 8]
    reasons = {r["Id"]: r["reason"] for r in rejects.collect()}
    assert reasons == {2: REASON_NO_TITLE, 3: REASON_NO_TITLE, 4: REASON_NO_TITLE, 5: REASON_NO_BODY,
                       7: REASON_NO_TITLE}


def test_reply_json(spark):
    df = spark.createDataFrame([(["python", "c#"],), ([],)], "t array<string>")
    got = [json.loads(r["j"]) for r in df.select(reply_json("t").alias("j")).collect()]
    assert got == [{"tags": ["python", "c#"]}, {"tags": []}]


def test_score_table(spark, saved_model, tmp_path):
    path, data = saved_model
    req = data.select("Id", "Title", "Body").unionByName(
        spark.createDataFrame([(-1, "", "x")], "Id long, Title string, Body string"))
    out, rej = str(tmp_path / "out"), str(tmp_path / "rej")
    score_table(path, req, out, rej)
    scored = spark.read.parquet(out)
    assert scored.count() == data.count()
    assert [r["Id"] for r in spark.read.parquet(rej).collect()] == [-1]
    r = scored.first()
    assert json.loads(r["reply"]) == {"tags": list(r["tags"])}


def test_score_table_by_block(spark, saved_model, tmp_path):
    path, data = saved_model
    req = data.select("Id", "Title", "Body").unionByName(
        spark.createDataFrame([(-1, "", "x"), (-2, "zzz", "no known word")], "Id long, Title string, Body string"))
    outs = [str(tmp_path / n) for n in ("chain", "block")]
    score_table(path, req, outs[0])
    score_table(path, req, outs[1], block=True)
    chain, block = ({r.Id: (list(r.tags), r.reply) for r in spark.read.parquet(o).collect()} for o in outs)
    assert chain == block and len(chain) == data.count() + 1


def test_stream_equals_batch(spark, saved_model, tmp_path):
    path, data = saved_model
    model = PipelineModel.load(path)
    src = str(tmp_path / "src")
    data.select("Id", "Title", "Body").repartition(4).write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = start_scoring(read_request_stream(spark, src, schema, max_files_per_trigger=1), model,
                      str(tmp_path / "sout"), str(tmp_path / "ck"))
    q.awaitTermination()
    streamed = {r["Id"]: list(r["tags"]) for r in spark.read.parquet(str(tmp_path / "sout")).collect()}
    batch = {r["Id"]: list(r["predictionLabel"]) for r in model.transform(data).collect()}
    assert streamed == batch


def test_pipeline_persists_with_features(spark, saved_model):
    path, data = saved_model
    m = PipelineModel.load(path)
    assert [type(s).__name__ for s in m.stages][-1] == "BinaryRelevanceModel"
    assert isinstance(Pipeline(stages=feature_stages()).getStages()[0].getInputCol(), str)
    assert F is not None


def test_experiment_cli(spark, tmp_path, capsys):
    from tagloom.operators.etl import questions_from_posts
    from tagloom.plans.experiment import main
    from tagloom.sources.fixtures import posts_fixture
    from tagloom.sources.questions import save_questions
    assert main([]) == 2
    path = str(tmp_path / "q")
    save_questions(questions_from_posts(posts_fixture(spark, SF)), path)
    assert main([path, "en", "de", "fr", "es"]) == 0
    out = capsys.readouterr().out
    assert "hammingLoss" in out and "threshold" in out


LINES = ['{"Id":1,"Title":"t","Body":"b"}', '{"Id":2,"Title":"","Body":"b"}', '{"Id":3,"Title":"t"}', '{"Id":4,"Title":"t","Body":null}',
         '{"Id":5,"Title":7,"Body":"b"}', '{"Id":6,"Title":"t","Body":["b"]}', '{"Id":7,"Title":"t","Body":"b"', "", "nonsense", '["Title"]',
         '{"Id":"x","Title":"t","Body":"b"}', '{"Title":"no id","Body":"é \\u00e9","More":{"a":1}}', ' {"Id":9,"Title":"t","Body":"b"}']


def test_malformed_json_requests(spark):
    from tagloom.operators.scoring import REASON_NO_JSON, REASON_WRONG_TYPE, json_request_status, parse_requests
    df = spark.createDataFrame([(x,) for x in LINES] + [(None,)], "value string")
    rows = parse_requests(df).withColumn("reason", json_request_status()).collect()
    by_text = {r.text: r for r in rows}
    assert len(rows) == len(LINES) + 1
    want = [None, REASON_NO_TITLE, REASON_NO_BODY, REASON_NO_BODY, REASON_WRONG_TYPE, REASON_WRONG_TYPE, REASON_NO_JSON, REASON_NO_JSON, REASON_NO_JSON,
            REASON_NO_JSON, REASON_NO_JSON, None, None]
    assert [by_text[x].reason for x in LINES] == want
    assert by_text[None].reason == REASON_NO_JSON
    assert (by_text[LINES[0]].Id, by_text[LINES[0]].Title, by_text[LINES[0]].Body) == (1, "t", "b")
    assert (by_text[LINES[11]].Id, by_text[LINES[11]].Body) == (None, "é é")


def test_two_tables_and_a_replayed_batch(spark, saved_model, tmp_path):
    """JSON requests into tags and rejects; a batch that is replayed after a
    failure changes neither table."""
    import glob

    from tagloom.operators.scoring import parse_requests
    from tagloom.streaming.score_stream import read_json_stream, scored_tables, start_scoring_tables
    path, data = saved_model
    model = PipelineModel.load(path)
    src, out, ck = (str(tmp_path / n) for n in ("json", "out", "ck"))
    good = data.select("Id", "Title", "Body").where("Title <> ''").select(F.to_json(F.struct("*")).alias("value"))
    good.unionByName(spark.createDataFrame([(x,) for x in LINES], "value string")).repartition(3).write.text(src)

    def run():
        start_scoring_tables(read_json_stream(spark, src, 1), model, out, ck).awaitTermination()
        tags, rejects = scored_tables(spark, out)
        return sorted(map(repr, tags.collect())), sorted(map(repr, rejects.collect()))

    first = run()
    assert len(first[0]) == good.count() + 3 and len(first[1]) == len(LINES) - 3
    batch = model.transform(parse_requests(good).drop("text", "malformed"))
    want = {r.Id: list(r.predictionLabel) for r in batch.collect()}
    tags = scored_tables(spark, out)[0].collect()
    assert {r.Id: list(r.tags) for r in tags if r.Id in want and r.Id not in (1, 9)} == {k: v for k, v in want.items() if k not in (1, 9)}
    commits = sorted(glob.glob(ck + "/commits/[0-9]*"), key=lambda x: int(x.rsplit("/", 1)[1]))
    last = commits[-1].rsplit("/", 1)       # as if the last batch had failed after its write
    for name in (last[1], f".{last[1]}.crc"):
        if os.path.exists(f"{last[0]}/{name}"):
            os.remove(f"{last[0]}/{name}")
    assert run() == first
    assert len(glob.glob(ck + "/commits/[0-9]*")) == len(commits)


def test_stream_query_joins_texts_once_and_batches_follow_the_cores(spark, tmp_path, monkeypatch):
    """The fit, the stream and batch scoring read posts that met their flags
    once; many waiting files are taken a core's share at a time, not two.
    Documents and flags repeat."""
    from pyspark.ml.classification import LogisticRegression

    from tagloom.plans import queries
    from tagloom.streaming import score_stream
    docs = [(d, f"{'der und die' if d % 2 else 'the and of'} word{d % 7} word{d % 3}", "de" if d % 2 else "en", f"s{d % 3}", 20)
            for d in (n % 57 for n in range(96))]
    flags = [(d % 40, d % 4 // 3, d % 5 // 4) for d in range(45)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").repartition(16).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(flags, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    calls, taken = [], []
    prepared, read = queries._model_data, score_stream.read_request_stream
    monkeypatch.setattr(queries, "_model_data", lambda *a: calls.append(1) or prepared(*a))
    monkeypatch.setattr(queries, "_classifier", lambda: LogisticRegression(threshold=0.5, maxIter=3, regParam=0.05))
    monkeypatch.setattr(score_stream, "read_request_stream", lambda *a, max_files_per_trigger: taken.append(max_files_per_trigger) or read(
        *a, max_files_per_trigger=max_files_per_trigger))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        posts = queries._tagged_posts(spark, str(tmp_path))
        n_posts, given = posts.count(), posts.agg(F.sum(F.size("label"))).first()[0]
        df = queries.QUERIES["stream_score"](spark, str(tmp_path))
        assert "doc_id" not in df._jdf.queryExecution().optimizedPlan().toString()
        row = df.first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(calls) == 1 and taken == [spark.sparkContext.defaultParallelism]
    assert (row.n_mismatch, row.n_given) == (0, given) and row.n_rows >= n_posts
    assert [score_stream.files_per_batch(spark, n) for n in (1, 8, 12, 1000)] == [2, 2, 3, spark.sparkContext.defaultParallelism]
