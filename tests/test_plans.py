"""Plan properties that matter at scale: pruning, pushdown, no Python UDFs."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
PLAN_ONLY = ["questions_etl", "tag_split", "tag_filter", "label_counts", "label_cardinality",
             "stable_split", "tokens", "tokens_nostop", "doc_freq", "tfidf_terms", "hashing_tf_mass",
             "metrics_rowwise", "metrics_by_year", "metrics_micro", "metrics_by_label", "decode_labels",
             "score_json", "request_rejects", "label_targets", "xml_rejects"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_ONLY)
def test_no_python_udf(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in plan, (name, marker)


def test_tag_queries_do_not_read_text(spark):
    plan = _plan(E.queries()["tag_split"](spark, SF))
    docs = [line for line in plan.split("\n") if "documents.parquet" in line]
    assert docs and all("text:string" not in line for line in docs)


def test_filters_pushed_into_scan(spark):
    plan = _plan(E.queries()["stable_split"](spark, SF))
    assert "PushedFilters: [IsNotNull(doc_id)]" in plan


def test_partition_pruning(spark):
    plan = _plan(E.queries()["questions_parquet_year"](spark, SF))
    assert "PartitionFilters: [isnotnull(Year" in plan and "(Year#" in plan
    assert "ReadSchema: struct<Id:bigint,Title:string,label:array<string>>" in plan


def test_spread_thin_input_only_when_needed(spark):
    from tagloom.session import spread_thin_input
    cores = spark.sparkContext.defaultParallelism
    wide = spark.range(0, 1000, numPartitions=cores * 2)
    assert spread_thin_input(wide, "id") is wide                    # no shuffle added
    thin = spark.range(0, 1000, numPartitions=1)
    spread = spread_thin_input(thin, "id")
    assert spread.rdd.getNumPartitions() == cores
    assert "Exchange hashpartitioning(id" in _plan(spread)


def test_checkpoint_folder_comes_from_session(spark):
    from tagloom.session import ensure_checkpoint_dir, scratch_path
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/tagloom-scratch/x-")


def test_cluster_without_shared_folder_is_refused(spark):
    from types import SimpleNamespace

    from tagloom.session import ensure_checkpoint_dir

    def session(master):
        sc = SimpleNamespace(getCheckpointDir=lambda: None, master=master, setCheckpointDir=lambda d: None,
                             getConf=lambda: SimpleNamespace(get=lambda *a: None))
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://x"):
        with pytest.raises(ValueError, match="shared folder"):
            ensure_checkpoint_dir(session(master))
    assert ensure_checkpoint_dir(session("local[4]"))


def test_document_frequency_takes_one_exchange(spark):
    from tagloom.operators.features import document_frequencies, term_frequencies
    rows = spark.createDataFrame([(1, "a b a c"), (2, "a")], "id long, t string")
    assert _plan(document_frequencies(rows, "id", "t", False)).count("Exchange hashpartitioning") == 1
    assert "Exchange" not in _plan(term_frequencies(rows, "id", "t", False))


def test_hot_term_is_split(spark):
    """A term in every document, its table too large to broadcast: adaptive
    execution splits its partition."""
    from tagloom.operators import features
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    limit, features.BROADCAST_TERMS = features.BROADCAST_TERMS, 0
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        texts = spark.range(0, 20000, 1, 8).selectExpr("id", "concat('hot w', id % 50) AS t")
        out = features.exact_tfidf(texts, "id", "t", drop_stop_words=False)
        assert out.where("term = 'hot' AND df = 20000").count() == 20000
        out.collect()
        assert "skew=true" in _plan(out)
    finally:
        features.BROADCAST_TERMS = limit
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
