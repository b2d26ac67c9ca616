import pytest
from pyspark.ml.feature import RegexTokenizer
from pyspark.sql import functions as F

from tagloom.functions.tags import TAG_PATTERN, decode_indexes, label_indexes, split_tags
from tagloom.operators.labels import (filter_tags, label_cardinality, label_counts, label_vocabulary,
                                      num_labels, split_column, stable_split, with_targets)


def test_tag_filter_fixture(spark):
    df = spark.createDataFrame([(["python", "no-python"], 1), (["empty"], 2),
                                (["javascript", "jquery"], 3), (["javascript"], 4), (None, 5)],
                               "label array<string>, test int")
    out = sorted((r["test"], r["label"]) for r in filter_tags(df, ["python", "javascript"]).collect())
    assert out == [(1, ["python"]), (3, ["javascript"]), (4, ["javascript"])]


def test_filter_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(["b", "x", "a", "b"],)], "label array<string>")
    assert filter_tags(df, ["a", "b"]).first()["label"] == ["b", "a", "b"]


def test_split_matches_regex_tokenizer(spark):
    df = spark.createDataFrame([("<Python><c#><asp.net-mvc>",), ("",), ("<a><<b>>",)], "t string")
    tok = RegexTokenizer(inputCol="t", outputCol="r", pattern=TAG_PATTERN, gaps=False)
    for r in tok.transform(df.withColumn("s", split_tags("t"))).collect():
        assert r["r"] == r["s"]


def test_vocabulary_counts_targets(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, ["a"]), (3, []), (4, None)], "Id long, label array<string>")
    assert label_vocabulary(df) == ["a", "b"]
    assert label_vocabulary(df, min_support=2) == ["a"]
    assert label_vocabulary(df, top_n=1) == ["a"]
    assert num_labels(df) == 2
    assert {r["label"]: r["n"] for r in label_counts(df).collect()} == {"a": 2, "b": 1}
    c = label_cardinality(df).first()
    assert (c["n_labels"], c["n_posts"], c["n_assignments"]) == (2, 4, 3)
    t = {r["Id"]: (r["target_0"], r["target_1"]) for r in with_targets(df, ["a", "b"]).collect()}
    assert t == {1: (1.0, 1.0), 2: (1.0, 0.0), 3: (0.0, 0.0), 4: (0.0, 0.0)}


def test_index_coding(spark):
    df = spark.createDataFrame([(["b", "zz", "a"],)], "label array<string>")
    r = df.select(label_indexes("label", ["a", "b"]).alias("i"),
                  label_indexes("label", ["a", "b"], keep_unknown=True).alias("k")).first()
    assert r["i"] == [1.0, 0.0] and r["k"] == [1.0, -1.0, 0.0]
    back = df.select(decode_indexes(label_indexes("label", ["a", "b"]), ["a", "b"]).alias("d")).first()
    assert back["d"] == ["b", "a"]


def test_stable_split_is_deterministic(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "Id")
    a_train, a_test = stable_split(df, 0.8, seed=3)
    b_train, _ = stable_split(df.repartition(7), 0.8, seed=3)
    ids_a = sorted(r["Id"] for r in a_train.collect())
    assert ids_a == sorted(r["Id"] for r in b_train.collect())
    assert 1450 < len(ids_a) < 1750 and a_test.count() == 2000 - len(ids_a)
    arith = df.select(split_column("Id", 0.8, 7, "arith").alias("s")).groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in arith}["train"] == 1600
    assert df.select(split_column("Id", 0.5, 1)).where(F.col(df.columns[0]).isNull()).count() == 0


def test_arith_split_of_large_ids(spark):
    big = [2**63 - 1, 2**62, -2**63, -5, 1234567890123456789]
    df = spark.createDataFrame([(i,) for i in big], "Id long")
    got = {r["Id"]: r["s"] for r in df.select("Id", split_column("Id", 0.8, 7, "arith").alias("s")).collect()}
    assert got == {i: "train" if (i * 7919 + 7 * 104729) % 1000 < 800 else "test" for i in big}


def test_dictionary_codes_and_decodes_in_order(spark):
    from tagloom.functions.tags import label_indexes
    from tagloom.operators.labels import decode_labels, encode_labels, label_vocabulary, tag_dictionary
    rows = [(1, ["b", "a", "b"]), (1, ["zz", "é"]), (2, []), (None, None), (3, ["a", None, "unknown"])]
    df = spark.createDataFrame(rows, "Id long, label array<string>")
    known = spark.createDataFrame([(["b", "a", "zz", "é"],)], "label array<string>")
    words = tag_dictionary(known)
    vocab = label_vocabulary(known)
    assert [(r.tag, r.code) for r in words.orderBy("code").collect()] == [(t, i) for i, t in enumerate(vocab)]
    want = df.select("Id", label_indexes("label", vocab).alias("x")).collect()
    got = encode_labels(df, words, out="x").select("Id", "x").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    kept = encode_labels(df, words, out="x", keep_unknown=True).where("Id = 3").first()
    assert kept.x == [0.0, -1.0, -1.0]
    back = decode_labels(encode_labels(df, words, out="x"), words, "x", "names").select("Id", "names").collect()
    assert sorted(map(repr, [(r.Id, r.names) for r in back])) == sorted(map(repr, [
        (1, ["b", "a", "b"]), (1, ["zz", "é"]), (2, []), (None, None), (3, ["a"])]))
    rows = spark.range(40).selectExpr("id", "array(if(id % 2 = 0, 'a', 'zz'), 'b') AS label")
    by_id = encode_labels(rows, words, out="x", id_col="id").select("id", "x").collect()
    assert sorted(map(tuple, by_id)) == sorted(map(tuple, rows.select("id", label_indexes("label", vocab).alias("x")).collect()))
    plan = encode_labels(df, words, out="x")._jdf.queryExecution().toString()
    assert "zz" not in plan


def test_dictionary_over_many_partitions(spark):
    from tagloom.operators.labels import tag_dictionary
    df = spark.range(5000).selectExpr("array(concat('t', lpad(id % 3000, 5, '0'))) AS label").repartition(7)
    rows = tag_dictionary(df).orderBy("code").collect()
    assert [(r.tag, r.code) for r in rows] == [(f"t{k:05d}", k) for k in range(3000)]


def test_top_labels_are_exact(spark):
    from tagloom.operators.labels import label_counts, label_vocabulary, top_labels
    # a tag on a third of all rows, some frequent ones, thousands of rare ones
    df = spark.range(30_000).selectExpr(
        "array(if(id % 3 = 0, 'hot', concat('f', id % 11)), concat('r', id % 9000)) AS label").repartition(6)
    for n, size in ((1, 64), (5, 64), (20, 64), (12, 8192), (40, 16)):
        want = label_counts(df).orderBy("n", ascending=False).collect()
        want = sorted(((-r.n, r.label) for r in want))[:n]
        got = top_labels(df, n, sketch_items=size).collect()
        assert sorted((-r.n, r.label) for r in got) == want, (n, size)
    assert label_vocabulary(df, top_n=1) == ["hot"]
    assert top_labels(df.limit(0), 3).collect() == []


def test_unbounded_vocabulary_is_refused(spark, monkeypatch):
    import tagloom.operators.labels as labels
    monkeypatch.setattr(labels, "MAX_TAGS", 3)
    df = spark.createDataFrame([(["a", "b", "c"],), (["d"],)], "label array<string>")
    with pytest.raises(ValueError, match="more than 3 tags"):
        labels.label_vocabulary(df)
    assert labels.label_vocabulary(df.limit(1)) == ["a", "b", "c"]
