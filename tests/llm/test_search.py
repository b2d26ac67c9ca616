"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np

from tagloom.llm.ranked_search import Plan, evaluate, ranked_search, term_counts

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(items, docs):
    """(item_id, rank, doc_id, score) by hand."""
    counted = [(d, Counter(terms_of(t)), len(terms_of(t))) for d, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        rows = []
        for d, tf, n in counted:
            score = 0
            for t in terms_of(text):
                if tf[t]:
                    m = 100 - 75 + (75 * n * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(rows, key=lambda r: r[:3])[:10])]
    return sorted(out, key=repr)


def test_terms():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choices("aZé0_ -\n\x00\x1c　İKßk'日", k=40))
        n, found = term_counts(text)
        assert n == len(terms_of(text)) and found == Counter(t.encode() for t in terms_of(text))


def test_long_text_in_slices(monkeypatch):
    monkeypatch.setattr("tagloom.llm.ranked_search.SLICE_BYTES", 5)
    text = "one two two threethreethree  four " * 20
    n, found = term_counts(text)
    assert n == len(terms_of(text)) and found == Counter(t.encode() for t in terms_of(text))


def test_shared_parts_add_up():
    r = random.Random(5)
    for _ in range(50):
        words = [f"w{k}".encode() for k in range(30)]
        queries = [{t: r.randint(1, 3) if r.random() < 0.2 else 1 for t in r.sample(words, r.randint(0, 20))} for _ in range(15)]
        plan = Plan(queries)
        parts = np.array([[r.randint(0, 9) for _ in range(4)] for _ in words])
        got = evaluate(plan.arrays({t: k for k, t in enumerate(words)}), parts)
        want = [[sum(c * parts[words.index(t)][d] for t, c in q.items()) for d in range(4)] for q in queries]
        assert got.tolist() == want


def test_common_sets_are_nodes_of_their_own():
    shared = {f"s{k}".encode(): 1 for k in range(10)}
    more = {f"t{k}".encode(): 1 for k in range(5)}
    plan = Plan([shared | {b"a": 1}, shared | more, shared | more | {b"b": 1}])
    # the ten and the five terms are one leaf each; both together one node
    assert sorted(map(len, plan.leaves)) == [1, 1, 5, 10] and sum(map(len, plan.pairs)) >= 1
    assert sum(map(len, plan.of_query)) <= 5


def _items(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "item_id long, text string, query long, rank int")


def test_odd_rows(spark, odd, none):
    items = [(1, "alpha beta"), (1, "alpha beta"), (2, "ALPHA word word"), (3, None), (4, ""), (None, "one É é"), (5, "one two"), (5, "two"), (6, "nowhere"), (7, "12")]
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    for block_terms in (100_000, 2):
        got = ranked_search(_items(spark, items), odd, block_terms=block_terms).collect()
        assert sorted(map(tuple, got), key=repr) == expected(items, docs)
    assert ranked_search(_items(spark, items), none).collect() == []
    assert ranked_search(_items(spark, items).limit(0), odd).collect() == []
    assert ranked_search(_items(spark, [(6, "nowhere")]), odd).collect() == []


def test_ties_and_hot_terms(spark):
    r = random.Random(7)
    docs = [(k, " ".join(r.choices(["the", "of", "Rain", "é", "x1"], k=r.randint(1, 4)))) for k in range(400)] + [(None, "the rain")] * 3
    items = [(k, " ".join(r.choices(["the", "of", "rain", "é", "x1", "snow"], k=4))) for k in range(25)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = ranked_search(_items(spark, items), df).collect()
    assert sorted(map(tuple, got), key=repr) == expected(items, docs)


def test_query(spark):
    from tagloom.llm.queries import op12_ranked_search
    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op12_ranked_search(spark, sf).collect()), key=repr) == expected(items, docs)
