"""Near-duplicates against brute force, components, and the cells."""

import numpy as np
import pytest

from tagloom.llm.components import connected_components, forest
from tagloom.llm.embedding_neardup import near_vectors, step_chance, table_plan
from tagloom.llm.shingle_join import run_count, shared_counts, similar_texts


def grouped(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def test_forest_connects_what_the_matrix_connects():
    rng = np.random.default_rng(0)
    for n in (1, 5, 200):
        near = rng.random((n, n)) < 1.5 / n
        near |= near.T
        np.fill_diagonal(near, False)
        links = forest(near)
        assert grouped(n, links) == grouped(n, np.argwhere(near).tolist())
        assert len(links) < n


def test_components_of_a_chain_a_star_and_cycles(spark):
    links = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(2000, 2001), (2001, 2002), (2002, 2000), (3000, 3000)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    for group in (range(301), range(1000, 1400), range(2000, 2003)):
        assert len({got[x] for x in group}) == 1
    assert len(set(got.values())) == 3 and 3000 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_vectors(rows, threshold=0.98):
    def fits(x):
        return x[1] is not None and x[2] and all(v is not None and np.isfinite(v) for v in x[2]) and any(x[2])

    links = []
    for i, x in enumerate(rows):
        for j in range(i):
            y = rows[j]
            if fits(x) and fits(y) and x[1] == y[1] and len(x[2]) == len(y[2]):
                a, b = np.array(x[2]), np.array(y[2])
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links.append((j, i))
    return links


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, None):
        centre = rng.standard_normal(16)
        for _ in range(80):  # a large group of near copies, and strangers
            rows.append((k, label, (centre + rng.standard_normal(16) * 0.1).tolist()))
            rows.append((k + 1, label, rng.standard_normal(16).tolist()))
            k += 2
    same = rows[0][2]
    rows += [(900, 0, same), (901, 0, same), (902, 0, [v * 2 for v in same]), (903, 1, same), (904, 0, None), (905, 0, []),
             (906, 0, [0.0] * 16), (907, 0, [None] * 16), (908, 0, [float("nan")] * 16), (909, 0, [float("inf")] * 16),
             (910, 0, [1.0, 2.0]), (911, 0, [2.0, 4.0]), (912, 0, [1e30] * 16), (913, 0, [1e-30] * 16)]
    links = brute_vectors(rows)
    roots = grouped(len(rows), links)
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, key string, bucket int")
    for block in (16, 512):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(frame, block_rows=block).collect()}
        assert got == {r[0]: (int(degree[k]), rows[roots[k]][0], rows[roots[k]][0] == r[0]) for k, r in enumerate(rows)}
    repeated = near_vectors(frame.where("vec_id in (900, 904)").unionAll(frame.where("vec_id in (900, 904)"))).collect()
    assert sorted((r.vec_id, r.n_links) for r in repeated) == [(900, 1), (900, 1), (904, 0), (904, 0)]
    assert near_vectors(frame.limit(0)).collect() == []


def test_table_plan_keeps_its_promise():
    for n in (10, 10**4, 10**8):
        hashes, tables = table_plan(n, 0.98)
        assert (1 - step_chance(0.2, 2.0) ** hashes) ** tables <= 1.001e-4
        assert n * step_chance(2**0.5, 2.0) ** hashes <= 0.126
    rng = np.random.default_rng(0)  # the formula against a simulation
    shift, move = rng.uniform(0, 2, 10**5), rng.standard_normal(10**5) * 0.2
    assert np.mean(np.floor(shift / 2) == np.floor((shift + move) / 2)) == pytest.approx(step_chance(0.2, 2.0), abs=0.005)


def brute_texts(texts):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    links = []
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 10 * len(x & sets[j]) >= 8 * len(x | sets[j]):
                links.append((j, i))
    return links


def test_texts_against_brute_force(spark, odd, none):
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(2000)]
    base = rng.choice(words, 300).tolist()
    texts = []
    for _ in range(150):  # a large group of near copies
        t = list(base)
        for at in rng.integers(0, 300, rng.integers(0, 6)):
            t[at] = rng.choice(words)
        texts.append(" ".join(t))
    shared = " ".join(rng.choice(words, 60))
    texts += [" ".join(rng.choice(words, 300)) + " " + shared for _ in range(100)]  # a passage that many share
    texts += [texts[0], texts[0].upper(), "", None, " \n", "one two", "ONE  two", "one", "a b c d e f", "a b c d e f g"]
    links = brute_texts(texts)
    roots = grouped(len(texts), links)
    degree = np.bincount(np.array(links).ravel(), minlength=len(texts))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {k: (int(degree[k]), roots[k], roots[k] == k) for k in range(len(texts))}
    for leaf, block in ((64, 256), (8, 16)):
        got = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in similar_texts(frame, leaf_rows=leaf, block_rows=block).collect()}
        assert got == want
    rows = similar_texts(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.doc_id, r.n_links) for r in rows if r.doc_id in (1, 2, 3, 4, 5, 7)} == {(1, 2), (2, 2), (3, 0), (4, 0), (5, 1), (5, 0), (7, 0)}
    assert similar_texts(none).collect() == []


def test_runs_and_intersections():
    assert run_count(0.8, 0.9999) == 4
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, 400).astype(np.uint64)) for _ in range(40)]
    pairs = np.array([(a, b) for a in range(40) for b in range(a)])
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in pairs]
    assert shared_counts(sets, pairs).tolist() == want
    assert shared_counts(sets, pairs[:5]).tolist() == want[:5]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_planted_vector_links_are_found(spark, kind):
    """Pairs at cosines just above the threshold among strangers, in two
    labels: every one is found, and no other."""
    rng = np.random.default_rng(12)
    n, dims = 2500, 64
    base = rng.standard_normal((n, dims))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((n, dims))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9802, 0.99, n)[:, None]
    near = cosine * base + np.sqrt(1 - cosine ** 2) * side
    near[::5] = 0.979 * base[::5] + np.sqrt(1 - 0.979 ** 2) * side[::5]    # just below
    rows = [(k, k % 2, base[k].tolist()) for k in range(n)] + [(n + k, k % 2 if k % 7 else 1 - k % 2, near[k].tolist()) for k in range(n)]
    df = spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    for k in range(n):
        linked = k % 5 != 0 and k % 7 != 0
        assert got[k] == ((1, k) if linked else (0, k)), k
        assert got[n + k] == ((1, k) if linked else (0, n + k)), k


def test_buckets_of_one_name_are_told_apart(spark, monkeypatch):
    """All buckets of a table under one 64-bit name: nothing is counted twice,
    and labels and lengths stay apart."""
    import tagloom.llm.embedding_neardup as module
    real = module.F

    class Functions:
        def xxhash64(self, *cols):
            return real.lit(7).cast("long") if cols == ("name", "label", "n") else real.xxhash64(*cols)

        def __getattr__(self, name):
            return getattr(real, name)

    rng = np.random.default_rng(2)
    rows = []
    for k in range(60):
        x = rng.standard_normal(8 if k % 3 else 6)
        rows += [(3 * k, "a", x.tolist()), (3 * k + 1, "a", (x + 0.01 * rng.standard_normal(len(x))).tolist()), (3 * k + 2, "b", x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    want = sorted(map(tuple, near_vectors(df).collect()))
    monkeypatch.setattr(module, "F", Functions())
    assert sorted(map(tuple, near_vectors(df).collect())) == want
