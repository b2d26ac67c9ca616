"""Exact dedup and source mix against plain Python."""

import hashlib
import random
from collections import defaultdict
from heapq import heappop, heappush

from pyspark.sql import functions as F

from tagloom.llm.exact_dedup import exact_dedup
from tagloom.llm.source_mix import apportion, mix_sources, mixed_documents

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_dedup(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(UPPER)].append(d)
    out = []
    for text, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep, done = max(known, default=None), False
        for d in sorted(ids, key=repr):
            kept = d == keep and not done
            done |= kept
            out.append((d, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(repr, out))


def test_dedup_against_brute_force(spark, odd, none):
    r = random.Random(3)
    rows = [(k, "".join(r.choices("aAbé", k=r.choice((0, 1, 2, 7, 8, 9, 16, 17, 40))))) for k in range(600)]
    rows += [(1000 + k, "Z" * 33) for k in range(200)] + [(5000, "z" * 33 + "y"), (5001, "z" * 32)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_dedup(frame, block_bytes=8)
    assert sorted(repr(tuple(x)) for x in got.collect()) == brute_dedup(rows)
    whole = sorted(repr(tuple(x)) for x in exact_dedup(odd).collect())
    assert whole == brute_dedup([(x.doc_id, x.text) for x in odd.collect()])
    assert exact_dedup(none).collect() == []


def test_seats_go_by_highest_quotients(spark):
    r = random.Random(1)
    for votes, seats in (([5, 3, 1], 7), ([1] * 5, 3), ([0, 4], 3), ([0, 0], 0), ([r.randint(0, 10**6) for _ in range(60)], 1000),
                         ([10**9, 1, 1, 1], 50), ([53, 24, 23], 1)):
        heap, won = [], [0] * len(votes)
        for k, v in enumerate(votes):
            if v:
                heappush(heap, (-v, k))
        for _ in range(seats):
            _, k = heappop(heap)
            won[k] += 1
            heappush(heap, (-votes[k] / (2 * won[k] + 1), k))
        frame = spark.createDataFrame([(k, v, seats) for k, v in enumerate(votes)], "k int, v long, s long")
        got = {x.k: x.w for x in apportion(frame, "v", "s", [], ["k"], "w").collect()}
        assert got == dict(enumerate(won))


def test_mix_keeps_to_its_targets(spark):
    r = random.Random(2)
    rows = [(k, " ".join(["w"] * r.randint(0, 300)), r.choice(["a", "a", "a", "b", "c", None, "d"])) for k in range(3000)]
    rows += [(9000, None, "empty"), (9001, None, "empty")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(frame, shard_words=5000).collect()
    assert len(got) == len(rows)
    taken, size, target = defaultdict(int), defaultdict(int), {}
    of = {d: s for d, _, s in rows}
    for x in got:
        assert 0 <= x.taken <= 2 * x.size
        taken[of[x.doc_id]] += x.taken
        size[of[x.doc_id]] += x.size
        target[of[x.doc_id]] = x.target
        assert x.size == len((next(t for d, t, _ in rows[x.doc_id:x.doc_id + 1]) if x.doc_id < 3000 else "").split())
    # by hand: weights in order of code point, the null source last
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal, capped = {}, set()
    while True:
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        goal = {s: 2 * size[s] if s in capped else left * weight[s] / free for s in order}
        over = {s for s in order if goal[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    for s in order:
        assert abs(target[s] - goal[s]) < 1e-6 * max(1, goal[s])
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 64
    assert sorted(map(tuple, mix_sources(frame.repartition(7), shard_words=5000).collect()), key=repr) == sorted(map(tuple, got), key=repr)
    words = mixed_documents(frame, shard_words=5000).withColumn("w", F.size(F.filter(F.split("text", " "), lambda x: x != "")))
    for s, w in words.groupBy("source").agg(F.sum("w")).collect():
        assert s == "empty" or abs(w - target[s]) <= 0.03 * target[s] + 600


def test_mix_of_odd_rows(odd, none):
    got = mix_sources(odd).collect()
    assert len(got) == odd.count() and all(0 <= x.taken <= 2 * x.size for x in got)
    assert mix_sources(none).collect() == []
    assert mixed_documents(odd).columns == odd.columns and mixed_documents(none).collect() == []


def test_mix_without_ids_and_with_copies(spark):
    """No row has an id of its own, and one text is copied a thousand times:
    shards stay small, copies are one row in them, and targets are kept."""
    from tagloom.llm.source_mix import SEED, SHARE, WEIGHTS, _counted, _sized, _with_quotas
    rows = [(None if k % 3 else 5, f"w{k} " * (20 + k % 30), "hot" if k % 4 else "b") for k in range(3000)]
    rows += [(None, "same text again and again " * 4, "hot")] * 1000
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(frame, shard_words=2000, block_words=16).collect()
    assert len(got) == 4000 and all(0 <= r.taken <= 2 * r.size for r in got)
    for size, target in {(r.source_size, r.target) for r in got}:
        assert abs(sum(r.taken for r in got if r.source_size == size) - target) <= 0.02 * target
    again = mix_sources(frame.repartition(9), shard_words=2000, block_words=16).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)
    sizes = _counted(_sized(frame))
    laid = _with_quotas(sizes, sizes, WEIGHTS, SHARE, 16, 2000, SEED)
    assert max(r["count"] for r in laid.groupBy("no", "shard").count().collect()) < 200
