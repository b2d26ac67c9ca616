"""Ranked lexical search of many queries with shared parts evaluated once.

Texts become terms once: a written table holds, of every document, the terms
that may occur in some query, their counts and the document's length. Queries
are taken in blocks of bounded size. Of a block's queries, sets of terms that
several of them share are mined: terms of the same queries are one set, and
sets that stand together in several queries are joined pair by pair. Every
shared set is a node of a graph whose value for a document, a partial score, is
computed once and added up along the graph to the scores of all queries. Every
task keeps the best rows of each query; a window over these gives the result.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import written

TOP = 10
#: Distinct (query, term) pairs of a block, about.
BLOCK_TERMS = 100_000
SLOTS = 1 << 20
SLICE_BYTES = 1 << 20
CELLS = 1 << 20

# ASCII letters and digits and all other characters' bytes are terms; the rest separates.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 0x80 or chr(b).isalnum() else 32 for b in range(256))


def term_counts(text: str) -> tuple[int, Counter]:
    """Terms of a text with repeats, and the count of each (UTF-8 bytes, A-Z
    in lower case)."""
    folded = text.encode().translate(_FOLD)
    n, counts, at = 0, Counter(), 0
    while at < len(folded):  # long texts in slices that end between terms
        end = folded.find(b" ", at + SLICE_BYTES)
        words = folded[at:end if end >= 0 else len(folded)].split()
        n += len(words)
        counts.update(words)
        at = end + 1 if end >= 0 else len(folded)
    return n, counts


# ------------------------------------------------------------ shared parts

class Plan:
    """Graph of shared term sets of a block of queries.

    ``queries``: of each query its terms and their counts. Leaves are sets of
    (term, count) that occur in exactly the same queries; a node adds two
    earlier ones; a query adds what is left of it.
    """

    def __init__(self, queries: list[dict[bytes, int]]):
        where: dict[tuple[bytes, int], list[int]] = {}
        for k, q in enumerate(queries):
            for part in q.items():
                where.setdefault(part, []).append(k)
        sets: dict[tuple[int, ...], list[tuple[bytes, int]]] = {}
        for part, of in where.items():
            sets.setdefault(tuple(of), []).append(part)
        self.leaves = [sorted(parts) for parts in sets.values()]
        of_query: list[list[int]] = [[] for _ in queries]
        for node, of in enumerate(sets):
            for k in of:
                of_query[k].append(node)
        used = [len(of) for of in sets]
        self.pairs: list[list[tuple[int, int]]] = []  # level by level
        n = len(self.leaves)
        while True:
            # what most queries use stands first, so that shared parts are neighbours
            lists = [sorted(q, key=lambda x: (-used[x], x)) for q in of_query]
            seen = Counter(pair for q in lists for pair in zip(q, q[1:]))
            shared = {pair for pair, c in seen.items() if c > 1}
            if not shared:
                break
            level: dict[tuple[int, int], int] = {}
            of_query = []
            for q in lists:
                out, k = [], 0
                while k < len(q):
                    pair = tuple(q[k:k + 2])
                    # of overlapping pairs the one that more queries share goes first
                    if pair in shared and seen[pair] >= seen.get(tuple(q[k + 1:k + 3]), 0):
                        out.append(level.setdefault(pair, n + len(level)))
                        k += 2
                    else:
                        out.append(q[k])
                        k += 1
                of_query.append(out)
            if not level:
                break
            self.pairs.append(list(level))
            n += len(level)
            counted = Counter(x for q in of_query for x in q)
            used = [counted.get(x, 0) for x in range(n)]
        self.nodes, self.of_query = n, of_query

    def arrays(self, terms: dict[bytes, int]) -> dict:
        """Index arrays for ``evaluate``, with terms numbered by ``terms``."""
        flat = [(terms[t], c) for leaf in self.leaves for t, c in leaf]
        lists = [q if q else [self.nodes] for q in self.of_query]  # a query without terms: a node of zeros
        return {
            "term": np.array([t for t, _ in flat], dtype=np.int64), "times": np.array([c for _, c in flat], dtype=np.int64),
            "leaf": np.cumsum([0, *map(len, self.leaves)])[:-1].astype(np.int64), "nodes": self.nodes,
            "levels": [np.array(level, dtype=np.int64).T for level in self.pairs],
            "sum": np.array([x for q in lists for x in q], dtype=np.int64), "query": np.cumsum([0, *map(len, lists)])[:-1].astype(np.int64)}


def evaluate(plan: dict, parts: np.ndarray) -> np.ndarray:
    """Scores (queries, documents) from the terms' parts (terms, documents)."""
    width = parts.shape[1]
    value = np.zeros((plan["nodes"] + 1, width), dtype=np.int64)
    if len(plan["term"]):
        leaves = np.add.reduceat(parts[plan["term"]] * plan["times"][:, None], plan["leaf"], axis=0)
        value[:len(leaves)] = leaves
        at = len(leaves)
        for left, right in plan["levels"]:
            np.add(value[left], value[right], out=value[at:at + len(left)])
            at += len(left)
    return np.add.reduceat(value[plan["sum"]], plan["query"], axis=0)


# ------------------------------------------------------------------- Spark

_FOUND = "query long, doc_id long, score long"


def _postings(docs: DataFrame, slots: bytes) -> DataFrame:
    """(doc_id, n, terms, counts): terms whose hash slot some query has."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int32()))])

    def tally(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                sizes, terms, counts = [], [], []
                for text in part.column(1):
                    n, found = term_counts(text.as_py() or "")
                    kept = [t for t in found if slots[zlib.crc32(t) % SLOTS]]
                    sizes.append(n)
                    terms.append(kept)
                    counts.append([found[t] for t in kept])
                yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()), pa.array(terms, schema[2].type),
                                       pa.array(counts, schema[3].type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tally, "doc_id long, n long, terms array<binary>, counts array<int>")


def _block_scores(postings: DataFrame, terms: list[bytes], weights: np.ndarray, plan: dict, names: list[int], docs: int, total: int, top: int) -> DataFrame:
    """Best rows of each query of a block, per task."""
    schema = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    last = np.iinfo(np.int64).max

    def best(batches):
        vocabulary = pa.array(terms, pa.binary())
        found = [[] for _ in names]  # (-score, doc_id or none last, doc_id)
        floor = np.zeros(len(names), dtype=np.int64)
        width = max(1, CELLS // max(1, len(terms) + plan["nodes"] + len(plan["sum"])))
        for batch in batches:
            for a in range(0, batch.num_rows, width):
                part = batch.slice(a, width)
                n = part.column(1).to_numpy()
                lists = part.column(2)
                at = pc.index_in(lists.flatten(), vocabulary).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
                known = ~np.isnan(at) if at.dtype.kind == "f" else np.ones(len(at), dtype=bool)
                t, row = at[known].astype(np.int64), row[known]
                tf = part.column(3).flatten().to_numpy().astype(np.int64)[known]
                m = 25 + 75 * n * docs // total if total else np.zeros_like(n)
                parts = np.zeros((len(terms), part.num_rows), dtype=np.int64)
                parts[t, row] = weights[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                scores = evaluate(plan, parts)
                ids = part.column(0).to_pylist()
                qs, ds = np.nonzero((scores >= floor[:, None]) & (scores > 0))
                touched = set()
                for q, d in zip(qs.tolist(), ds.tolist()):
                    found[q].append((-int(scores[q, d]), last if ids[d] is None else ids[d], ids[d] is None))
                    touched.add(q)
                for q in touched:
                    found[q].sort()
                    del found[q][top:]
                    if len(found[q]) == top:
                        floor[q] = -found[q][-1][0]
        out = [(names[q], None if none else doc_id, -score) for q, rows in enumerate(found) for score, doc_id, none in rows]
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return postings.where(F.size("terms") > 0).mapInArrow(best, _FOUND)


def ranked_search(items: DataFrame, docs: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank (from 1), doc_id,
    score (above 0; equal scores by ascending doc_id, null last).

    A null, empty or term-less text of an item finds nothing, one of a document
    is found by nothing and does not count as a document. Rows that repeat
    item_id and text are one item; rows that share only the id (a null one
    too) are ranked each. Every row of documents counts, repeated ones too.
    Whole texts of any length are read. No items or no documents give no rows;
    other columns are ignored.
    """
    spark = items.sparkSession
    rows = items.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    schema = pa.schema([("item_id", pa.int64()), ("query", pa.int64()), ("term", pa.binary()), ("count", pa.int64())])

    def split(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # the name of a query: a digest of its id and text
                text = text.as_py()
                name = int.from_bytes(hashlib.blake2b(f"{item}:{text}".encode(), digest_size=8).digest(), "little", signed=True)
                counts = term_counts(text)[1]
                if counts:
                    yield pa.record_batch([pa.array([item] * len(counts), pa.int64()), pa.array([name] * len(counts), pa.int64()),
                                           pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    queries = written(rows.mapInArrow(split, "item_id long, query long, term binary, count long"), "search-queries")
    slot = F.pmod(F.crc32("term"), F.lit(SLOTS))
    used = queries.select(slot.cast("int").alias("s")).distinct()
    slots = bytearray(SLOTS)
    for r in used.toLocalIterator():  # at most SLOTS numbers
        slots[r.s] = 1
    postings = written(_postings(docs, bytes(slots)), "search-postings")
    total = postings.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    entries = queries.count()
    if not total.docs or not entries:
        return queries.select("item_id", F.lit(1).alias("rank"), F.col("query").alias("doc_id"), F.col("count").alias("score")).limit(0)
    asked = queries.select("term").distinct()
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    frequency = written(asked.join(held, "term"), "search-frequencies")
    blocks = math.ceil(entries / block_terms)
    block = F.pmod(F.xxhash64("query"), F.lit(blocks))
    found = None
    for b in range(blocks):
        wanted = queries.where(block == b)
        texts: dict[int, dict[bytes, int]] = {}
        for r in wanted.select("query", "term", "count").toLocalIterator():
            texts.setdefault(r["query"], {})[bytes(r["term"])] = r["count"]
        of_terms = frequency.join(wanted.select("term").distinct(), "term") if blocks > 1 else frequency
        weight = {bytes(r.term): math.floor(1000 * math.log((2 * total.docs + 2) / (2 * r.df + 1))) for r in of_terms.toLocalIterator()}
        if not weight:
            continue
        # terms that no document holds add nothing
        names = sorted(texts)
        plan = Plan([{t: c for t, c in texts[q].items() if t in weight} for q in names])
        terms = sorted(weight)
        arrays = plan.arrays({t: k for k, t in enumerate(terms)})
        part = _block_scores(postings, terms, np.array([weight[t] for t in terms], dtype=np.int64), arrays, names, total.docs, int(total.terms), top)
        part = written(part, "search-best")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return queries.select("item_id", F.lit(1).alias("rank"), F.col("query").alias("doc_id"), F.col("count").alias("score")).limit(0)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ids = queries.groupBy("query").agg(F.first("item_id").alias("item_id"))
    return best.join(ids, "query").select("item_id", "rank", "doc_id", "score")
