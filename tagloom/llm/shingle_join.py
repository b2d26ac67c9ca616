"""N-gram Jaccard join by chosen paths.

Texts are sets of word 5-grams. Of every set, SAMPLES tokens are drawn by
min-hashing: two sets draw the same token with probability their Jaccard
similarity. A run starts with all sets in one node; a node splits its sets by
the tokens they drew at BRANCHES sampled places, so that a set goes to
BRANCHES children and a pair at 0.8 shares 1.6 of them on average: it lives on
for ever with probability 0.94 in a run, and the runs repeat until the target
recall. Nodes with few sets, and nodes that no longer shrink (their sets are
alike), are compared pair by pair; only crowded nodes go on splitting, for all
runs at once.

Texts with equal sets are one class. A class knows the names of its leaves,
and a pair is taken in the least leaf it shares, so pairs are never gathered
to remove repeats. Leaves first compare the drawn tokens (a few hundred bytes a class);
only classes with a partner whose estimate lies within five standard errors of
the threshold get their whole sets back from the texts for the exact
comparison. Leaves of any size are compared in bounded cells.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.cells import over_cells, to_cells
from tagloom.llm.common import dropped, likely, worker_state, written
from tagloom.llm.components import forest, linked_rows

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
BRANCHES, DEPTH, LEAF_ROWS, SEED = 2, 6, 64, 5
#: A child with this share of its node's sets is not split further.
ALIKE = 0.7
DEEP_SAMPLES = 16
BLOCK_ROWS = 256
SLICE_CHARS = 1 << 20
_SPACE = re.compile(r"\s")


def run_count(threshold: float = THRESHOLD, recall: float = RECALL, branches: int = BRANCHES) -> int:
    """Runs until a pair at the threshold is found with the target recall."""
    lives = 1.0
    for _ in range(200):  # survival of one run, at any depth
        lives = 1 - (1 - threshold * lives) ** branches
    return math.ceil(math.log(1 - recall) / math.log(1 - lives))


class Shingler:
    """Word n-grams of texts as 64-bit hashes, and tokens drawn of them."""

    def __init__(self, words: int = WORDS, samples: int = 0, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.words = words
        self.places = rng.integers(1, 2**63, size=words, dtype=np.uint64) | np.uint64(1)
        self.letters = rng.integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)
        self.factors = rng.integers(1, 2**31, size=samples, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = rng.integers(0, 2**32, size=samples, dtype=np.uint32)

    def _hashed(self, words: list[str]) -> np.ndarray:
        """64-bit hashes of words, from all their letters at once."""
        letters = np.frombuffer((" ".join(words) + " ").encode("utf-32-le"), dtype=np.uint32)
        ends = np.flatnonzero(letters == 32)
        starts = np.concatenate([[0], ends[:-1] + 1])
        sizes = ends + 1 - starts
        if (longest := int(sizes.max())) > len(self.letters):  # powers of an odd number, beyond the first places
            more = np.multiply.accumulate(np.full(longest - len(self.letters), 0xD6E8FEB86659FD93, dtype=np.uint64))
            factors = np.concatenate([self.letters, self.letters[-1] * more])
        else:
            factors = self.letters
        x = (letters + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * factors[np.arange(len(letters)) - np.repeat(starts, sizes)]
        h = np.add.reduceat(x ^ (x >> np.uint64(30)), starts)
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct n-grams of the lower-cased words; a text of fewer
        words is one n-gram, an empty one has none."""
        hashes, at = [], 0
        while at < len(text):  # long texts in slices that end at white space
            end = _SPACE.search(text, at + SLICE_CHARS) if len(text) - at > SLICE_CHARS else None
            words = text[at:end.start() if end else len(text)].lower().split()
            at = end.end() if end else len(text)
            if words:
                hashes.append(self._hashed(words))
        if not hashes:
            return np.zeros(0, dtype=np.uint64)
        h = np.concatenate(hashes)
        n = max(1, len(h) - self.words + 1)
        grams = np.full(n, min(len(h), self.words), dtype=np.uint64)
        for k in range(min(self.words, len(h))):
            grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[k:k + n] * self.places[k]
        grams = (grams ^ (grams >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return np.unique(grams ^ (grams >> np.uint64(29)))

    def drawn(self, grams: np.ndarray) -> np.ndarray:
        """One token per place: the n-gram that a seeded order puts first."""
        low = (grams >> np.uint64(16)).astype(np.uint32)
        least = np.full(len(self.factors), np.iinfo(np.uint32).max, dtype=np.uint32)
        for at in range(0, len(low), 4096):  # long texts in slices
            least = np.minimum(least, (low[at:at + 4096, None] * self.factors + self.shifts).min(axis=0))
        return least


def packed(tokens: np.ndarray, first: int) -> bytes:
    """The first ``first`` tokens name the nodes of all sets: 32 bits each. The
    others split crowded nodes further: 16 bits do."""
    return tokens[:first].tobytes() + tokens[first:].astype(np.uint16).tobytes()


def unpacked(samples: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``packed`` tokens: the first ones, the others."""
    rows = np.frombuffer(b"".join(samples), dtype=np.uint8).reshape(len(samples), -1)
    return rows[:, :4 * first].copy().view(np.uint32), rows[:, 4 * first:].copy().view(np.uint16)


def _low_bytes(sample: Column, first: int, samples: int) -> Column:
    """The lowest byte of every packed token, which pairs are estimated by."""
    text = F.hex(sample)
    at = [8 * k + 1 for k in range(first)] + [8 * first + 4 * k + 1 for k in range(samples - first)]
    return F.unhex(F.concat(*[F.substring(text, k, 2) for k in at]))


def _mix(path: np.ndarray, place: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Name of the child node."""
    x = path.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) + token.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _set_key(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def raw_key(text: Column) -> Column:
    """Digest of a text as it is; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256))


def similar_texts(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL,
                  leaf_rows: int = LEAF_ROWS, depth: int = DEPTH, seed: int = SEED, block_rows: int = BLOCK_ROWS,
                  named: bool = False) -> DataFrame:
    """One row per document: doc_id, n_links (other documents at ``threshold``
    or more), component_id (smallest doc_id reached by links), kept.

    Words are what white space separates, lower-cased. Null, empty and blank
    texts have no n-grams and link with nothing; texts with equal n-gram sets
    always link. Repeated rows count as documents. A null doc_id counts as the
    largest. No rows give no rows; other columns are ignored.

    Rows of one id with different texts are different documents; ``named`` adds
    what tells them apart: sha (``raw_key``) and root, the name of the component
    (null without n-grams).
    """
    runs = run_count(threshold, recall)
    first = BRANCHES * runs
    samples = first + DEEP_SAMPLES * (depth - 1)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       *([raw_key(F.col("text")).alias("sha")] if named else []))
    keyed = written(_sampled(rows, words, samples, first, seed), "sampled")
    sets = keyed.where("key is not null")
    classes = written(sets.groupBy("key").agg(F.first("sample").alias("sample"), F.count("*").alias("copies"),
                                              F.min("doc_id").alias("low")), "set-classes")
    leaves = _leaves(classes, runs, depth, leaf_rows)
    names = leaves.groupBy("key").agg(F.sort_array(F.collect_list("path")).alias("paths"))  # at most runs * 2^depth
    names = written(names, "leaf-names")
    low_bytes = _low_bytes(F.col("sample"), first, samples).alias("sample")
    known = written(likely(classes, "key", names, "key").select("key", low_bytes, "copies", "low").join(names, "key"), "leaf-classes")
    estimate = threshold - 5 * math.sqrt(threshold * (1 - threshold) / samples)
    # of its leaves' names a row needs the lesser ones: a pair is taken in the least leaf it shares
    lesser = F.filter("paths", lambda p: p < F.col("path")).alias("paths")
    cells = to_cells(leaves.join(known.select("key", "sample", "paths"), "key").select("key", "path", "members", "sample", lesser),
                     "path", "members", F.xxhash64("key"), block_rows)
    wanted = written(over_cells(cells, _candidates(estimate), "path long, key binary").distinct(), "candidates")
    sizes = written(wanted.groupBy("path").agg(F.count("*").alias("members")), "candidate-sizes")
    wanted = written(wanted.join(sizes, "path").join(known, "key").select("key", "path", "members", "sample", "copies", "low", lesser), "sized-candidates")
    whole = _whole_sets(rows, wanted, words, seed)
    same_text = F.col("doc_id").eqNullSafe(F.col("low"))
    cells = to_cells(wanted.join(whole.withColumnRenamed("key", "set_key"), (F.col("key") == F.col("set_key")) & same_text).drop("set_key", "doc_id", "low"),
                     "path", "members", F.xxhash64("key"), block_rows)
    found = written(over_cells(cells, _compare(estimate, threshold), "key binary, links long, a binary, b binary"), "text-links")
    alone = keyed.where("key is null").select(
        "doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
        *(["sha", F.lit(None).cast("binary").alias("root")] if named else []))
    return linked_rows(sets, "doc_id", found, ("sha", "root") if named else ()).unionByName(alone)


def _sampled(rows: DataFrame, words: int, samples: int, first: int, seed: int) -> DataFrame:
    """(doc_id, key of the n-gram set or null, drawn tokens, and sha if given)."""
    sha = [c for c in rows.columns if c == "sha"]
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("sample", pa.binary()), *((c, pa.binary()) for c in sha)])

    def sample(batches):
        shingler = worker_state(Shingler, words, samples, seed)
        for batch in batches:
            keys, drawn = [], []
            for text in batch.column(1):
                grams = shingler.shingles(text.as_py())
                keys.append(_set_key(grams) if len(grams) else None)
                drawn.append(packed(shingler.drawn(grams), first) if len(grams) else None)
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), pa.array(drawn, pa.binary()), *(batch.column(c) for c in sha)], schema=schema)

    return rows.mapInArrow(sample, ", ".join(["doc_id long, key binary, sample binary", *(f"{c} binary" for c in sha)]))


def _children(level: int, runs: int):
    """Task function: the nodes that a node's sets go to."""
    schema = pa.schema([("key", pa.binary()), ("path", pa.int64()), ("of", pa.int64())])

    def split(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sample = unpacked(batch.column("sample").to_pylist(), BRANCHES * runs)[min(level, 1)]
            rows = np.arange(batch.num_rows)
            if level == 0:
                starts = [(np.full(len(rows), k // BRANCHES, dtype=np.uint64), np.full(len(rows), k)) for k in range(BRANCHES * runs)]
            else:
                path = batch.column("path").to_numpy().view(np.uint64)
                first = DEEP_SAMPLES * (level - 1)
                one = (path >> np.uint64(7)) % np.uint64(DEEP_SAMPLES)
                # the other places follow the first one around: never the same twice
                starts = [(path, first + ((one + np.uint64(k * 7)) % np.uint64(DEEP_SAMPLES)).astype(np.int64)) for k in range(BRANCHES)]
            for path, place in starts:
                child = _mix(path, place, sample[rows, place]).view(np.int64)
                yield pa.record_batch([batch.column("key"), pa.array(child), batch.column("members")], schema=schema)

    return split


def _leaves(classes: DataFrame, runs: int, depth: int, leaf_rows: int) -> DataFrame:
    """(key, path, members) of the nodes to compare, nodes of one set left out."""
    nodes = classes.select("key", "sample", F.lit(0).cast("long").alias("path"), F.lit(None).cast("long").alias("members"))
    leaves = None
    for level in range(depth):
        into = nodes.mapInArrow(_children(level, runs), "key binary, path long, of long")
        into = written(into, f"nodes-{level}")
        last = level == depth - 1
        n = F.col("members")
        sizes = into.groupBy("path").agg(F.count("*").alias("members"), F.max("of").alias("of")).where("members > 1").select(
            "path", "members", ((n <= leaf_rows) | F.coalesce(n >= ALIKE * F.col("of"), F.lit(False)) | F.lit(last)).alias("leaf"))
        sizes = written(sizes, f"node-sizes-{level}")
        sized = written(into.select("key", "path").join(sizes, "path"), f"sized-{level}")
        dropped(into, sizes)
        here = sized.where("leaf").select("key", "path", "members")
        leaves = here if leaves is None else leaves.unionByName(here)
        crowded = sized.where("not leaf")
        if last or crowded.isEmpty():
            return leaves
        # few classes are in crowded nodes: only their tokens are moved
        classes = likely(classes, "key", crowded, "key").select("key", "sample")
        nodes = crowded.select("key", "path", "members").join(classes, "key")
    return leaves


def _pairs(cell: pa.Table, estimate: float) -> np.ndarray:
    """Pairs of the cell whose drawn tokens agree enough and that no lesser
    leaf has, as a symmetric matrix."""
    n = cell.num_rows
    first = cell.column("cell")[0].as_py()
    sample = np.frombuffer(b"".join(cell.column("sample").to_pylist()), dtype=np.uint8).reshape(n, -1)
    same = np.zeros((n, n), dtype=np.int16)
    for c in range(sample.shape[1]):
        same += sample[:, c][:, None] == sample[:, c][None, :]
    near = same >= estimate * sample.shape[1]
    np.fill_diagonal(near, False)
    if first["i"] != first["j"]:  # pairs within a block belong to the block's own cell
        block = cell.column("block").to_numpy()
        near &= block[:, None] != block[None, :]
    if near.any():
        lists = cell.column("paths").to_pylist()
        lesser = sorted({p for x in lists for p in x})
        if lesser:
            at = {p: k for k, p in enumerate(lesser)}
            has = np.zeros((n, len(lesser)), dtype=np.float32)
            for k, x in enumerate(lists):
                has[k, [at[p] for p in x]] = 1
            near &= ~((has @ has.T) > 0)
    return near


def _candidates(estimate: float):
    schema = pa.schema([("path", pa.int64()), ("key", pa.binary())])

    def candidates(cell: pa.Table) -> list[pa.RecordBatch]:
        if cell.num_rows < 2:
            return []
        rows = np.flatnonzero(_pairs(cell, estimate).any(axis=1))
        if not len(rows):
            return []
        path = cell.column("cell")[0].as_py()["bucket"]
        keys = cell.column("key").take(pa.array(rows)).combine_chunks()
        return [pa.record_batch([pa.array([path] * len(rows), pa.int64()), keys], schema=schema)]

    return candidates


def _whole_sets(rows: DataFrame, wanted: DataFrame, words: int, seed: int) -> DataFrame:
    """(doc_id, key, grams): n-gram sets, computed again, of the texts that may
    be the least document of a wanted class."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("grams", pa.binary())])

    def sets(batches):
        shingler = worker_state(Shingler, words, 0, seed)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                grams = [shingler.shingles(text.as_py()) for text in part.column(1)]
                yield pa.record_batch([part.column(0), pa.array([_set_key(g) for g in grams], pa.binary()),
                                       pa.array([g.tobytes() for g in grams], pa.binary())], schema=schema)

    return likely(rows, "doc_id", wanted, "low").select("doc_id", "text").mapInArrow(sets, "doc_id long, key binary, grams binary")


def shared_counts(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (rows of indices)."""
    if len(pairs) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs])
    every, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    common = np.bincount(column) > 1
    place = np.cumsum(common) - 1
    take = common[column]
    row, column = row[take], place[column[take]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    for a in range(0, int(common.sum()), width):
        lo, hi = np.searchsorted(column, [a, a + width])
        has = np.zeros((len(sets), width), dtype=np.float32)
        has[row[lo:hi], column[lo:hi] - a] = 1
        total += has @ has.T
    return total[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def _compare(estimate: float, threshold: float):
    schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])

    def compare(cell: pa.Table) -> list[pa.RecordBatch]:
        keys = cell.column("key").to_pylist()
        if len(set(keys)) < len(keys):  # a repeated row brought its class twice
            cell = cell.take(pa.array([k for k, x in enumerate(keys) if x not in keys[:k]]))
            keys = cell.column("key").to_pylist()
        if len(keys) < 2:
            return []
        near = _pairs(cell, estimate)
        pairs = np.argwhere(np.triu(near))
        if not len(pairs):
            return []
        sets = [np.frombuffer(x, dtype=np.uint64) for x in cell.column("grams").to_pylist()]
        size = np.array([len(s) for s in sets])
        both = shared_counts(sets, pairs)
        good = pairs[both >= threshold * (size[pairs[:, 0]] + size[pairs[:, 1]] - both) - 1e-9]
        if not len(good):
            return []
        near[:] = False
        near[good[:, 0], good[:, 1]] = near[good[:, 1], good[:, 0]] = True
        others = near @ cell.column("copies").to_numpy()
        out = [(keys[k], int(others[k]), None, None) for k in np.flatnonzero(near.any(axis=1))]
        out += [(None, None, keys[a], keys[b]) for a, b in forest(near)]
        return [pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)]

    return compare
