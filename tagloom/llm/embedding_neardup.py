"""Embedding near-dedup by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions, shifted and cut into
steps of WIDTH; several such integers name a bucket, in each of several tables.
Vectors at cosine 0.98 lie 0.2 apart and share one step with probability 0.92,
unrelated ones with 0.49. The integers per name grow with the logarithm of the
number of vectors, so that unrelated vectors rarely meet at any size, and the
tables with them, so that a pair at the threshold is missed in all tables with
probability MISS, closer pairs with less. Vectors that share a bucket are
compared exactly, in double precision.

Equal vectors form one class first, so copies cost nothing. A pair is counted
in the first table that holds it in one bucket, which both rows' bucket names
tell, so pairs are never gathered to remove repeats. Buckets of any size are
compared in bounded cells.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.cells import over_cells, to_cells
from tagloom.llm.common import likely, written
from tagloom.llm.components import forest, linked_rows

THRESHOLD = 0.98
WIDTH, SEED = 2.0, 7
#: Unrelated vectors expected in a vector's bucket; a pair's chance to be missed.
STRANGERS, MISS = 0.125, 1e-4
BLOCK_ROWS = 512
#: Low bits of a bucket's 64-bit name that tell its table.
TABLE_BITS = 12


def step_chance(distance: float, width: float) -> float:
    """Probability that two vectors at a distance share one quantised step."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def table_plan(n: int, threshold: float, width: float = WIDTH, strangers: float = STRANGERS, miss: float = MISS) -> tuple[int, int]:
    """Integers per bucket name and tables for n vectors."""
    near, far = step_chance(math.sqrt(2 - 2 * threshold), width), step_chance(math.sqrt(2), width)
    hashes = max(1, math.ceil(math.log(max(n, 2) / strangers) / -math.log(far)))
    tables = math.ceil(math.log(miss) / math.log1p(-(near ** hashes)))
    if tables > 1 << TABLE_BITS:
        raise ValueError(f"{tables} tables: the threshold is too low for these hashes")
    return hashes, tables


def bucket_names(x: np.ndarray, width: float, hashes: int, tables: int, seed: int) -> np.ndarray:
    """Bucket names (rows x tables, 64 bits) of normalised rows."""
    rng = np.random.default_rng((seed, x.shape[1]))
    directions = rng.standard_normal((x.shape[1], hashes * tables))
    shifts = rng.uniform(0, width, hashes * tables)
    steps = np.floor((x @ directions + shifts) / width).astype(np.int64).reshape(len(x), tables, hashes)
    mixers = rng.integers(1, 2**63, size=(tables, hashes), dtype=np.uint64) | np.uint64(1)
    names = (steps.astype(np.uint64) * mixers).sum(axis=2, dtype=np.uint64)
    names ^= names >> np.uint64(31)
    return (names * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, width: float = WIDTH, strangers: float = STRANGERS,
                 miss: float = MISS, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and their cosine is at least
    ``threshold``. A null label, a null, empty or zero vector, and one that
    holds a null or non-finite component link with nothing; vectors of
    different lengths do not link. Repeated rows link like other copies, each
    counted; a repeated vec_id has the component of its own row's vector. No
    rows give no rows; other columns are ignored. A null vec_id counts as the
    largest.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"),
                          F.col("embedding").cast(_kept_type(vectors)).alias("embedding"))
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
              & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
              & F.exists("embedding", lambda v: v != 0))
    keyed = written(_keyed(rows.where(F.coalesce(usable, F.lit(False)))), "vector-keys")
    classes = keyed.groupBy("key").agg(F.count("*").alias("copies"), F.first("label").alias("label"),
                                       F.first("embedding").alias("embedding"))
    classes = written(classes, "vector-classes")
    hashes, tables = table_plan(classes.count(), threshold, width, strangers, miss)
    named = written(_named(classes, width, hashes, tables, seed), "vector-buckets")
    # hashes of names go through the bucket count; vectors join only the buckets that are shared
    place = F.xxhash64("name", "label", "n")
    member = named.select("key", "label", F.size("embedding").alias("n"), F.posexplode("buckets").alias("t", "name")).select(
        "key", "t", F.shiftleft(place, TABLE_BITS).bitwiseOR(F.col("t").cast("long")).alias("bucket"))
    counts = written(member.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "bucket-sizes")
    shared = written(likely(member, "bucket", counts, "bucket").join(counts, "bucket"), "shared-buckets")
    # of the names those of the tables up to the bucket's own
    vectors_of = shared.join(named, "key").withColumn("buckets", F.slice("buckets", F.lit(1), F.col("t") + 1)).drop("t")
    cells = to_cells(vectors_of, "bucket", "members", F.xxhash64("key"), block_rows)
    found = written(over_cells(cells, _compare(threshold), "key binary, links long, a binary, b binary"), "vector-links")
    linked = linked_rows(keyed, "vec_id", found)
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone)


def _kept_type(vectors: DataFrame) -> str:
    """Single precision is moved as it is; comparisons are in double."""
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return "array<float>" if single else "array<double>"


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds ``key``: a 128-bit name of label and vector."""
    kind = rows.schema["embedding"].dataType.simpleString()
    number = pa.float32() if "float" in kind else pa.float64()
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("embedding", pa.list_(number)), ("key", pa.binary())])

    def name(batches):
        for batch in batches:
            keys = []
            for label, v in zip(batch.column(1).to_pylist(), batch.column(2)):
                x = v.values.to_numpy(zero_copy_only=False) + 0.0  # -0.0 is 0.0
                keys.append(hashlib.blake2b(x.tobytes(), digest_size=16, key=label.encode()[:64],
                                            person=hashlib.md5(label.encode()).digest()).digest())
            yield pa.record_batch([*batch.columns, pa.array(keys, pa.binary())], schema=schema)

    return rows.mapInArrow(name, f"vec_id long, label string, embedding {kind}, key binary")


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return (values.astype(np.float64) if values.dtype.kind == "f" else values).reshape(len(column), -1)


def _named(classes: DataFrame, width, hashes, tables, seed) -> DataFrame:
    """Adds ``buckets``: the vector's bucket name in each table."""
    kind = classes.schema["embedding"].dataType.simpleString()
    number = pa.float32() if "float" in kind else pa.float64()
    schema = pa.schema([("key", pa.binary()), ("label", pa.string()), ("copies", pa.int64()),
                        ("embedding", pa.list_(number)), ("buckets", pa.list_(pa.int64()))])

    def name(batches):
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column("embedding")])
            out: list = [None] * batch.num_rows
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                x = _matrix(batch.column("embedding").take(pa.array(at)))
                # scaled first: huge or tiny components do not overflow the norm
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                for k, row in zip(at, bucket_names(x, width, hashes, tables, seed)):
                    out[k] = row
            yield pa.record_batch([*(batch.column(c) for c in schema.names[:-1]), pa.array(out, pa.list_(pa.int64()))], schema=schema)

    return classes.select(*schema.names[:-1]).mapInArrow(
        name, f"key binary, label string, copies long, embedding {kind}, buckets array<long>")


def _compare(threshold: float):
    schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])

    def compare(cell: pa.Table) -> list[pa.RecordBatch]:
        if cell.num_rows < 2:
            return []
        lengths = pc.list_value_length(cell.column("embedding").combine_chunks()).to_numpy()
        if lengths.min() != lengths.max():  # buckets that share only their 64-bit name
            return [b for k in np.unique(lengths) for b in compare(cell.filter(pa.array(lengths == k)))]
        first = cell.column("cell")[0].as_py()
        table, i, j = first["bucket"] & (1 << TABLE_BITS) - 1, first["i"], first["j"]
        x, buckets = _matrix(cell.column("embedding")), _matrix(cell.column("buckets"))
        copies = cell.column("copies").to_numpy()
        x = x / np.abs(x).max(axis=1, keepdims=True)
        norms = np.sqrt((x * x).sum(axis=1))
        near = (x @ x.T) / np.outer(norms, norms) >= threshold
        np.fill_diagonal(near, False)
        if i != j:  # pairs within a block belong to the block's own cell
            block = cell.column("block").to_numpy()
            near &= block[:, None] != block[None, :]
        labels = np.unique(np.array(cell.column("label").to_pylist(), dtype=object), return_inverse=True)[1]
        near &= (labels[:, None] == labels[None, :]) & (buckets[:, table][:, None] == buckets[:, table][None, :])
        for t in range(table):  # an earlier table holds the pair in one bucket: counted there
            if not near.any():
                return []
            near &= buckets[:, t][:, None] != buckets[:, t][None, :]
        rows = np.flatnonzero(near.any(axis=1))
        if not len(rows):
            return []
        keys = cell.column("key").to_pylist()
        links = [(keys[a], keys[b]) for a, b in forest(near)]
        others = near @ copies
        out = [(keys[k], int(others[k]), None, None) for k in rows] + [(None, None, a, b) for a, b in links]
        return [pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)]

    return compare
