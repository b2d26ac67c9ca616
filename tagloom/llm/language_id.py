"""Language identification by nearest centroids.

Texts are normalised TF-IDF vectors of letter 1- to 3-grams (hashed to
BUCKETS). Each language has several centroids, found by spherical k-means on a
bounded sample of labelled rows; a text gets the language of the centroid with
the largest cosine, and is marked as rejected if it lies further off than the
sample's own texts do from that centroid.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Labelled rows per language that the centroids are fitted on, at most.
SAMPLE_ROWS = 300
#: Languages that are learned, at most: the most frequent ones.
LANGUAGES = 500
BUCKETS, CENTROIDS, ROUNDS, SEED = 4096, 4, 12, 3
#: Share of a centroid's own sample that may lie beyond its radius.
BEYOND = 0.005
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
_FACTORS = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)


class _Letters:
    """Which code points are letters, as an array made once per process."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        return cls.table


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed letter n-grams; None if the text has no letter. What
    is no letter is a blank; a very long text counts like any other."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _Letters.get()[points]
    if not letter.any():
        return None
    # runs of blanks are one blank, and one stands at either end
    x = np.where(letter, points, np.uint32(32))
    x = x[letter | np.append(True, letter[:-1])]
    x = np.concatenate([[32], x, [32]]).astype(np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for n in (1, 2, 3):
        h = np.full(len(x) - n + 1, n * 97, dtype=np.uint32)
        for k in range(n):
            h = (h ^ (x[k:k + len(h)] * _FACTORS[k])) * np.uint32(2654435769)
            h ^= h >> np.uint32(15)
        counts += np.bincount((h % np.uint32(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floor: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-30)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine from 0 to 1, rejected)."""
        counts = gram_counts(text)
        if counts is None or not len(self.centroids):
            return UNKNOWN, 0.0, True
        near = self.centroids @ self.vectors(counts)
        k = int(near.argmax())
        return self.languages[self.owner[k]], float(np.clip(near[k], 0, 1)), bool(near[k] < self.floor[k])


def fold(folds: int = FOLDS):
    return F.crc32(F.col("doc_id").cast("string")) % folds


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS, seed: int = SEED) -> LanguageModel:
    """Fit on at most ``sample_rows`` rows per non-null lang, those with the
    least hash of doc_id (then of the text), leaving out the held-out fold; of
    more than LANGUAGES langs the most frequent are learned.

    The group limits are applied within each input partition before the
    shuffle, so a frequent language, or id, sends no more rows to a task than a
    rare one. Rows count as their own lang says, whatever id they share.
    """
    ids = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("learned")).where(
        F.col("learned").isNotNull() & (fold() != HELD_OUT))
    known = ids.groupBy("learned").agg(F.count("*").alias("rows")).orderBy(F.col("rows").desc(), "learned").limit(LANGUAGES)
    order = Window.partitionBy("learned").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.distinct().join(F.broadcast(known.select("learned")), "learned").withColumn(
        "n", F.row_number().over(order)).where(F.col("n") <= sample_rows).drop("n")
    sample = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("learned"), "text").join(
        F.broadcast(chosen), ["doc_id", "learned"])
    order = Window.partitionBy("learned").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    sample = sample.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample_rows)

    def count(batches):
        schema = pa.schema([("learned", pa.string()), ("doc_id", pa.int64()), ("counts", pa.binary())])
        for batch in batches:
            counts = [gram_counts(t.as_py()) for t in batch.column("text")]
            keep = pa.array([c is not None for c in counts])
            # 16 bits each: log counts of very long texts hardly differ beyond
            packed = [None if c is None else np.minimum(c, 65535).astype(np.uint16).tobytes() for c in counts]
            yield pa.record_batch([batch.column("learned"), batch.column("doc_id"), pa.array(packed, pa.binary())], schema=schema).filter(keep)

    rows = sample.select("learned", "doc_id", "text").mapInArrow(count, "learned string, doc_id long, counts binary").collect()
    rows = sorted(rows, key=lambda r: (r.learned, r.doc_id, bytes(r.counts)))
    return _fit(rows, centroids, seed)


def _fit(rows, centroids: int, seed: int) -> LanguageModel:
    languages = sorted({r.learned for r in rows})
    if not languages:
        return LanguageModel([], np.ones(BUCKETS), np.zeros((0, BUCKETS)), np.zeros(0, int), np.zeros(0))
    counts = np.array([np.frombuffer(r.counts, dtype=np.uint16) for r in rows])
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1
    model = LanguageModel(languages, idf, np.zeros((0, BUCKETS)), np.zeros(0, int), np.zeros(0))
    rng, found, owner, floor = np.random.default_rng(seed), [], [], []
    of = np.array([languages.index(r.learned) for r in rows])
    for k in range(len(languages)):
        x = model.vectors(counts[of == k].astype(np.float64))
        centre = x[rng.permutation(len(x))[:centroids]]
        for _ in range(ROUNDS):
            near = (x @ centre.T).argmax(axis=1)
            centre = np.array([x[near == c].mean(axis=0) if (near == c).any() else centre[c] for c in range(len(centre))])
            centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-30)
        cosine = x @ centre.T
        for c in range(len(centre)):
            own = cosine[cosine.argmax(axis=1) == c, c]
            found.append(centre[c])
            owner.append(k)
            floor.append(np.quantile(own, BEYOND) if len(own) else 1.0)
    model.centroids, model.owner, model.floor = np.array(found), np.array(owner), np.array(floor)
    return model


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    ``und`` with score 0 for null texts, texts without a letter, and all texts
    if nothing could be learned. ``rejected`` marks texts outside the nearest
    centroid's radius; they keep its language. A null doc_id is neither held
    out nor learned from. Repeated rows get a row each; of equally near
    centroids the first language in order wins. Texts of any length are read
    whole. No rows give no rows; other columns are ignored.
    """
    model = learn(docs, sample_rows, centroids, seed)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("rejected", pa.bool_())])

    def predict(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array([f[k] for f in found], schema.field(2 + k).type) for k in range(3))], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
