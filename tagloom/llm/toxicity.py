"""Toxicity by a weighted finite-state pattern grammar.

A text is read clause by clause as a string of token classes: insult cues,
threats, targets, negations, marks of reported speech, other words. Five small
transducers rewrite that string one after the other: a cue after a negation
becomes a negated one, after a reporting verb or a quotation mark a reported
one, near a target an aimed one, and a threat near a target an uttered one.
They are composed into one transition table. What comes out of the matched
clauses is summed per kind and scored by a logistic function; clauses without
a cue or a threat add nothing.

The insult cues (words and word stems, with log-odds weights) and the
function's coefficients are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import release, written

#: Labelled rows that the model is fitted on, at most: toxic, clean.
SAMPLE_ROWS = (2000, 8000)
LEXICON = 2000
#: Lengths of stems; rows a cue needs; the most its share of clean rows may be
#: of its share of toxic ones; the chance that a cue falls on toxic rows so by
#: accident, counted over all rows, or over toxic rows without another cue.
STEM, MIN_DOCS, IMPURE, CHANCE, CHANCE_LEFT = (4, 5, 6, 7), 3, 0.05, 1e-5, 5e-4
FOLDS, HELD_OUT = 5, 0
#: Min-hashes of a sample row, and the share of them that makes it no new text.
MARKS, COPY = 64, 0.2

#: Verbs of harm by language, the letters that their dictionary form ends in,
#: and the endings that replace these (fixed values).
VERBS = {
    "en": ("kill hurt destroy murder beat shoot stab strangle burn crush smash punch", ("e", ""), ("", "e", "s", "es", "ed", "ing", "er")),
    "de": ("töten umbringen schlagen verletzen vernichten verprügeln", ("en", "n"), ("en", "e", "st", "t", "est", "et", "te", "ten", "n")),
    "fr": ("tuer frapper détruire blesser écraser", ("er", "re"), ("er", "re", "e", "es", "ent", "ons", "ez", "é", "erai", "era", "is", "it", "rai")),
    "es": ("matar golpear destruir herir quemar aplastar", ("ar", "ir"), ("ar", "ir", "o", "a", "as", "an", "amos", "ado", "aré", "ará", "iré", "irá")),
}


def inflected(verb: str, off: tuple[str, ...], endings: tuple[str, ...]) -> set[str]:
    """Forms of a verb: its stem with every ending; a short stem's last
    consonant may be doubled."""
    stem = next((verb[:len(verb) - len(x)] for x in off if x and verb.endswith(x)), verb)
    stems = {stem, stem + stem[-1]} if len(stem) <= 4 and "" in endings and stem[-1] not in "aeiouy" else {stem}
    return {verb} | {s + e for s in stems for e in endings if len(s + e) >= 3}


THREATS = frozenset(f for verbs, off, endings in VERBS.values() for v in verbs.split() for f in inflected(v, off, endings))
#: Word lists of the grammar (fixed values), English, German, French, Spanish.
TARGETS = frozenset("""you your yours yourself he him his she her they them their u du dich dir dein deine ihr euch euer sie er
tu te toi ton ta tes vous votre vos il elle ils eux usted ustedes tú ti tus él ella ellos""".split())
NEGATIONS = frozenset("""not no never neither nor without cannot nicht kein keine keinen nie niemals weder ohne
pas ne jamais aucun sans non nunca jamás tampoco sin ningún""".split())
REPORTS = frozenset("""said says say saying wrote writes called calls claimed claims reported quoted quote alleged
sagte sagt schrieb nannte behauptet zitiert dit disait écrit appelé affirme cité dijo dice escribió llamó afirma citó""".split())

#: The grammar's word lists: threats, targets, negations, reports.
WORDS = (THREATS, TARGETS, NEGATIONS, REPORTS)

SYMBOLS = ("other", "insult", "threat", "target", "negation", "report",
           "insult-", "insult'", "insult@", "threat-", "threat'", "threat!")
#: What a clause adds to: plain, negated, reported and aimed cues, uttered threats.
KINDS = {"insult": 0, "insult-": 1, "insult'": 2, "insult@": 3, "threat!": 4}
#: Coefficients before the data speak, and how firmly they are held.
PRIOR, FIRM = np.array([-3.0, 1.5, 0.5, 0.5, 2.0, 2.0]), 0.02
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"“”«»„]")
_CLAUSE = re.compile(r"[.,;:!?\n]")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``step(state, symbol) -> (state, symbol out)``."""

    start: object
    step: object


def _within(span: int, opens: frozenset, rewrite: dict) -> Transducer:
    """Symbols of ``rewrite`` change in the ``span`` tokens after ``opens``."""
    def step(left, symbol):
        out = rewrite.get(symbol, symbol) if left else symbol
        return (span if symbol in opens else max(0, left - 1)), out
    return Transducer(0, step)


NEGATION = _within(3, frozenset({"negation"}), {"insult": "insult-", "threat": "threat-"})
REPORTED = _within(99, frozenset({"report"}), {"insult": "insult'", "insult-": "insult'", "threat": "threat'", "threat-": "threat'"})
AIMED = _within(5, frozenset({"target"}), {"insult": "insult@"})
UTTERED = _within(3, frozenset({"target"}), {"threat": "threat!"})
#: The same towards the clause's end: a target after the threat.
ANSWERED = _within(4, frozenset({"threat"}), {"target": "threat!"})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds what ``first`` writes to ``second``."""
    def step(state, symbol):
        a, mid = first.step(state[0], symbol)
        b, out = second.step(state[1], mid)
        return (a, b), out
    return Transducer((first.start, second.start), step)


def compiled(t: Transducer, symbols=SYMBOLS[:6]) -> tuple[np.ndarray, np.ndarray]:
    """Arrays over reachable states: next state and output symbol."""
    known, order, rows, outs = {t.start: 0}, [t.start], [], []
    for here in order:
        row, out = [], []
        for symbol in symbols:
            to, written = t.step(here, symbol)
            if to not in known:
                known[to] = len(order)
                order.append(to)
            row.append(known[to])
            out.append(SYMBOLS.index(written))
        rows.append(row)
        outs.append(out)
    return np.array(rows), np.array(outs)


def grammar() -> tuple[list, list]:
    """All five transducers as one table (next states, output symbols)."""
    whole = NEGATION
    for t in (REPORTED, AIMED, ANSWERED, UTTERED):
        whole = compose(whole, t)
    table, out = compiled(whole)
    return table.tolist(), out.tolist()


@dataclass
class ToxicModel:
    """Cue weights (a stem ends in ``*``), the score's coefficients, and the
    grammar's word lists."""

    cues: dict[str, float] = field(default_factory=dict)
    coefficients: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    words: tuple = WORDS

    def __post_init__(self):
        self.ready = False

    def __getstate__(self):
        return {"cues": self.cues, "coefficients": self.coefficients, "words": self.words, "ready": False}

    def _prepare(self):
        import ahocorasick

        self.table, self.out = grammar()
        self.finder = ahocorasick.Automaton()
        self.triggers: dict[str, float] = dict.fromkeys(self.words[0], 0.0) | self.cues
        for cue in self.triggers:
            self.finder.add_word(cue.rstrip("*"), cue)
        if len(self.finder):
            self.finder.make_automaton()
        self.stems = {c[:-1]: w for c, w in self.cues.items() if c.endswith("*")}
        self.lengths = sorted({len(s) for s in self.stems})
        self.ready = True

    def _classes(self, word: str) -> tuple[int, float]:
        weight = self.cues.get(word)
        if weight is None:
            weight = next((self.stems[word[:n]] for n in self.lengths if word[:n] in self.stems), None)
        if weight is not None:
            return 1, weight
        for k in (2, 3, 4):
            if word in self.words[k - 2]:
                return k, 0.0
        if word.endswith(("n't", "n’t")):
            return 4, 0.0
        return (5, 0.0) if word in self.words[3] or not word[0].isalpha() else (0, 0.0)

    def evidence(self, text: str) -> np.ndarray:
        """Sums per kind over the matched clauses of a text."""
        if not self.ready:
            self._prepare()
        sums = np.zeros(len(KINDS))
        low = text.lower()
        done = 0
        for last, cue in self.finder.iter(low) if len(self.finder) else ():
            first = last + 1 - len(cue.rstrip("*"))
            if first < done or first and low[first - 1].isalpha():
                continue
            if cue[-1] != "*" and last + 1 < len(low) and low[last + 1].isalpha():
                continue
            start = done
            for m in _CLAUSE.finditer(low, max(done, first - 400), first):
                start = m.end()
            if start == done and first - 400 > done:
                start = max((low.rfind(c, done, first) for c in ".,;:!?\n"), default=-1) + 1 or done
            end = _CLAUSE.search(low, first)
            done = end.start() if end else len(low)
            state = 0
            for token in _WORD.findall(low, start, done):
                kind, weight = self._classes(token)
                symbol = SYMBOLS[self.out[state][kind]]
                state = self.table[state][kind]
                if symbol in KINDS:
                    sums[KINDS[symbol]] += weight or 1.0
        return np.log1p(sums)

    def score(self, text: str | None) -> float:
        z = float(self.coefficients[0] + self.coefficients[1:] @ self.evidence(text or ""))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fold(doc_id: Column | str = "doc_id", folds: int = FOLDS) -> Column:
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds


def _without_copies(sample: DataFrame) -> DataFrame:
    """Copies of a text, near ones, and texts around one shared passage are no
    further evidence of its words: a row goes if its min-hashes of word triples
    agree with those of a kept row of its class in a share of COPY, which
    estimates how much they share. Only the hashes of the bounded sample reach
    the driver."""
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("toxic", pa.int32()), ("least", pa.list_(pa.int64()))])
    factors = np.random.default_rng(1).integers(1, 2**31, MARKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def hashes(batches):
        release()
        for batch in batches:
            least, rows = [], []
            for text in batch.column("text"):
                words = text.as_py().lower().split()
                triples = np.array([zlib.crc32(" ".join(words[k:k + 3]).encode()) for k in range(max(1, len(words) - 2))], dtype=np.uint64)
                marks = np.full(MARKS, 2**32, dtype=np.uint64)
                for at in range(0, len(triples), 4096):     # long texts in slices
                    marks = np.minimum(marks, ((triples[at:at + 4096, None] * factors) & np.uint64(0xFFFFFFFF)).min(axis=0))
                least.append(marks.astype(np.int64).tolist())
                rows.append(zlib.crc32(text.as_py().encode()))
            yield pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.int64()), batch.column("toxic"), pa.array(least, schema.field(3).type)], schema=schema)

    kept, holders = [], {}
    found = sample.select("doc_id", "text", "toxic").mapInArrow(hashes, "doc_id long, row long, toxic int, least array<long>").collect()
    for r in sorted(found):
        agree = Counter(k for mark in enumerate(r.least) for k in holders.get((r.toxic, *mark), ()))
        if agree and max(agree.values()) >= COPY * MARKS:
            continue
        for mark in enumerate(r.least):
            holders.setdefault((r.toxic, *mark), []).append(len(kept))
        kept.append((r.doc_id, r.row, r.toxic))
    kept = sample.sparkSession.createDataFrame(kept, "doc_id long, row long, toxic int")
    return sample.withColumn("row", F.crc32(F.col("text").cast("binary"))).join(
        F.broadcast(kept.distinct()), ["doc_id", "row", "toxic"]).select("doc_id", "text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, sample_rows: tuple[int, int] = SAMPLE_ROWS, words: tuple = WORDS) -> ToxicModel:
    """Fit on at most ``sample_rows`` labelled rows (toxic, clean), those with the
    least hash of doc_id (then of the text), leaving out the held-out fold.

    Labels other than 0 and 1 and null ids or texts are not used; repeated
    labels and repeated rows count once. Without rows of both classes the model
    is the grammar alone, with no cues.
    """
    usable = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != HELD_OUT)).distinct()
    most = F.when(F.col("toxic") == 1, sample_rows[0]).otherwise(sample_rows[1])

    def first(rows: DataFrame, *order) -> DataFrame:
        """At most so many rows of each class; the limit is applied within each
        partition first."""
        place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", *order))
        return rows.withColumn("n", place).where((F.col("n") <= max(sample_rows)) & (F.col("n") <= most)).drop("n")

    # ids only, few and small; several texts may share one
    sample = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null").join(F.broadcast(first(usable)), "doc_id")
    sample = written(first(sample.dropDuplicates(["doc_id", "toxic", "text"]), F.xxhash64("text")), "labelled-texts")
    sample = written(_without_copies(sample), "labelled-originals")

    def terms(batches):
        schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
        counts = (Counter(), Counter())

        def flush():
            every = list(counts[0].keys() | counts[1].keys())
            batch = pa.record_batch([pa.array(every, pa.string()), *(pa.array([c[t] for t in every], pa.int64()) for c in counts[::-1])], schema=schema)
            for c in counts:
                c.clear()
            return batch

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = {w for w in _WORD.findall(text.as_py().lower()) if w[0].isalpha()}
                counts[label].update(words | {w[:n] + "*" for w in words for n in STEM if len(w) >= n} | {""})
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield flush()
        yield flush()

    counted = sample.select("text", "toxic").mapInArrow(terms, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    top = counted.where((F.col("term") == "") | ((F.col("toxic") >= MIN_DOCS) & (F.col("clean") * 5 <= F.col("toxic")))).orderBy(
        F.col("term") != "", F.col("toxic").desc(), "term").limit(LEXICON * len(STEM)).collect()
    size = next(((r.toxic, r.clean) for r in top if not r.term), (0, 0))
    if not min(size):
        return ToxicModel(words=words)
    counts = {r.term: (r.toxic, r.clean) for r in top if r.term}
    counts = {t: c for t, c in counts.items() if _chance(*c, *size) <= CHANCE_LEFT and (c[1] + 0.3) / size[1] <= IMPURE * c[0] / size[0]}

    def holding(batches):
        schema = pa.schema([("terms", pa.list_(pa.string()))])
        for batch in batches:
            found = []
            for text in batch.column("text"):
                words = set(_WORD.findall(text.as_py().lower()))
                found.append(sorted(t for t in words | {w[:n] + "*" for w in words for n in STEM if len(w) >= n} if t in counts))
            yield pa.record_batch([pa.array(found, schema.field(0).type)], schema=schema)

    held = sample.where("toxic = 1").select("text").mapInArrow(holding, "terms array<string>").collect()
    model = ToxicModel(_lexicon(counts, sorted(r.terms for r in held), *size), words=words)

    def evidence(batches):
        schema = pa.schema([("toxic", pa.int32()), ("x", pa.list_(pa.float64()))])
        for batch in batches:
            x = [model.evidence(t.as_py()).tolist() for t in batch.column("text")]
            yield pa.record_batch([batch.column("toxic"), pa.array(x, schema.field(1).type)], schema=schema)

    rows = sample.select("text", "toxic").mapInArrow(evidence, "toxic int, x array<double>").groupBy("toxic", "x").count().collect()
    rows.sort(key=lambda r: (r.toxic, r.x))
    model.coefficients = _fit(np.array([r.x for r in rows]), np.array([r.toxic for r in rows], dtype=float),
                              np.array([r["count"] for r in rows], dtype=float))
    return model


def _chance(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Chance that of as many rows at least ``toxic`` are toxic ones."""
    n, share = toxic + clean, n_toxic / (n_toxic + n_clean)
    return sum(math.comb(n, k) * share**k * (1 - share) ** (n - k) for k in range(toxic, n + 1))


def _lexicon(counts: dict[str, tuple[int, int]], rows: list[list[str]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Words and stems that toxic rows hold far more often than clean ones.

    First those that could not by accident: the shortest stems, then words
    that no stem covers. Then, for toxic rows that hold none of these, the
    terms most of them share.
    """
    chosen: dict[str, float] = {}

    def covered(term):
        word = term.rstrip("*")
        return any(word[:n] + "*" in chosen for n in STEM if n <= len(word))

    def take(term):
        a, b = counts[term]
        chosen[term] = float(np.log((a + 0.3) / n_toxic) - np.log((b + 0.3) / n_clean))

    firm = sorted((t for t in counts if _chance(*counts[t], n_toxic, n_clean) <= CHANCE),
                  key=lambda t: (not t.endswith("*"), len(t), -counts[t][0], t))
    for term in firm:
        a, b = counts[term]
        # a longer one that says the same with fewer clean rows is better
        if not covered(term) and not (b and any(
                t != term and t.startswith(term.rstrip("*")) and counts[t][1] < b and counts[t][0] >= 0.8 * a for t in firm)):
            take(term)
    left = [r for r in rows if not any(t in chosen or covered(t) for t in r)]
    while left and len(chosen) < LEXICON:
        support = Counter(t for r in left for t in r)
        term = max(sorted(support, key=lambda t: (len(t), t)), key=support.get, default=None)
        if term is None or support[term] < MIN_DOCS or _chance(support[term], counts[term][1], n_toxic, n_clean) > CHANCE_LEFT:
            break
        take(term)
        left = [r for r in left if term not in r]
    return chosen


def _fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, held towards PRIOR; classes weigh
    alike."""
    x = np.column_stack([np.ones(len(x)), x])
    weight = n * np.where(y == 1, n.sum() / max(n[y == 1].sum(), 1), n.sum() / max(n[y == 0].sum(), 1)) / 2
    c = PRIOR.copy()
    hold = FIRM * weight.sum() * 0.05
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + hold * (c - PRIOR)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + hold * np.eye(len(c))
        step = np.linalg.solve(curve, gradient)
        c = c - step
        if np.abs(step).max() < 1e-10:
            break
    return c


def toxic_score(model: ToxicModel, text: Column | str = "text") -> Column:
    """Score of a text column, 0 to 1; null counts as empty."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        release()
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: tuple[int, int] = SAMPLE_ROWS, words: tuple = WORDS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts get the score of no evidence; a null doc_id is not
    held out. Repeated rows are scored each; a document labelled both 0 and 1
    is a row of both classes. Texts of any length are read whole. No rows give
    no rows; other columns are ignored.
    """
    model = learn(docs, labels, sample_rows, words)
    scored = docs.select(F.col("doc_id").cast("long"), F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"),
                         toxic_score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
