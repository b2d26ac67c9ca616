"""Language and toxicity: held-out accuracy, odd rows, the grammar."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tagloom.llm.language_id import gram_counts, identify
from tagloom.llm.toxicity import (AIMED, ANSWERED, KINDS, NEGATION, REPORTED, SYMBOLS, UTTERED, WORDS, ToxicModel, compiled, compose, grammar,
                                  toxicity)

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.rejected for r in got]) < 0.1


def test_language_does_not_depend_on_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit("xx")).otherwise(F.col("lang")))
    key = lambda d: sorted(map(tuple, identify(d).select("doc_id", "lang_pred", "score").collect()))
    assert key(docs) == key(other)


def test_language_of_odd_rows(odd, none):
    got = identify(odd).collect()
    assert len(got) == odd.count()
    text = {(r.doc_id, r.text) for r in odd.collect()}
    for r in got:
        texts = [t for d, t in text if d == r.doc_id]
        if all(not t or not any(c.isalpha() for c in t) for t in texts):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert identify(none).collect() == []
    assert gram_counts(None) is None and gram_counts("12 !?") is None and gram_counts("日").sum() > 0


TABLE, OUT = grammar()


def run(words):
    table, out = TABLE, OUT
    state, symbols = 0, []
    for w in words:
        k = SYMBOLS.index(w)
        symbols.append(SYMBOLS[out[state][k]])
        state = table[state][k]
    return symbols


def test_grammar_rewrites_by_context():
    assert run(["insult"]) == ["insult"]
    assert run(["negation", "insult"])[-1] == "insult-"
    assert run(["negation", "other", "other", "other", "insult"])[-1] == "insult"
    assert run(["report", "other", "insult"])[-1] == "insult'"
    assert run(["target", "other", "insult"])[-1] == "insult@"
    assert run(["threat", "other", "target"])[-1] == "threat!"
    assert run(["target", "threat"])[-1] == "threat!"
    assert run(["negation", "threat", "target"])[-1] == "target"


def feed(transducer, symbols):
    state, out = transducer.start, []
    for x in symbols:
        state, y = transducer.step(state, x)
        out.append(y)
    return out


def test_composed_table_equals_feeding_one_to_the_next():
    """Brute force: the five transducers one after another, over all short
    clauses and many long ones."""
    import itertools
    import random
    chain = (NEGATION, REPORTED, AIMED, ANSWERED, UTTERED)

    def by_hand(symbols):
        for t in chain:
            symbols = feed(t, symbols)
        return symbols

    words = SYMBOLS[:6]
    for n in range(5):
        for clause in itertools.product(words, repeat=n):
            assert run(clause) == by_hand(list(clause))
    r = random.Random(6)
    for _ in range(500):
        clause = r.choices(words, k=r.randint(5, 40))
        assert run(clause) == by_hand(clause)
    table, out = compiled(compose(NEGATION, REPORTED))
    for _ in range(200):
        clause, state, got = r.choices(words, k=20), 0, []
        for w in clause:
            k = words.index(w)
            got.append(SYMBOLS[out[state][k]])
            state = int(table[state][k])
        assert got == feed(REPORTED, feed(NEGATION, clause))


def test_inflected_and_aimed_threats():
    model = ToxicModel()
    for text in ("I am killing you", "they stabbed him", "ich verletze dich", "je vais te frapper", "voy a matarte, te mato", "he shoots them", "she punches you"):
        assert model.score(text) > model.score(""), text
    for text in ("killing time", "the burning house", "he said they killed him", "I would never hurt you"):
        assert model.evidence(text)[KINDS["threat!"]] == 0, text


def test_the_grammar_decides_where_words_do_not(spark):
    """Clean texts that deny or report the insults that toxic ones aim: without
    its word lists the grammar cannot tell them apart."""
    import random
    r = random.Random(4)
    insults = ["moron", "idiot", "scum", "loser"]

    def prose():
        return " ".join("".join(r.choices("abdeghilnorstu", k=r.randint(3, 8))) for _ in range(12))

    def text(kind):
        x = r.choice(insults)
        middle = {"toxic": f"you {x}", "denied": f"not {x} ering", "reported": f"said onha {x}", "clean": "you said not onha"}[kind]
        return f"{prose()}. {middle}. {prose()}."

    kinds = ["toxic"] * 300 + ["denied", "reported"] * 12 + ["clean"] * 1476
    rows = [(k, text(kind), int(kind == "toxic")) for k, kind in enumerate(kinds)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")

    def auc(words):
        truth = {x[0]: x[2] for x in rows}
        got = [(truth[x.doc_id], x.score) for x in toxicity(docs, labels, words=words).collect() if x.held_out]
        pos, neg = ([s for t, s in got if t == k] for k in (1, 0))
        return np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])

    whole = auc(WORDS)
    assert whole > 0.9999 and auc((frozenset(),) * 4) < whole - 0.002


def test_rows_that_share_an_id(spark):
    """One id on every row, in several languages and with both labels: a row
    is learned as its own lang and label say."""
    r = np.random.default_rng(3)
    words = {"aa": ["kala", "mano", "tuli"], "bb": ["strum", "plotz", "gritz"]}
    rows = [(1, " ".join(r.choice(words[lang], 20)), lang, k % 2) for k in range(300) for lang in ("aa", "bb")] + [(1, "kala " * 5, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    assert len(identify(docs).collect()) == 601
    pred = {x.lang_pred for x in identify(docs.where("lang = 'bb'").unionByName(docs.where("lang is null"))).collect()}
    assert pred == {"bb"}
    from tagloom.llm.language_id import learn
    assert learn(docs, sample_rows=40).languages == ["aa", "bb"]
    model = learn(docs, sample_rows=40)
    assert model.predict("strum gritz plotz")[0] == "bb" and model.predict("mano tuli kala")[0] == "aa"
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, 1)], "doc_id long, toxic int")
    assert toxicity(docs, labels, (20, 20)).count() == 601


def test_clauses_not_words_are_scored():
    model = ToxicModel({"moron": 5.0, "lowe*": 5.0})
    plain, negated, reported, aimed = (model.evidence(t) for t in ("A moron.", "Not a moron.", "He said: x. She wrote moron", "You moron!"))
    assert plain[0] > 0 and negated[1] > 0 and reported[2] > 0 and aimed[3] > 0
    assert model.score("You moron!") > model.score("Not a moron.") > model.score("")
    assert not model.evidence("morons oxymoron").any()
    assert model.evidence("Das loweischaft.")[0] > 0
    assert model.score(None) == model.score("") < 0.5
    long = "word " * 50000 + "moron"
    assert model.evidence(long)[0] > 0


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert {r.doc_id for r in got if r.held_out} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    known = [(truth[r.doc_id], r.score, r.predicted) for r in got if r.doc_id in truth]
    clean = [p for t, _, p in known if t == 0]
    assert np.mean(clean) <= 0.01
    # a table this small teaches the frequent cues only: five kinds of texts in fifty
    assert np.mean([p for t, _, p in known if t == 1]) >= 0.7
    assert all(r.predicted == int(r.score >= 0.5) for r in got)


def test_toxicity_without_labels_and_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (1, 1)], "doc_id long, toxic int")
    for docs, marks in ((odd, labels), (odd, labels.limit(0)), (none, labels)):
        got = toxicity(docs, marks).collect()
        assert len(got) == docs.count()
        assert all(0 <= r.score <= 1 for r in got)


def grams_by_hand(text):
    """Counts of hashed 1- to 3-grams of letters, one blank for what is none."""
    from tagloom.llm.language_id import _FACTORS, BUCKETS
    if not any(c.isalpha() for c in text.lower()):
        return None
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    x = " " + letters[:1].replace(" ", " ") + "".join(b for a, b in zip(letters, letters[1:]) if b != " " or a != " ") + " "
    counts, mask = [0] * BUCKETS, 0xFFFFFFFF
    for n in (1, 2, 3):
        for at in range(len(x) - n + 1):
            h = n * 97
            for k in range(n):
                h = (h ^ (ord(x[at + k]) * int(_FACTORS[k]) & mask)) * 2654435769 & mask
                h ^= h >> 15
            counts[h % BUCKETS] += 1
    return counts


def test_language_against_plain_nearest_centroid(spark):
    """Every prediction again without arrays: hashed grams, TF-IDF, cosines."""
    import math
    import random

    from tagloom.llm.language_id import learn
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = learn(docs, sample_rows=30)
    centroids = [list(map(float, c)) for c in model.centroids]
    r = random.Random(2)
    texts = [t[:400] for (t,) in docs.select("text").limit(25).collect()]
    texts += ["".join(r.choices("aéß日 1.\nÄ'", k=r.randint(0, 30))) for _ in range(60)] + ["", " ", "  a  b "]
    for text in texts:
        counts = grams_by_hand(text)
        got = gram_counts(text)
        assert (counts is None) == (got is None) and (got is None or got.tolist() == counts)
        if counts is None:
            assert model.predict(text) == ("und", 0.0, True)
            continue
        x = {k: math.log1p(c) * float(model.idf[k]) for k, c in enumerate(counts) if c}
        norm = math.sqrt(sum(v * v for v in x.values()))
        near = [sum(v * c[k] for k, v in x.items()) / norm for c in centroids]
        best = max(range(len(near)), key=lambda k: (near[k], -k))
        lang, score, rejected = model.predict(text)
        assert abs(score - min(1, max(0, near[best]))) < 1e-9
        if sorted(near)[-1] - sorted(near)[-2] > 1e-9:
            assert lang == model.languages[model.owner[best]] and rejected == bool(near[best] < model.floor[best])


def test_evidence_against_plain_clauses():
    """Brute force: every clause, every word, one transducer after another."""
    import math
    import random
    import re

    from tagloom.llm.toxicity import _WORD
    model = ToxicModel({"moron": 2.5, "lowe*": 1.5, "idiot": 3.0})
    model.evidence("")
    r = random.Random(11)
    words = ["moron", "Moron", "moron's", "loweisch", "idiots", "idiot", "kill", "killing", "you", "He", "them", "not", "never", "didn't", "said", '"',
             "the", "a", "of", ".", ",", "!", "\n", ";", "x1", "_", "日本", "é"]
    for _ in range(1500):
        text = " ".join(r.choices(words, k=r.randint(0, 40)))
        text = text.replace(" .", ".") if r.random() < 0.5 else text
        sums = [0.0] * len(KINDS)
        for clause in re.split(r"[.,;:!?\n]", text.lower()):
            classes = [model._classes(w) for w in _WORD.findall(clause)]
            symbols = [SYMBOLS[k] for k, _ in classes]
            for t in (NEGATION, REPORTED, AIMED, ANSWERED, UTTERED):
                symbols = feed(t, symbols)
            for symbol, (_, weight) in zip(symbols, classes):
                if symbol in KINDS:
                    sums[KINDS[symbol]] += weight or 1.0
        assert np.allclose(model.evidence(text), [math.log1p(x) for x in sums]), text
