"""Encoders against the libraries, at every cut."""

import random

import public_tokenizers as P
import pytest

from tagloom.llm.bpe_tree import ByteBpe, round_trip
from tagloom.llm.prefix_tokens import PrefixCounter, fits_of, prefix_tokens, tokens_of

BYTE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "'s", "'re", "'", "a", "b", "é", "ß", "日", "本", "1", "23", "!!", "\n", "\t", "\xa0", "<|endoftext|>",
         "<|endof", "text|>", "the", "ing", "▁", "🙂", "\x1c", "\x00", "<s>", "<unk>", "'ll", "l", "　"]


def texts(n, seed):
    r = random.Random(seed)
    for _ in range(n):
        of = PARTS if r.random() < 0.6 else [r.choice(PARTS) for _ in range(3)]
        yield "".join(r.choices(of, k=r.randint(0, 60)))


@pytest.mark.parametrize("leaf", [4, 16, 50])
def test_tree_concatenation_is_exact(leaf):
    bpe = ByteBpe(BYTE, leaf)
    for text in texts(400, leaf):
        want = bpe.whole(text)
        assert bpe.tree(text) == want
        assert bpe.encode(text) == want
        assert bpe.decode(want) == bpe.library.decode(want, skip_special_tokens=False)


def test_join_of_any_two_parts():
    bpe = ByteBpe(BYTE)
    r = random.Random(5)
    for text in texts(300, 9):
        at = r.randint(0, len(text))
        assert bpe.join(bpe.whole(text[:at]), bpe.whole(text[at:]), window=1) == bpe.whole(text)


def test_decode_of_broken_bytes():
    bpe = ByteBpe(BYTE)
    ids = bpe.whole("日🙂é")
    for a in range(len(ids)):
        assert bpe.decode(ids[a:]) == bpe.library.decode(ids[a:], skip_special_tokens=False)


def test_prefix_counts_equal_library_at_every_prefix():
    counter = PrefixCounter(PIECE)
    for text in texts(150, 3):
        table = counter.table(text)
        assert len(table) == len(text)
        assert [int(x) for x in table] == [len(counter.model.encode(text[:k])) for k in range(1, len(text) + 1)]


def test_round_trip_of_odd_rows(spark, odd, none):
    bpe = ByteBpe(BYTE)
    long = "Der Text " + "straßen" * 3000 + " <|endoftext|> it's " + " " * 50 + "x"
    # many copies of one long text, with one id and with none
    more = [(20, long), (20, long), (20, long + "y")] + [(None, long)] * 50
    docs = odd.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = round_trip(docs, BYTE, leaf_chars=64, long_chars=1000).collect()
    want = [(r.doc_id, bpe.whole(r.text or ""), r.text or "") for r in docs.collect()]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.ids, r.decoded)) for r in got)
    assert round_trip(none, BYTE).collect() == []


def test_prefix_tokens_of_odd_rows(spark, odd, none):
    counter = PrefixCounter(PIECE)
    got = prefix_tokens(odd, PIECE).select("doc_id", "n_bytes", tokens_of("prefix_tokens").alias("n"),
                                           tokens_of("prefix_tokens", 7).alias("seven"), fits_of("prefix_tokens", 3).alias("fits"))
    want = []
    for r in odd.collect():
        text = r.text or ""
        counts = [len(counter.model.encode(text[:k])) for k in range(len(text) + 1)] if len(text) < 100 else None
        fits = max(k for k, n in enumerate(counts) if n <= 3) if counts else None
        want.append((r.doc_id, len(text.encode()), len(counter.model.encode(text)), len(counter.model.encode(text[:7])), fits))
    have = [(r.doc_id, r.n_bytes, r.n, r.seven, r.fits) for r in got.collect()]
    drop = lambda rows, full: sorted(repr(x if x[4] is not None and full else x[:4]) for x in rows)
    assert drop(want, False) == drop(have, False)
    known = {(w[0], w[1], w[2]): w[4] for w in want if w[4] is not None}
    assert all(known.get((h[0], h[1], h[2]), h[4]) == h[4] for h in have)
    assert prefix_tokens(none, PIECE).collect() == []


def test_token_query_counts(spark):
    from tagloom.llm.queries import op8_token_counts, op9_bpe_round_trip
    import hashlib
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    model, bpe = PrefixCounter(PIECE).model, ByteBpe(BYTE)
    got = op8_token_counts(spark, sf).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        (d, len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 4096) for d, t in docs.items()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = op9_bpe_round_trip(spark, sf).collect()
    want = set()
    for d, t in docs.items():
        ids = bpe.whole(t)
        want.add((d, len(ids), sha(",".join(map(str, ids))), sha(bpe.library.decode(ids, skip_special_tokens=False))))
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
