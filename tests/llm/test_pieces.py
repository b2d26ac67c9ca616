"""Vectorised merge rounds against the library."""

import hashlib
import random

import public_tokenizers as P
import pytest

from tagloom.llm.piece_rounds import PieceRounds, piece_round_trip

PIECE = P.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "'s", "'", "a", "b", "é", "ß", "日", "本", "1", "23", "!!", "\n", "\t", "\xa0", "<0x41>", "the", "ing", "▁",
         "🙂", "\x1c", "\x00", "<s>", "<unk>", "l", "　", "x", "xx", "----", "==", "    "]


@pytest.fixture(scope="module")
def rounds():
    return PieceRounds(PIECE)


def texts(n, seed, vocabulary):
    r = random.Random(seed)
    for _ in range(n):
        of = r.choice([PARTS, r.choices(PARTS, k=3), r.choices(vocabulary, k=20)])
        yield "".join(r.choices(of, k=r.randint(0, 60)))


# long words by neighbourhood, slices of few characters
@pytest.mark.parametrize("long_word,piece_chars", [(64, 1 << 19), (1, 40), (4, 7)])
def test_rounds_equal_library(rounds, long_word, piece_chars):
    rounds.long, rounds.slice = long_word, piece_chars
    vocabulary = [rounds.library.id_to_piece(i) for i in range(rounds.size)]
    some = [*texts(1500, long_word, vocabulary), ""]
    want = rounds.library.encode(some)
    assert [x.tolist() for x in rounds.encode_all(some)] == want
    assert [rounds.decode(x) for x in want] == [rounds.library.decode(x) for x in want]
    rounds.long, rounds.slice = 64, 1 << 19


@pytest.mark.parametrize("alphabet", ["x", "ab", "ACGT", "abcdefghijklmnopqrstuvwxyz0123456789+/="])
def test_long_unsplit_text(rounds, alphabet):
    text = "".join(random.Random(3).choices(alphabet, k=50_000))
    assert rounds.encode(text) == rounds.library.encode(text)


def test_decode_of_any_ids(rounds):
    r = random.Random(1)
    for _ in range(1500):
        ids = [r.choice([r.randrange(rounds.size), r.randrange(300)]) for _ in range(r.randint(0, 8))]
        assert rounds.decode(ids) == rounds.library.decode(ids)


def test_words_of_one_hash_are_told_apart(rounds):
    # all word names collide when the hash's factor is zero
    import tagloom.llm.piece_rounds as module
    real = module.np.add.reduceat

    class Add:
        reduceat = staticmethod(lambda x, at: real(x, at) * 0)

    class Numpy:
        add = Add

        def __getattr__(self, name):
            return getattr(real_np, name)

    real_np, module.np = module.np, Numpy()
    try:
        assert rounds.encode("one two three two one four") == rounds.library.encode("one two three two one four")
    finally:
        module.np = real_np


def test_odd_rows(spark, odd, none, rounds):
    got = piece_round_trip(odd, PIECE).collect()
    want = [(r.doc_id, rounds.library.encode(r.text or ""), rounds.library.decode(rounds.library.encode(r.text or "")))
            for r in odd.collect()]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.ids, r.decoded)) for r in got)
    assert piece_round_trip(none, PIECE).collect() == []


def test_query(spark, rounds):
    from tagloom.llm.queries import op13_piece_round_trip
    sf = "/root/testdata/sf0.001"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = rounds.library.encode(r.text or "")
        want.add((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(rounds.library.decode(ids))))
    got = op13_piece_round_trip(spark, sf).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)
