"""The combined automaton against the rules' regexes."""

import random
import re

from tagloom.llm.secret_scan import RULES, Automaton, SecretScanner, find_secrets, scanner

PARTS = ["password", "Token", "secret", "api_key", "apikey", "PASSWD", ":", "=", "  ", "'", '"', "abcdef0123456789", "AKIA",
         "ABCDEFGH12345678", "xyz", "é", "\n", "ghp_", "xoxb-", "eyJabcdefghij", ".", "0123456789abcdef" * 2,
         "-----BEGIN RSA PRIVATE KEY-----", "日", "-", "_", "A1b2", "\x00"]
REGEX = [(re.compile(r.pattern, re.I | re.A if r.any_case else 0), r.group, r.least) for r in RULES]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (p, g, least) in enumerate(REGEX) for m in p.finditer(text) if len(m[g]) >= least)


def test_random_texts():
    r = random.Random(2)
    texts = ["".join(r.choices(PARTS, k=r.randint(0, 40))) for _ in range(1500)] + ["", "a" * 40, "token=" * 50]
    found = scanner().scan([t.encode() for t in texts])
    assert found == [brute(t) for t in texts]
    assert sum(map(len, found)) > 1000


def test_dropped_match_hides_what_it_covers():
    text = "secret: token: abcdefghijklmnop"
    assert brute(text) == []
    assert scanner().scan([text.encode()]) == [[]]


def test_minimal_automaton():
    # (a|b)*abb needs four states
    one = Automaton([("(?:a|b)*abb", False)], False)
    assert sum(1 for s in range(len(one.rows)) if s != one.dead) == 4
    assert SecretScanner(RULES[:3]).search.resets.any()


def test_spans_of_odd_rows(spark, odd, none):
    long = "é" * 70000 + " token = 'abcdefghijkl1234' " + "f" * 20 + " " * 100 + "AKIA" + "Q" * 16
    docs = odd.unionByName(spark.createDataFrame([(30, long), (31, "")], "doc_id long, text string"), allowMissingColumns=True)
    got = sorted(repr((r.doc_id, [(s.start, s.kind, s.end) for s in r.spans])) for r in find_secrets(docs).collect())
    want = sorted(repr((r.doc_id, [(a, RULES[k].kind, b) for a, k, b in brute(r.text or "")])) for r in docs.collect())
    assert got == want
    assert find_secrets(none).collect() == []


def test_query_on_whole_table(spark):
    import hashlib
    from tagloom.llm.queries import op10_secret_scan
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op10_secret_scan(spark, sf).collect()}
    total = 0
    for d in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        spans = brute(d.text or "")
        base = ",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in spans if RULES[k].base)
        r = got[d.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert r.spans == ",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in spans)
        total += len(spans)
    assert total > 10


def test_unsplit_texts_byte_by_byte(monkeypatch):
    import tagloom.llm.secret_scan as module
    r = random.Random(9)
    parts = [p for p in PARTS if p not in ("\n", "é", "日", "\x00", "  ")]
    texts = ["".join(r.choices(parts, k=r.randint(0, 60))) for _ in range(300)]
    monkeypatch.setattr(module, "LONG_LANE", 40)
    assert scanner().scan([t.encode() for t in texts]) == [brute(t) for t in texts]


def test_long_texts_that_nearly_match():
    """A megabyte of beginnings that all fail, or overlap, in linear time."""
    import time
    near = ["eyJ" * 350_000 + "=eyJ" + "." * 8, "eyJa." * 200_000, "token" * 200_000 + ":" + "a" * 11, "gh" * 10 + "p_" * 500_000,
            "xoxb-" * 200_000, "-----BEGIN " + "A" * 1_000_000, "-----BEGIN " * 90_000, "0" * 1_000_000 + "g", "AKIA" * 250_000]
    for text in near:
        t0 = time.time()
        found = scanner().scan([text.encode()])
        assert time.time() - t0 < 6, text[:20]
        if not text.startswith(("eyJ", "-----")):    # the regexes themselves are quadratic there
            assert found == [brute(text)]
    for cut in (300, 301, 302):      # the same shapes, short enough for the regexes
        texts = [t[:cut] + t[-20:] for t in near]
        assert scanner().scan([t.encode() for t in texts]) == [brute(t) for t in texts]
