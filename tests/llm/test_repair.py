"""Conversation repair against trying every edit sequence."""

import hashlib
import itertools
import random
import zlib

import pytest

from tagloom.llm.chat_repair import STATES, applied, best_route, damage, repair, search, summaries

COST = {"K": 0, "R": 1, "D": 2, "I": 5}
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest(rows):
    """Least (cost, audit) over coded rows (initial, fault): all audits by a
    plain walk along the rows, insertions at most three in a row."""
    known = {0: (0, "")}

    def insert(known):
        best, front = dict(known), known
        for _ in range(3):
            front = {NEXT[q, w]: (c + 5, a + "I") for q, (c, a) in front.items() for w in "ua" if (q, w) in NEXT}
            for q, label in front.items():
                best[q] = min(best.get(q, label), label)
        return best

    known = insert(known)
    for initial, fault in rows:
        then = {}
        for q, (c, a) in known.items():
            ways = [(2, "D", q)]
            if fault != "x":
                more = 5 if fault == "t" else 0
                if (q, initial) in NEXT:
                    ways.append((more, "K", NEXT[q, initial]))
                ways += [(1 + more, "R", NEXT[q, w]) for w in "ua" if (q, w) in NEXT]
            for cost, letter, to in ways:
                label = c + cost, a + letter
                then[to] = min(then.get(to, label), label)
        known = insert(then)
    return min(known[q] for q in (0, 3) if q in known)


def every(rows):
    """Least (cost, audit) by enumeration of all audits with up to 3 inserts."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        for n in range(4):
            for at in itertools.combinations_with_replacement(range(len(rows) + 1), n):
                audit = "".join("I" * at.count(k) + (letters[k] if k < len(rows) else "") for k in range(len(rows) + 1))
                states, cost, k = {0}, 0, 0
                for x in audit:
                    initial, fault = rows[k] if x != "I" else ("", ".")
                    cost += COST[x] + (5 if fault == "t" and x in "KR" else 0)
                    k += x != "I"
                    if x == "D":
                        continue
                    if fault == "x":
                        states = set()
                    states = {NEXT[q, w] for q in states for w in (initial if x == "K" else "ua") if (q, w) in NEXT}
                if states & {0, 3}:
                    best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def test_search_against_enumeration():
    r = random.Random(2)
    for _ in range(60):
        rows = [(r.choice("sua-"), r.choice("...xt")) for _ in range(r.randint(0, 4))]
        assert search("".join(a + b for a, b in rows)) == every(rows) == cheapest(rows)


def test_search_against_walk():
    r = random.Random(3)
    for _ in range(400):
        rows = [(r.choice("suauauaua-"), r.choice("......xt")) for _ in range(r.randint(0, 30))]
        cost, audit = search("".join(a + b for a, b in rows))
        assert (cost, audit) == cheapest(rows)


def test_spans_compose():
    r = random.Random(4)
    for _ in range(60):
        codes = "".join(r.choice("suauaua-") + r.choice(".....xt") for _ in range(20))
        steps = [[[search(codes[a:a + 10], p, (q,), False) for q in STATES] for p in STATES] for a in range(0, 40, 10)]
        states = best_route(steps, 0, None)
        audit = "".join(m[p][q][1] for m, p, q in zip(steps, states, states[1:])) + search("", states[-1])[1]
        assert audit == search(codes)[1]


def expected(rows):
    """The contract by hand over (conv_id, turn, role, text) rows."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    result = {}
    for conv, of in out.items():
        digest = lambda x: hashlib.sha1(f"{x[1]}:{x[2]}".encode()).hexdigest()
        of.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1][:32].encode(), x[2][:64].encode(), digest(x)))
        turns = {t for t, _, _ in of if t is not None}
        blank = double = cut = 0
        seen, codes = set(), []
        for _, role, text in of:
            last = text.rstrip(" \t\n\v\f\r")[-1:]
            fault = "."
            if not last:
                blank, fault = blank + 1, "x"
            elif (role, text) in seen:
                double, fault = double + 1, "x"
            elif last not in ".!?":
                cut, fault = cut + 1, "t"
            seen.add((role, text))
            codes.append((role[:1] if role[:1] in "sua" and role else "-", fault))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(of, of[1:]))
        cost, audit = cheapest(codes)
        fixed = applied(audit, [(r, t) for _, r, t in of], 0)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result[conv] = (gaps, blank, double, cut, illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in fixed)))
    return result


@pytest.fixture(scope="module")
def chats(spark):
    r = random.Random(8)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(r.randint(1, 12)):
            rows.append((conv, turn if r.random() < 0.9 else None, r.choice(["user", "assistant", "system", None, "", "Assistant", "tool"]),
                         r.choice(["Yes.", "No!", "and then", "", " \n", None, "Well? \t", "é", "x" * 5000 + "."])))
    rows += [(100, t, ["user", "assistant"][t % 2], f"Turn {t % 300}.") for t in range(1500)]  # long, with distant repeats
    rows += [(101, None, "user", "Same.")] * 700 + [(102, 5, "assistant", f"{k}") for k in range(300)]
    rows += [(103, 7, "user", "Y" * 70 + str(k % 40)) for k in range(200)]
    r.shuffle(rows)
    return rows, spark.createDataFrame([(*x, 1, "p") for x in rows], "conv_id long, turn long, role string, text string, part int, whole string")


@pytest.mark.parametrize("chunk_rows", [512, 3])
def test_repair_of_odd_conversations(spark, chats, tmp_path, chunk_rows):
    rows, df = chats
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    table = spark.read.parquet(str(tmp_path / "conversations.parquet"))
    got = summaries(repair(damage(table), chunk_rows)).collect()
    want = expected(rows)
    assert {r.conv_id: tuple(r)[1:] for r in got} == {k: v for k, v in want.items() if k in {r.conv_id for r in got}}
    assert len(got) == len({r.conv_id for r in got})
    assert all(v[5] == 0 and v[6] == "" for k, v in want.items() if k not in {r.conv_id for r in got})


def test_no_rows(spark, chats):
    assert summaries(repair(damage(chats[1].limit(0)))).collect() == []


def test_query(spark):
    from tagloom.llm.queries import op11_chat_repair
    sf = "/root/testdata/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = op11_chat_repair(spark, sf).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected(rows) and len(got) == len({r[0] for r in rows})
