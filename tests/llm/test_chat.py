"""Perspective rotation against plain Python."""

import random
from collections import defaultdict

from tagloom.llm.chat_rotation import rotate


def brute(rows, piece_turns):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, role is not None, role or "", text or ""))
    out = []
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2], t[3], t[4].replace("<|", "< |")))
        for speaker in {t[3] for t in turns if t[2]}:
            pieces = defaultdict(list)
            for t in turns:
                pieces[t[1] // piece_turns if t[0] else -1].append(t)
            offset = 0
            for piece in sorted(pieces):
                text, masks = "", []
                for _, _, named, role, body in pieces[piece]:
                    body = body.replace("<|", "< |")
                    if named and role == speaker:
                        text += "<|assistant|>\n"
                        masks.append((len(text), len(text) + len(body) + 7))
                    else:
                        text += "<|user" + (":" + role.replace("<|", "< |") if named else "") + "|>\n"
                    text += body + "<|end|>\n"
                out.append((conv, speaker, piece, offset, len(pieces[piece]), text, masks))
                offset += len(text)
    return sorted(map(repr, out))


def check(frame, piece_turns=64):
    got = rotate(frame, piece_turns).collect()
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in frame.collect()]
    assert sorted(repr((r.conv_id, r.speaker, r.piece, r.offset, r.n_turns, r.text, [tuple(m) for m in r.masks])) for r in got) == brute(rows, piece_turns)
    return got


def test_rotation(spark):
    r = random.Random(0)
    rows = [(c, t, r.choice(["anna", "ben", "cäsar", "user"]), r.choice(["hi", "<|end|>", "日本", ""])) for c in range(6) for t in range(r.randint(1, 30))]
    rows += [(7, t, ("anna", "ben")[t % 2], f"turn {t}") for t in range(400)]
    check(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 16)


def test_odd_turns(spark):
    rows = [(1, 0, "a", None), (1, 0, "a", None), (1, None, "b", "x"), (1, 1, None, "y"), (None, 0, "a", "z"), (2, 0, None, "only"),
            (3, 5, "<|x", "long " * 20000), (3, 5, "b", "tie"), (3, 5, "b", "Tie"), (4, None, None, None)]
    frame = spark.createDataFrame([(*r, 1, "s") for r in rows], "conv_id long, turn long, role string, text string, piece int, speaker string")
    got = check(frame)
    assert {r.conv_id for r in got} == {1, None, 3}
    assert rotate(frame.limit(0)).collect() == []


def test_masked_text_is_the_speakers(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    for r in check(frame):
        assert all(r.text[m.start:m.end].endswith("<|end|>") for m in r.masks)


def test_crowded_turns_are_cut_by_rows(spark):
    """Thousands of rows with one turn number, without one, or with numbers
    that start again: no piece holds more than the pieces' turns."""
    r = random.Random(1)
    rows = [(1, 5, r.choice(["a", "b", None]), f"{'long ' * 60}{r.randint(0, 900)}") for _ in range(3000)]
    rows += [(1, None, "a", "same")] * 2000 + [(1, 70, "b", "after"), (3, 0, "c", "alone")]
    rows += [(None, t % 8, ("a", "b")[t % 2], r.choice(["<|x", "", None, f"{t}"])) for t in range(3000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges over several partitions
    try:
        got = rotate(frame, 64).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(x.n_turns for x in got) <= 64
    held = defaultdict(list)
    for x in got:
        held[x.conv_id, x.speaker].append(x)
    want = defaultdict(lambda: ["", []])
    for conv, speaker, _, offset, _, text, masks in map(eval, brute(rows, 64)):
        whole = want[conv, speaker]
        assert offset == len(whole[0])  # repr order of pieces -1, 0, 1
        whole[0] += text
        whole[1] += [(offset + a, offset + b) for a, b in masks]
    assert set(held) == set(want)
    for key, pieces in held.items():
        pieces.sort(key=lambda x: x.offset)
        assert all(a.offset + len(a.text) == b.offset and a.piece <= b.piece for a, b in zip(pieces, pieces[1:]))
        assert ["".join(x.text for x in pieces), [(x.offset + m.start, x.offset + m.end) for x in pieces for m in x.masks]] == want[key]
