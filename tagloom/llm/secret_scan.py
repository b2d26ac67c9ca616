"""Secret scans with one combined deterministic automaton.

The rules' regexes become one byte automaton by subset construction and
minimisation. A task scans its texts in one byte pass for all rules: the
texts' bytes are laid end to end, cut into lanes at bytes that reset the
automaton from every state (no rule can match across them), and all lanes step
through the transition array together. Where a lane reaches an accepting
state, the rule's own anchored automaton reads that stretch between two
resetting bytes from left to right and gives the leftmost, longest,
non-overlapping matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANE_BYTES = 1024
LONG_LANE = 64 * LANE_BYTES
BUFFER_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern``: a regex over ASCII bytes without anchors or lookarounds.
    A match counts if its group ``group`` has at least ``least`` bytes.
    ``scan`` (default: the pattern) is what the one pass looks for; it must
    match somewhere inside every stretch that holds a counted match."""

    kind: str
    pattern: str
    group: int
    least: int
    scan: str = ""
    base: bool = False
    any_case: bool = False


#: The base rules in order, then the added ones (fixed values).
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         base=True, any_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, base=True),
    Rule("hex", r"[0-9a-f]+", 0, 16, scan=r"[0-9a-f]{16,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 0, 30),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
)


class _Nfa:
    """States with byte-set moves and empty moves, built from parsed regexes."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def add(self, pattern: str, any_case: bool) -> tuple[int, int]:
        parsed = re._parser.parse(pattern.encode())
        return self._sequence(parsed, any_case)

    def _sequence(self, items, any_case) -> tuple[int, int]:
        first = last = self.state()
        for op, value in items:
            a, b = self._one(str(op), value, any_case)
            self.empty[last].append(a)
            last = b
        return first, last

    def _one(self, op, value, any_case) -> tuple[int, int]:
        if op == "SUBPATTERN":
            return self._sequence(value[3], any_case)
        a, b = self.state(), self.state()
        if op == "BRANCH":
            for branch in value[1]:
                x, y = self._sequence(branch, any_case)
                self.empty[a].append(x)
                self.empty[y].append(b)
        elif op == "MAX_REPEAT":
            least, most, what = value
            last = a
            for _ in range(least):
                x, y = self._sequence(what, any_case)
                self.empty[last].append(x)
                last = y
            if str(most) == "MAXREPEAT":
                x, y = self._sequence(what, any_case)
                self.empty[last].append(x)
                self.empty[y].append(last)
            else:
                for _ in range(most - least):
                    x, y = self._sequence(what, any_case)
                    self.empty[last] += [x, b]
                    last = y
            self.empty[last].append(b)
        else:
            self.moves[a].append((self._bytes(op, value, any_case), b))
        return a, b

    @staticmethod
    def _bytes(op, value, any_case) -> frozenset:
        if op == "LITERAL":
            found = {value}
        elif op == "NOT_LITERAL":
            found = set(range(256)) - {value}
        elif op == "ANY":
            found = set(range(256)) - {10}
        elif op == "IN":
            found, negate = set(), False
            for kind, x in value:
                if str(kind) == "NEGATE":
                    negate = True
                elif str(kind) == "LITERAL":
                    found.add(x)
                elif str(kind) == "RANGE":
                    found |= set(range(x[0], x[1] + 1))
                else:
                    raise ValueError(f"unsupported in a rule: {kind}")
            if negate:
                found = set(range(256)) - found
        else:
            raise ValueError(f"unsupported in a rule: {op}")
        if any_case:
            found |= {ord(chr(x).swapcase()) for x in found if x < 128 and chr(x).isalpha()}
        return frozenset(found)

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


class Automaton:
    """Minimal deterministic automaton of several regexes.

    ``table[state * classes + class]`` is the next state times ``classes``;
    accepting states come last, from ``accepting`` on; ``accepts[state]`` has a
    bit per regex. With ``search``, a match may start at any byte.
    """

    def __init__(self, patterns: list[tuple[str, bool]], search: bool):
        nfa, ends, own = _Nfa(), [], []
        for pattern in patterns:
            before = len(nfa.moves)
            ends.append(nfa.add(*pattern))
            own.append(frozenset(range(before, len(nfa.moves))))
        sets = {s for moves in nfa.moves for s, _ in moves}
        # bytes that no move tells apart are one class
        signature = {b: tuple(sorted(i for i, s in enumerate(sets) if b in s)) for b in range(256)}
        kinds = sorted(set(signature.values()))
        self.class_of = np.array([kinds.index(signature[b]) for b in range(256)], dtype=np.uint8)
        sample = [int(np.flatnonzero(self.class_of == k)[0]) for k in range(len(kinds))]
        self.classes = len(kinds)
        start = nfa.closure([a for a, _ in ends])
        known, order, rows = {start: 0}, [start], []
        for here in order:
            row = []
            for byte in sample:
                to = nfa.closure([t for s in here for bytes_, t in nfa.moves[s] if byte in bytes_])
                if search:
                    # a search ends with the first acceptance and starts anew at every byte
                    for (_, end), states in zip(ends, own):
                        if end in to:
                            to = (to - states) | {end}
                    to |= start
                if to not in known:
                    known[to] = len(order)
                    order.append(to)
                row.append(known[to])
            rows.append(row)
        accepts = np.array([sum(1 << i for i, (_, end) in enumerate(ends) if end in s) for s in order])
        table, accepts, first = _minimal(np.array(rows), accepts, 0)
        dead = [s for s in range(len(table)) if not accepts[s] and (table[s] == s).all()]
        self.dead = dead[0] if dead and not search else -1
        rank = np.argsort(accepts != 0, kind="stable")
        new = np.empty_like(rank)
        new[rank] = np.arange(len(rank))
        self.rows, self.accepts, self.start = new[table[rank]], accepts[rank], int(new[first])
        self.dead = int(new[self.dead]) if self.dead >= 0 else -1
        self.table = (self.rows * self.classes).astype(np.int32).ravel()
        self.accepting = int((self.accepts == 0).sum()) * self.classes
        #: Bytes that lead from every state to the start.
        resets = (self.rows == self.start).all(axis=0)
        self.resets = resets[self.class_of]


def _minimal(table: np.ndarray, accepts: np.ndarray, start: int):
    """Merge states that no input tells apart (partition refinement)."""
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    _, one = np.unique(block, return_index=True)
    return block[table[one]], accepts[one], int(block[start])


class SecretScanner:
    """All rules as one searching automaton, and each as an anchored one."""

    def __init__(self, rules=RULES):
        self.rules = rules
        self.search = Automaton([(r.scan or r.pattern, r.any_case) for r in rules], True)
        if not self.search.resets.any():
            raise ValueError("no byte resets these rules: texts could not be cut into lanes")
        self.steps = self.search.table.tolist()
        self.gap = bytes([int(np.flatnonzero(self.search.resets)[0])])
        self.one = []
        for r in rules:
            a = Automaton([(r.pattern, r.any_case)], False)
            table = [[int(row[c]) for c in a.class_of] for row in a.rows]
            self.one.append((table, [bool(x) for x in a.accepts], a.start, a.dead,
                             re.compile(r.pattern.encode(), re.I if r.any_case else 0)))

    def hits(self, data: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(start, end, rules) of the stretches between resetting bytes where
        the one pass reaches accepting states; rules as bits."""
        search = self.search
        cuts = np.flatnonzero(search.resets[data]) + 1
        edges = np.unique(np.concatenate([[0], cuts, [len(data)]]))
        # lanes: whole stretches, about LANE_BYTES together
        lane = np.unique(edges[np.minimum(np.searchsorted(edges, np.arange(0, len(data), LANE_BYTES)), len(edges) - 1)])
        lane = lane[lane < len(data)]
        length = np.diff(np.append(lane, len(data)))
        order = np.argsort(-length, kind="stable")
        lane, length = lane[order], length[order]
        classes, table, accepting = search.class_of[data], search.table, search.accepting
        # text without a resetting byte for long: alone in its lane, it goes byte by byte
        unsplit = int(np.searchsorted(-length, -LONG_LANE, side="right"))
        alone: list[tuple[np.ndarray, np.ndarray]] = []
        for a, n in zip(lane[:unsplit].tolist(), length[:unsplit].tolist()):
            s, at, states = search.start * search.classes, [], []
            for k, c in enumerate(classes[a:a + n].tobytes()):
                s = self.steps[s + c]
                if s >= accepting:
                    at.append(a + k)
                    states.append(s)
            if at:
                alone.append((np.array(at), search.accepts[np.array(states) // search.classes]))
        lane, length = lane[unsplit:], length[unsplit:]
        state = np.full(len(lane), search.start * search.classes, dtype=np.int32)
        found = alone
        active = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="right") if len(length) else []
        at = lane.copy()
        for n in active:
            s = table[state[:n] + classes[at[:n]]]
            state[:n] = s
            hit = np.flatnonzero(s >= accepting)
            if len(hit):
                found.append((at[hit], search.accepts[s[hit] // search.classes]))
            at[:n] += 1
        if found:
            where = np.searchsorted(edges, np.concatenate([f[0] for f in found]), side="right") - 1
            masks = np.concatenate([f[1] for f in found])
            by = np.argsort(where, kind="stable")
            where, masks = where[by], masks[by]
            firsts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            for stretch, mask in zip(where[firsts], np.bitwise_or.reduceat(masks, firsts)):
                yield int(edges[stretch]), int(edges[stretch + 1]), int(mask)

    def matches(self, stretch: bytes, rule: int) -> Iterator[tuple[int, int]]:
        """Leftmost, longest, non-overlapping matches that the rule counts.

        A run that leaves (state, place) pairs behind it without accepting
        again marks them; no later run goes past a mark. So every pair is
        walked once, and the time is linear in the stretch, however its
        matches fail.
        """
        table, accepts, start, dead, pattern = self.one[rule]
        least, group = self.rules[rule].least, self.rules[rule].group
        at, n = 0, len(stretch)
        vain: dict[int, bytearray] = {}
        while at < n:
            state, end, walked = start, -1, []
            for k in range(at, n):
                state = table[state][stretch[k]]
                if state == dead or state in vain and vain[state][k]:
                    break
                if accepts[state]:
                    end, walked = k + 1, []
                else:
                    walked.append((state, k))
            if len(walked) > 8:     # a short run costs less than its marks
                for s, k in walked:
                    if s not in vain:
                        vain[s] = bytearray(n)
                    vain[s][k] = 1
            if end < 0:
                at += 1
                continue
            counted = end - at if not group else len(pattern.fullmatch(stretch, at, end)[group])
            if counted >= least:
                yield at, end
            at = end

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, rule, end) in code points, sorted."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        first = 0
        while first < len(texts):
            last, held = first, 0
            while last < len(texts) and (last == first or held + len(texts[last]) <= BUFFER_BYTES):
                held += len(texts[last]) + 1
                last += 1
            data = self.gap.join(texts[first:last])
            starts = np.cumsum([0] + [len(t) + 1 for t in texts[first:last]])
            for a, b, mask in self.hits(np.frombuffer(data, dtype=np.uint8)):
                k = int(np.searchsorted(starts, a, side="right")) - 1
                stretch, base = data[a:b], int(starts[k])
                before = len(data[base:a].decode("utf-8", "replace"))
                for rule in range(len(self.rules)):
                    if mask >> rule & 1:
                        for x, y in self.matches(stretch, rule):
                            s = before + len(stretch[:x].decode("utf-8", "replace"))
                            # matches are ASCII: as many code points as bytes
                            out[first + k].append((s, rule, s + y - x))
            first = last
        for spans in out:
            spans.sort()
        return out


_MADE: dict = {}


def scanner(rules=RULES) -> SecretScanner:
    """One compiled scanner per process."""
    if rules not in _MADE:
        _MADE[rules] = SecretScanner(rules)
    return _MADE[rules]


def find_secrets(docs: DataFrame, rules=RULES) -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end, base;
    code points, end exclusive; by start, then the rules' order).

    Null texts count as empty: no spans. Repeated rows are scanned each. Texts
    of any length are read whole, in time linear in their length. No rows give
    no rows; other columns are ignored.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def scan(batches):
        scans = scanner(rules)
        for batch in batches:
            found = scans.scan([x.as_py() or b"" for x in batch.column(1)])
            rows = [[{"kind": rules[r].kind, "start": s, "end": e, "base": rules[r].base} for s, r, e in spans] for spans in found]
            yield pa.record_batch([batch.column(0), pa.array(rows, schema.field(1).type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(
        scan, "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>")
