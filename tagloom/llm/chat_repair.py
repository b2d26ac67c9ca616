"""Conversation structure repair by bidirectional search of the edit lattice.

A conversation's rows become the cheapest sequence whose role initials read
``(s?(ua)+)?``. A lattice node is (rows consumed, role state); its edges keep,
rerole or delete the next row, or insert a row. A forward heap starts at the
empty prefix and a reverse heap at the accepting ends; they run until no
crossing can cost less *or as much* as the best one found, and of all crossings
of the least cost the least concatenated audit wins. At one node two labels of
equal cost are never prefixes of each other (letters fix the cost), so the
least whole audit is made of least parts.

Rows are sorted over range partitions and cut into chunks where the
conversation changes or a chunk is full. A conversation in one chunk is solved
at once. For one over several chunks (a very long one, or one at a partition's
edge) every chunk gives the best (cost, audit) between every two role states;
these are combined in order, so no task holds the rows of a long conversation.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import written

CHUNK_ROWS = 512
CHUNK_CHARS = 1 << 22
CACHE_CHARS = 1 << 22
# Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Role states: nothing yet, after s, after u, after a.
STATES = range(4)
ACCEPTING = (0, 3)
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: What a reroled or inserted row must be.
_TURN = {0: "u", 1: "u", 2: "a", 3: "u"}
_ROLE = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\v\f\r"


def damage(conversations: DataFrame) -> DataFrame:
    """Seeded faults by crc32 of ``conv_id:turn`` mod 20: 0 drops the row, 1
    empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it user's.
    Null values count as one space. Returns conv_id, turn, role, text."""
    def filled(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    # conv_id and turn of the result stay null: only what is hashed is filled
    rows = conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text"),
        (F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20).alias("fault"))
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    return rows.where(fault != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


# ------------------------------------------------------------- the lattice

def search(rows: str, start: int = 0, ends: tuple[int, ...] = ACCEPTING, tail: bool = True) -> tuple[int, str] | None:
    """Least (cost, audit) from ``start`` to one of ``ends`` over coded rows.

    ``rows`` has two characters a row: its role initial, and ``x`` (must be
    deleted), ``t`` (truncated) or ``.``. ``tail`` allows insertions after the
    last row.
    """
    n = len(rows) // 2

    def out_of(i, q):
        """Edges (cost, letter, next node)."""
        turned = _NEXT[q, _TURN[q]]
        if i < n:
            yield DELETE, "D", (i + 1, q)
            initial, fault = rows[2 * i], rows[2 * i + 1]
            if fault != "x":
                more = TRUNCATED if fault == "t" else 0
                kept = _NEXT.get((q, initial))
                if kept is not None:
                    yield KEEP + more, "K", (i + 1, kept)
                yield REROLE + more, "R", (i + 1, turned)
        if i < n or tail:
            yield INSERT, "I", (i, turned)

    def into(i, q):
        """Edges (cost, letter, previous node)."""
        if i:
            yield DELETE, "D", (i - 1, q)
            initial, fault = rows[2 * i - 2], rows[2 * i - 1]
            if fault != "x":
                more = TRUNCATED if fault == "t" else 0
                for p in STATES:
                    if _NEXT.get((p, initial)) == q:
                        yield KEEP + more, "K", (i - 1, p)
                    if _NEXT[p, _TURN[p]] == q:
                        yield REROLE + more, "R", (i - 1, p)
        if i < n or tail:
            for p in STATES:
                if _NEXT[p, _TURN[p]] == q:
                    yield INSERT, "I", (i, p)

    # labels (cost, audit); nodes of equal cost are taken along the rows, as
    # only edges to the next row can cost nothing
    ahead, back = {(0, start): (0, "")}, {(n, q): (0, "") for q in ends}
    fore, rear = [(0, 0, start)], [(0, -n, q) for q in sorted(ends)]
    heapq.heapify(rear)
    fixed_ahead, fixed_back = set(), set()
    best = None
    while fore and rear:
        if best is not None and fore[0][0] + rear[0][0] > best:
            break
        if fore[0][0] <= rear[0][0]:
            cost, i, q = heapq.heappop(fore)
            node, labels, others, fixed = (i, q), ahead, back, fixed_ahead
        else:
            cost, i, q = heapq.heappop(rear)
            node, labels, others, fixed = (-i, q), back, ahead, fixed_back
        if node in fixed:
            continue
        fixed.add(node)
        audit = labels[node][1]
        if node in others:
            total = cost + others[node][0]
            best = total if best is None or total < best else best
        if labels is ahead:
            for c, letter, to in out_of(*node):
                label = cost + c, audit + letter
                if to not in ahead or label < ahead[to]:
                    ahead[to] = label
                    heapq.heappush(fore, (label[0], *to))
                if to in back:
                    best = min(label[0] + back[to][0], best if best is not None else 1 << 60)
        else:
            for c, letter, to in into(*node):
                label = cost + c, letter + audit
                if to not in back or label < back[to]:
                    back[to] = label
                    heapq.heappush(rear, (label[0], -to[0], to[1]))
                if to in ahead:
                    best = min(label[0] + ahead[to][0], best if best is not None else 1 << 60)
    if best is None:
        return None
    return best, min(a + back[node][1] for node, (c, a) in ahead.items() if node in back and c + back[node][0] == best)


class Solver:
    """Searches whose row codes repeat are done once, within CACHE_CHARS."""

    def __init__(self):
        self.known, self.held = {}, 0

    def __call__(self, rows: str, *args):
        key = rows, *args
        found = self.known.get(key, 0)
        if found == 0:
            if self.held > CACHE_CHARS:
                self.known, self.held = {}, 0
            found = self.known[key] = search(rows, *args)
            self.held += 2 * len(rows) + 200
        return found


def applied(audit: str, rows: list[tuple[str, str]], state: int) -> list[tuple[str, str]]:
    """The (role, text) rows that an audit makes, from a role state on."""
    out, at = [], 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[at]
        at += letter != "I"
        if letter == "D":
            continue
        if letter != "K":
            role = _ROLE[_TURN[state]]
        state = _NEXT[state, role[0]]
        out.append((role, text))
    return out


def end_of(state: int) -> tuple[int, str] | None:
    """Insertions after the last row."""
    return search("", state)


# ------------------------------------------------------------------ Spark

_CHUNK = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("turns", pa.list_(pa.int64())),
                    ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
_CHUNK_DDL = "part int, chunk long, turns array<long>, roles array<string>, texts array<string>"
_PIECE_DDL = ("part int, chunk long, first_turn long, last_turn long, n_turns long, n_rows long, first string, last string, "
              "blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
              "repaired array<struct<role: string, text: string>>")


def _chunks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Sorted rows -> one row per chunk: conv_id, part, chunk (ordered), and
    its turns, roles and texts."""
    # rows alike in everything are dealt over partitions by their place
    key = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.substring("role", 1, 32).asc(),
           F.substring("text", 1, 64).asc(), F.sha1(F.concat_ws(":", "role", "text")).asc(), F.col("_place").asc()]
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*key).sortWithinPartitions(*key).select(
        "conv_id", F.spark_partition_id().alias("part"), "turn", "role", "text")

    def cut(batches):
        held, last, part, chunk, chars, schema = ([], [], []), None, 0, 0, 0, None
        done, done_chars = [], 0

        def flush():
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        for batch in batches:
            schema = pa.schema([pa.field("conv_id", batch.schema.field(0).type), *_CHUNK])
            for here, at, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if held[0] and (here != last or len(held[0]) >= chunk_rows or chars > CHUNK_CHARS):
                    done.append((last, part, chunk, *held))
                    done_chars += chars
                    held, chunk, chars = ([], [], []), chunk + 1, 0
                    if done_chars > CHUNK_CHARS:
                        yield flush()
                        done, done_chars = [], 0
                if not held[0]:
                    last, part = here, at
                for values, v in zip(held, (turn, role, text)):
                    values.append(v)
                chars += 16 + len(role) + len(text)
        if held[0]:
            done.append((last, part, chunk, *held))
            yield flush()

    return dealt.mapInArrow(cut, f"conv_id {kind}, {_CHUNK_DDL}")


def _coded(roles, texts, repeated) -> tuple[str, list[int]]:
    """Row codes of a chunk, and its counts of blank, duplicate and truncated
    rows. ``repeated``: places seen in an earlier chunk or row, or None to look
    for them here."""
    codes, counts, seen = [], [0, 0, 0], set()
    for k, row in enumerate(zip(roles, texts)):
        last = row[1].rstrip(_SPACE)[-1:]
        double = row in seen if repeated is None else k in repeated
        fault = 0 if not last else 1 if double else 2 if last not in ".!?" else None
        seen.add(row)
        if fault is not None:
            counts[fault] += 1
        codes.append((row[0][:1] if row[0][:1] in ("s", "u", "a") else "-") + (".xxt"[0 if fault is None else fault + 1]))
    return "".join(codes), counts


def _facts(turns, roles) -> tuple:
    """first_turn, last_turn, n_turns, n_rows, first, last, illegal pairs."""
    known = [t for t in turns if t is not None]
    initials = [r[:1] for r in roles]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    return (known[0] if known else None, known[-1] if known else None, len(set(known)), len(turns), initials[0], initials[-1], illegal)


def _piece(row, counts, cost, audit, repaired):
    first_turn, last_turn, n_turns, n_rows, first, last, illegal = _facts(row["turns"], row["roles"])
    return (row["conv_id"], row["part"], row["chunk"], first_turn, last_turn, n_turns, n_rows, first, last, *counts, illegal, cost, audit,
            [{"role": r, "text": t} for r, t in repaired])


def _in_batches(batch: pa.RecordBatch, piece):
    """``piece`` of every chunk, in record batches of bounded texts."""
    schema = _piece_schema(batch.schema.field("conv_id").type)
    out, chars = [], 0
    for k in range(batch.num_rows):
        row = batch.slice(k, 1).to_pylist()[0]
        out.append(piece(row))
        chars += sum(map(len, row["texts"]))
        if chars > CHUNK_CHARS or k == batch.num_rows - 1:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, chars = [], 0


def _piece_schema(conv_type) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = [f.split(" ") for f in _PIECE_DDL.split(", repaired")[0].split(", ")]
    pair = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    return pa.schema([("conv_id", conv_type), *((n, kinds[k]) for n, k in fields), ("repaired", pair)])


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per piece of a conversation: conv_id, part and chunk (their
    order), whole (there is no other piece), the piece's turns, initials and
    counts of faults, cost, audit (K keep, R rerole, D delete, I insert) and
    repaired (role and text of the rows that result).

    Rows go by turn (null first), then by the first 32 characters of the role
    and 64 of the text, then by a digest of both. Null role and text count as
    one space, null conv_id as one conversation. A row's fault is the first
    of: blank, repeating role and text of an earlier row, truncated. A role
    that does not start with s, u or a (an empty one too) cannot be kept. Texts
    of any length are carried whole. ``rows`` must be repeatable (a table, not
    a random order). No rows give no rows; other columns are ignored.
    """
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *(
        F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    kind = rows.schema["conv_id"].dataType.simpleString()
    chunks = written(_chunks(rows, chunk_rows), "chat-chunks")
    many = written(chunks.groupBy("conv_id").agg(F.count("*").alias("pieces")).where("pieces > 1"), "chat-many")
    of_many = chunks["conv_id"].eqNullSafe(many["conv_id"])
    ddl = f"conv_id {kind}, {_PIECE_DDL}"

    def whole(batches):
        solve = Solver()

        def piece(row):
            codes, counts = _coded(row["roles"], row["texts"], None)
            cost, audit = solve(codes)
            return _piece(row, counts, cost, audit, applied(audit, list(zip(row["roles"], row["texts"])), 0))

        for batch in batches:
            yield from _in_batches(batch, piece)

    single = chunks.join(many, of_many, "left_anti").mapInArrow(whole, ddl).withColumn("whole", F.lit(True))
    return single.unionByName(_long(chunks.join(many, of_many, "left_semi"), kind, ddl))


def _long(chunks: DataFrame, kind: str, ddl: str) -> DataFrame:
    """Pieces of conversations that have several chunks."""
    chunks = written(chunks, "chat-long")
    place = ["conv_id", "part", "chunk"]
    digest = chunks.select(*place, F.posexplode(F.zip_with("roles", "texts", lambda r, t: F.sha2(F.concat_ws("\x1f", F.length(r), r, t), 256))).alias("k", "h"))
    # the first row of every (role, text); equal rows meet before the shuffle
    first = digest.groupBy("conv_id", "h").agg(F.min(F.struct("part", "chunk", "k")).alias("at"), F.count("*").alias("n")).where("n > 1")
    first = written(first.select(F.col("conv_id").alias("c"), F.col("h").alias("g"), "at"), "chat-first")
    again = digest.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("h") == F.col("g")) & (
        F.struct("part", "chunk", "k") != F.col("at")))
    again = again.groupBy("part", "chunk").agg(F.collect_list("k").alias("repeated"))  # at most a chunk's rows
    flagged = written(chunks.join(again, ["part", "chunk"], "left"), "chat-flagged")

    def spans(batches):
        solve = Solver()
        schema = None
        for batch in batches:
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("part", pa.int32()), ("chunk", pa.int64()),
                                ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
            at = batch.schema.get_field_index("conv_id")
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                codes, _ = _coded(row["roles"], row["texts"], set(row["repeated"] or ()))
                found = [solve(codes, p, (q,), False) for p in STATES for q in STATES]
                yield pa.record_batch([batch.column(at).slice(k, 1), pa.array([row["part"]], pa.int32()), pa.array([row["chunk"]], pa.int64()),
                                       pa.array([[f[0] if f else None for f in found]], pa.list_(pa.int64())),
                                       pa.array([[f[1] if f else None for f in found]], pa.list_(pa.string()))], schema=schema)

    spans_ddl = f"conv_id {kind}, part int, chunk long, costs array<long>, audits array<string>"
    small = written(flagged.select("conv_id", "part", "chunk", "roles", "texts", "repeated").mapInArrow(spans, spans_ddl), "chat-spans")

    # a partition's chunks of a conversation are combined first, then its partitions
    def over_part(table):
        table = table.sort_by("chunk")
        total = None
        for costs, audits in zip(table.column("costs").to_pylist(), table.column("audits").to_pylist()):
            m = _matrix(costs, audits)
            total = m if total is None else combine(total, m)
        flat = [total[p][q] for p in STATES for q in STATES]
        return pa.table([table.column("conv_id").slice(0, 1), table.column("part").slice(0, 1), pa.array([0], pa.int64()),
                         pa.array([[f[0] if f else None for f in flat]], pa.list_(pa.int64())),
                         pa.array([[f[1] if f else None for f in flat]], pa.list_(pa.string()))],
                        names=["conv_id", "part", "chunk", "costs", "audits"])

    def routes(order: str, ends: bool):
        """Task function: the role state before every part (or chunk)."""
        def route(table):
            table = table.sort_by(order)
            steps = [_matrix(c, a) for c, a in zip(table.column("costs").to_pylist(), table.column("audits").to_pylist())]
            start, goal = (0, None) if ends else (table.column("p")[0].as_py(), table.column("q")[0].as_py())
            states = best_route(steps, start, goal)
            n = table.num_rows
            conv = pa.chunked_array([table.column("conv_id").combine_chunks()])
            return pa.table([conv, table.column("part"), table.column("chunk"), pa.array(states[:-1], pa.int32()), pa.array(states[1:], pa.int32()),
                             pa.array([False] * (n - 1) + [True])], names=["conv_id", "part", "chunk", "p", "q", "last"])
        return route

    route_ddl = f"conv_id {kind}, part int, chunk long, p int, q int, last boolean"
    parts = written(small.groupBy("conv_id", "part").applyInArrow(over_part, spans_ddl), "chat-parts")
    of_parts = written(parts.groupBy("conv_id").applyInArrow(routes("part", True), route_ddl), "chat-routes")
    known = of_parts.select(F.col("part").alias("in_part"), F.col("conv_id").alias("c"), "p", "q", F.col("last").alias("last_part"))
    inner = small.join(known, small["conv_id"].eqNullSafe(F.col("c")) & (F.col("part") == F.col("in_part")))
    of_chunks = inner.select("conv_id", "part", "chunk", "costs", "audits", "p", "q").groupBy("conv_id", "part").applyInArrow(
        routes("chunk", False), route_ddl)
    ended = known.where("last_part").select("c", "in_part", "last_part")
    of_chunks = written(of_chunks, "chat-chunk-routes").join(
        ended, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("in_part")), "left").select(
        "part", "chunk", "p", "q", (F.col("last") & F.coalesce("last_part", F.lit(False))).alias("end"))

    def pieces(batches):
        solve = Solver()

        def piece(row):
            codes, counts = _coded(row["roles"], row["texts"], set(row["repeated"] or ()))
            cost, audit = solve(codes, row["p"], (row["q"],), False)
            if row["end"]:
                more = end_of(row["q"])
                cost, audit = cost + more[0], audit + more[1]
            return _piece(row, counts, cost, audit, applied(audit, list(zip(row["roles"], row["texts"])), row["p"]))

        for batch in batches:
            yield from _in_batches(batch, piece)

    return flagged.join(of_chunks, ["part", "chunk"]).mapInArrow(pieces, ddl).withColumn("whole", F.lit(False))


def _matrix(costs, audits):
    return [[None if costs[4 * p + q] is None else (costs[4 * p + q], audits[4 * p + q]) for q in STATES] for p in STATES]


def combine(a, b):
    """Best (cost, audit) between role states over two spans of rows."""
    out = [[None] * 4 for _ in STATES]
    for p in STATES:
        for q in STATES:
            ways = [(a[p][m][0] + b[m][q][0], a[p][m][1] + b[m][q][1]) for m in STATES if a[p][m] and b[m][q]]
            out[p][q] = min(ways) if ways else None
    return out


def best_route(steps, start: int, goal: int | None) -> list[int]:
    """Role states before, between and after spans, of the least (cost, audit)
    from ``start`` to ``goal`` (None: any, with the insertions that end it)."""
    here = {start: (0, "", None)}
    for m in steps:
        there = {}
        for p, (cost, audit, way) in here.items():
            for q in STATES:
                if m[p][q]:
                    label = cost + m[p][q][0], audit + m[p][q][1]
                    if q not in there or label < there[q][:2]:
                        there[q] = (*label, (p, way))
        here = there
    if goal is None:
        goal = min((c + end_of(q)[0], a + end_of(q)[1], q) for q, (c, a, _) in here.items())[2]
    states, way = [goal], here[goal][2]
    while way:
        states.append(way[0])
        way = way[1]
    return states[::-1]


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def summaries(pieces: DataFrame) -> DataFrame:
    """Pieces -> one row per conversation: conv_id, gaps (turn numbers missing
    between the least and the largest), counts of faults, illegal neighbours,
    cost, audit, and repaired_sha256 of the ``role:text`` lines.

    The pieces of a long conversation are read in order, one at a time; only
    the state of the digest and the audit are held.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    ddl = f"conv_id {kind}, {', '.join(c + ' long' for c in _COUNTS)}, audit string, repaired_sha256 string"
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0))
    single = pieces.where("whole").select("conv_id", gaps.cast("long").alias("gaps"), *_COUNTS[1:], "audit", F.sha2(lines, 256).alias("repaired_sha256"))

    def fold(batches):
        state, last = None, None

        def flush():
            numbers = [state["turns"], *(state[c] for c in _COUNTS[1:])]
            low, high = state["low"], state["high"]
            numbers[0] = 0 if low is None else high - low + 1 - state["turns"]
            return pa.record_batch([state["conv"], *(pa.array([v], pa.int64()) for v in numbers),
                                    pa.array(["".join(state["audit"])]), pa.array([state["sha"].hexdigest()])],
                                   names=["conv_id", *_COUNTS, "audit", "repaired_sha256"])

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if state is None or row["conv_id"] != last:
                    if state is not None:
                        yield flush()
                    last = row["conv_id"]
                    state = dict.fromkeys(_COUNTS, 0) | {"conv": batch.column(0).slice(k, 1), "turns": 0, "low": None, "high": None,
                                                         "initial": None, "audit": [], "sha": hashlib.sha256(), "lines": 0}
                for c in _COUNTS[1:]:
                    state[c] += row[c]
                if state["initial"] is not None:
                    state["illegal"] += state["initial"] + row["first"] not in _LEGAL
                state["initial"] = row["last"]
                state["audit"].append(row["audit"])
                if row["first_turn"] is not None:
                    state["turns"] += row["n_turns"] - (state["high"] == row["first_turn"])
                    state["low"] = row["first_turn"] if state["low"] is None else state["low"]
                    state["high"] = row["last_turn"]
                for r in row["repaired"]:
                    state["sha"].update(("\n" * (state["lines"] > 0) + f"{r['role']}:{r['text']}").encode())
                    state["lines"] += 1
        if state is not None:
            yield flush()

    long = pieces.where("not whole").drop("whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    return single.unionByName(long.mapInArrow(fold, ddl))
