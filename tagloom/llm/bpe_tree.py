"""BPE encoding and decoding with tree concatenation.

Text between white space is encoded piece by piece (a piece's tokens do not
depend on its neighbours). Long unsplit text is halved until the parts are
short; the halves are encoded apart, and at each join a window of tokens on
both sides is encoded anew and widened until its first and last token agree
with the halves. A token sequence is the encoding of its text exactly when
every two neighbours in it are, so one agreeing token on each side makes the
whole exact. Texts above ``long_chars`` are halved over Spark tasks in the
same way: parts are encoded wherever there is room, and joined per document.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import worker_state

LEAF_CHARS = 2048
LONG_CHARS = 1 << 16
#: Bytes of pieces and their ids that an encoder keeps, in two generations.
CACHE_BYTES = 48 << 20
FLUSH_CHARS = 2 << 20

# Unicode's White_Space characters, which the pre-tokenizer's \s matches
_WS = "\t-\r \x85\xa0  -     　"
_PIECE = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_SPACE = re.compile(f"[{_WS}]")
#: Characters on which regex libraries differ about white space: no cuts there.
_ODD = re.compile("[\x1c-\x1f᠎​]")


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level
    vocabularies: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS):
        from tokenizers import Tokenizer

        self.library, self.leaf, self.cache = Tokenizer.from_file(path), leaf_chars, {}
        self.older: dict = {}
        self.kept = 0
        self.library.no_truncation()
        self.library.no_padding()
        added = {i: t.content for i, t in self.library.get_added_tokens_decoder().items()}
        self.longest_added = max(map(len, added.values()), default=0)
        self.added = re.compile("|".join(map(re.escape, sorted(added.values(), key=len, reverse=True))) or r"(?!)")
        self.added_ids = {t: i for i, t in added.items()}
        symbols = byte_symbols()
        self.bytes = [b""] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab().items():
            self.bytes[i] = added[i].encode() if i in added else bytes(symbols[c] for c in token)

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text, as the library gives them for the whole text."""
        if _ODD.search(text):
            return self.tree(text)
        ids, at = [], 0
        for m in self.added.finditer(text):
            self._pieces(text[at:m.start()], ids)
            ids.append(self.added_ids[m[0]])
            at = m.end()
        self._pieces(text[at:], ids)
        return ids

    def _pieces(self, text: str, ids: list[int]) -> None:
        if self.kept > CACHE_BYTES:  # what is used again moves on, the rest goes
            self.cache, self.older, self.kept = {}, self.cache, 0
        cache, older = self.cache, self.older
        for p in _PIECE.findall(text):
            known = cache.get(p)
            if known is None:
                if len(p) > self.leaf:
                    known = self.tree(p)
                else:
                    known = cache[p] = older.get(p) or tuple(self.whole(p))
                    self.kept += 200 + len(p) + 8 * len(known)  # about: dictionary slot, text, tuple
            ids.extend(known)

    def tree(self, text: str) -> list[int]:
        """Ids of unsplit text, its halves encoded apart and joined."""
        if len(text) <= self.leaf:
            return self.whole(text)
        half = len(text) // 2
        return self.join(self.tree(text[:half]), self.tree(text[half:]))

    def join(self, left: list[int], right: list[int], window: int = 8) -> list[int]:
        """Ids of the concatenation of two encoded texts."""
        while True:
            a, before = self._edge(left, max(0, len(left) - window), -1)
            b, after = self._edge(right, min(len(right), window), 1)
            mid = self.decode_bytes(left[a:] + right[:b]).decode("utf-8", "replace")
            ids = self.whole(mid)
            wide = 4 * self.longest_added  # a special string over the join lies inside the window
            if (a == 0 or len(self.decode_bytes(left[a:])) >= wide and ids and ids[0] == left[a] and self._free(before, mid)) and (
                    b == len(right) or len(self.decode_bytes(right[:b])) >= wide and ids and ids[-1] == right[b - 1] and self._free(mid, after)):
                return left[:a] + ids + right[b:]
            window *= 2

    def _edge(self, ids: list[int], at: int, step: int) -> tuple[int, str]:
        """The next token border from ``at`` that is a character border, and
        the few characters beyond it."""
        while 0 < at < len(ids) and self.bytes[ids[at]][0] & 0xC0 == 0x80:
            at += step
        beyond = ids[max(0, at - 16):at] if step < 0 else ids[at:at + 16]
        return at, self.decode_bytes(beyond).decode("utf-8", "ignore")

    @staticmethod
    def _free(before: str, after: str) -> bool:
        """Whether the pre-tokenizer reads both sides of a border alike with
        and without the other: no white space at it and no apostrophe near."""
        return bool(before and after) and "'" not in before[-3:] + after[0] and not _SPACE.search(before[-1] + after[0]) \
            and not _ODD.search(before[-1] + after[0])

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode(self, ids) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8
        become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


def _batches(rows, schema, size):
    """Record batches of at most about ``FLUSH_CHARS`` of ``size(row)``."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += size(row)
        if held > FLUSH_CHARS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_IDS_DDL = "doc_id long, ids array<int>, decoded string"


def round_trip(docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS, long_chars: int = LONG_CHARS) -> DataFrame:
    """One row per document: doc_id, ids (as the library encodes the whole
    text, no special tokens added), decoded (the text of those ids).

    Null texts count as empty: no ids. Repeated rows are encoded each. No rows
    give no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    long = F.length("text") > long_chars

    def short_texts(batches):
        bpe = worker_state(ByteBpe, path, leaf_chars)

        def each():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = bpe.encode(text.as_py())
                    yield doc_id, ids, bpe.decode(ids)

        yield from _batches(each(), _IDS, lambda row: len(row[2]) + len(row[1]))

    def cut(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.string()), ("copies", pa.int64()), ("part", pa.int64()), ("text", pa.string())])

        def each():
            for batch in batches:
                for doc_id, text, copies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                    text = text.as_py()
                    sha = hashlib.sha256(text.encode()).hexdigest()
                    for part, at in enumerate(range(0, len(text), long_chars)):
                        yield doc_id, sha, copies, part, text[at:at + long_chars]

        yield from _batches(each(), schema, lambda row: len(row[4]))

    def parts(batches):
        bpe = worker_state(ByteBpe, path, leaf_chars)
        schema = pa.schema([("doc_id", pa.int64()), ("sha", pa.string()), ("copies", pa.int64()), ("part", pa.int64()), ("ids", pa.list_(pa.int32()))])

        def each():
            for batch in batches:
                for row in batch.to_pylist():
                    yield row["doc_id"], row["sha"], row["copies"], row["part"], bpe.encode(row["text"])

        yield from _batches(each(), schema, lambda row: len(row[4]))

    schema = _IDS.append(pa.field("copies", pa.int64()))

    def joined(table):
        bpe = worker_state(ByteBpe, path, leaf_chars)
        of = dict(zip(table.column("part").to_pylist(), table.column("ids")))
        row = [of[k].as_py() for k in sorted(of)]
        while len(row) > 1:  # neighbours pair up, as in a tree
            row = [bpe.join(*row[k:k + 2]) if len(row[k:k + 2]) == 2 else row[k] for k in range(0, len(row), 2)]
        doc_id, copies = (table.column(c)[0].as_py() for c in ("doc_id", "copies"))
        return pa.table([pa.array([x], f.type) for x, f in zip((doc_id, row[0], bpe.decode(row[0]), copies), schema)], schema=schema)

    # copies of a long text are one row from before it is cut until after it is joined
    counted = rows.where(long).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    cuts = counted.mapInArrow(cut, "doc_id long, sha string, copies long, part long, text string")
    encoded = cuts.repartition("sha", "part").mapInArrow(parts, "doc_id long, sha string, copies long, part long, ids array<int>")
    whole = encoded.groupBy("doc_id", "sha").applyInArrow(joined, _IDS_DDL + ", copies long").select(
        "doc_id", "ids", "decoded", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")
    return rows.where(~long).mapInArrow(short_texts, _IDS_DDL).unionByName(whole)
