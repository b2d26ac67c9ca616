"""SentencePiece (BPE model) encoding and decoding in vectorised merge rounds.

All texts of a batch become one flat array of symbols. It is cut into words:
between two characters that stand side by side in no piece nothing can merge.
Equal words are encoded once. In every round each word finds the least rank of
its neighbouring pairs (a segmented minimum), merges it at its leftmost places,
in all words at once, and the array is compacted, until no pair remains.

Several places of a word merge in one round only as far as the library, which
merges one place at a time, would do the same: while the pairs that a merge
makes rank behind it. Long words (unsplit text) would need as many rounds as
they have ranks. There a pair merges as soon as it is the least within
``longest`` symbols on both sides: no piece reaches farther, so nothing
outside can come before it.
"""

from __future__ import annotations

import codecs

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import worker_state

FLUSH_CHARS = 1 << 19
LONG_WORD = 64
MARK = "▁"
_NONE = np.int32(2**31 - 1)
_BITS = 21  # vocabulary ids and code points after them


class PairTable:
    """Pairs of symbols -> (rank, symbol they become), as an open hash table."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.mask = (1 << max(4, (4 * len(pairs)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.rank = np.full(self.mask + 1, _NONE, dtype=np.int32)
        self.into = np.zeros(self.mask + 1, dtype=np.int32)
        for (left, right), (rank, into) in pairs.items():
            key = left << _BITS | right
            at = int(self._slot(np.array([key], dtype=np.int64))[0])
            while self.keys[at] != -1:
                at = (at + 1) & self.mask
            self.keys[at], self.rank[at], self.into[at] = key, rank, into

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x >> np.uint64(32)) & np.uint64(self.mask)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (left.astype(np.int64) << _BITS) | right
        at = self._slot(keys)
        there = self.keys[at]
        todo = np.flatnonzero((there != keys) & (there != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            there = self.keys[at[todo]]
            todo = todo[(there != keys[todo]) & (there != -1)]
        return self.rank[at], self.into[at]


def _one_byte(error: UnicodeDecodeError):
    return "�", error.start + 1


codecs.register_error("tagloom-byte", _one_byte)


class PieceRounds:
    """Encoder and decoder of one sentencepiece BPE model file."""

    def __init__(self, path: str, long_word: int = LONG_WORD, slice_chars: int = FLUSH_CHARS):
        import sentencepiece

        model = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.long, self.slice = long_word, slice_chars
        size = self.size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError("unused pieces need another segmentation")
        pieces = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        if not all(model.is_byte(int(i)) for i in self.byte_ids):
            raise ValueError("the model spells no unknown characters in bytes")
        own = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.longest = max(map(len, own))
        # a character that is no piece is named by its code point, after the vocabulary
        self.symbol = (np.arange(0x110000) + size).astype(np.int32)
        for p, i in own.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        ranks = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in own.values()}, reverse=True))}

        def name(part: str) -> int | None:
            return own.get(part, size + ord(part) if len(part) == 1 else None)

        pairs, side = {}, {}
        for p, i in own.items():
            for k in range(1, len(p)):
                left, right = name(p[:k]), name(p[k:])
                if left is not None and right is not None:
                    pairs[left, right] = ranks[model.get_score(i)], i
                side[ord(p[k - 1]), ord(p[k])] = 0, 0
        self.pairs, self.side = PairTable(pairs), PairTable(side)
        self.spelled = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else
                        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]

    # ------------------------------------------------------------ encoding

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the library gives them for the whole text."""
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        points = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
        sizes = np.array([len(m) for m in marked], dtype=np.int64)
        first = np.cumsum(sizes) - sizes
        cut = np.ones(len(points), dtype=bool)  # a word starts here
        if len(points) > 1:
            for a in range(1, len(points), self.slice):  # bounded temporary arrays
                z = min(len(points), a + self.slice)
                cut[a:z] = self.side.find(points[a - 1:z - 1], points[a:z])[0] == _NONE
        cut[first[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        ids, lengths = [], []
        at = 0
        while at < len(starts):  # slices of whole words
            to = int(np.searchsorted(starts, starts[at] + self.slice, side="right"))
            to = max(to - 1, at + 1) if to < len(starts) else len(starts)
            end = int(starts[to]) if to < len(starts) else len(points)
            got, n = self._words(points[starts[at]:end], starts[at:to] - starts[at])
            ids.append(got)
            lengths.append(n)
            at = to
        flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]) if lengths else np.zeros(1, dtype=np.int64)
        words = np.searchsorted(starts, [*first, len(points)])  # a text's first word; empty texts have none
        return [flat[ends[a]:ends[z]] for a, z in zip(words, words[1:])]

    def _words(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of a slice -> (their ids one after another, ids of each)."""
        sizes = np.diff(starts, append=len(points))
        place = np.arange(len(points)) - np.repeat(starts, sizes)
        factor = np.multiply.accumulate(np.full(int(sizes.max()), 0xD6E8FEB86659FD93, dtype=np.uint64))
        x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        named = np.add.reduceat((x ^ (x >> np.uint64(29))) * factor[place], starts)
        _, one, of = np.unique(named, return_index=True, return_inverse=True)
        # words of one name must be equal letter by letter; others stand for themselves
        odd = sizes[one[of]] != sizes
        same = points[np.minimum(starts[one[of]].repeat(sizes) + place, len(points) - 1)] == points
        odd |= ~np.logical_and.reduceat(same, starts)
        if odd.any():
            alone = np.flatnonzero(odd)
            of[alone] = len(one) + np.arange(len(alone))
            one = np.concatenate([one, alone])
        n = sizes[one]
        symbols = self.symbol[points[np.repeat(starts[one] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]]
        word = np.repeat(np.arange(len(one)), n)
        short = (n <= self.long)[word]
        done = [self._rounds(symbols[short], word[short], None)]
        for w in np.flatnonzero(n > self.long):
            a, z = np.searchsorted(word, [w, w + 1])
            done.append(self._rounds(symbols[a:z], word[a:z], self.longest))
        symbols, word = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(word, kind="stable")
        symbols, word = self._bytes(symbols[order], word[order])
        n = np.bincount(word, minlength=len(one))
        begin = np.cumsum(n) - n
        lengths = n[of]
        at = np.repeat(begin[of] - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
        return symbols[at].astype(np.int32), lengths

    def _rounds(self, symbols: np.ndarray, word: np.ndarray, reach: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Merge until no pair remains. ``reach``: None compares a pair with its
        whole word, a number with so many neighbours (one word at a time)."""
        out = []
        rank = np.full(len(symbols), _NONE, dtype=np.int32)  # of the pair that starts here
        into = np.zeros(len(symbols), dtype=np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside], into[inside] = self.pairs.find(symbols[inside], symbols[inside + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(starts, append=len(word))
            least = np.minimum.reduceat(rank, starts)
            over = least == _NONE
            if over.any():  # words without a pair leave
                gone = np.repeat(over, sizes)
                out.append((symbols[gone], word[gone]))
                if over.all():
                    break
                symbols, word, rank, into = symbols[~gone], word[~gone], rank[~gone], into[~gone]
                sizes, least = sizes[~over], least[~over]
            at = self._places(rank, np.repeat(least, sizes) if reach is None else _near_least(rank, reach))
            left, right, bad = self._beside(symbols, word, rank, into, at)
            if bad.any():  # of a word's places those up to its first bad one
                w = word[at]
                before = np.cumsum(bad) - bad
                keep = before == before[np.searchsorted(w, w)]
                at, left, right = at[keep], tuple(c[keep] for c in left), tuple(c[keep] for c in right)
            symbols[at] = into[at]
            rank[at], into[at] = right
            has = left[2] >= 0
            rank[left[2][has]], into[left[2][has]] = left[0][has], left[1][has]
            stay = np.ones(len(symbols), dtype=bool)
            stay[at + 1] = False
            symbols, word, rank, into = symbols[stay], word[stay], rank[stay], into[stay]
        return (np.concatenate([s for s, _ in out]), np.concatenate([w for _, w in out])) if out else (symbols, word)

    @staticmethod
    def _places(rank: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Pairs that merge now: the least ones, of overlapping ones every
        second from the left."""
        take = (rank == least) & (rank != _NONE)
        new = np.concatenate([[True], rank[1:] != rank[:-1]])
        run = np.maximum.accumulate(np.where(new, np.arange(len(rank)), 0))
        return np.flatnonzero(take & take[run] & ((np.arange(len(rank)) - run) % 2 == 0))

    def _beside(self, symbols, word, rank, into, at):
        """The pairs that the merges make: (rank, into, place) with the left
        neighbour, (rank, into) with the right one, and whether one of them
        would come before the merge's own rank."""
        n, own = len(symbols), rank[at]
        made = into[at]
        joined = np.concatenate([[False], at[1:] == at[:-1] + 2])  # the left neighbour was merged as well
        before = at - 1 - joined
        has = (before >= 0) & (word[before] == word[at])
        neighbour = np.where(joined, np.concatenate([[0], made[:-1]]), symbols[before])
        r, i = self.pairs.find(neighbour, made)
        left = np.where(has, r, _NONE), i, np.where(has, before, -1)
        after = np.minimum(at + 2, n - 1)
        has = (at + 2 < n) & (word[after] == word[at])
        r, i = self.pairs.find(made, symbols[after])
        right = np.where(has, r, _NONE), i
        return left, right, (left[0] <= own) | (right[0] <= own)

    def _bytes(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece, spelled in UTF-8 bytes."""
        point = symbols - self.size
        if not (point >= 0).any():
            return symbols, word
        n = np.where(point < 0x80, 1, np.where(point < 0x800, 2, np.where(point < 0x10000, 3, 4)))
        point, long, k = np.repeat(point, n), np.repeat(n, n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        part = point >> (6 * (long - 1 - k)).astype(np.int32)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[long]
        byte = np.where(long == 1, point, np.where(k == 0, lead | part, 0x80 | (part & 0x3F)))
        return np.where(point < 0, np.repeat(symbols, n), self.byte_ids[np.where(point < 0, 0, byte)]), np.repeat(word, n)

    # ------------------------------------------------------------ decoding

    def decode(self, ids) -> str:
        """Text of ids as the library's: control ids are silent, one leading
        blank mark goes, bytes that are no UTF-8 become U+FFFD."""
        parts = list(map(self.spelled.__getitem__, ids))
        for k, i in enumerate(ids):
            if parts[k]:
                if parts[k][:1] == b" " and not self.library.is_byte(int(i)) and not self.library.is_unknown(int(i)):
                    parts[k] = parts[k][1:]
                break
        return b"".join(parts).decode("utf-8", "tagloom-byte")


def _near_least(rank: np.ndarray, reach: int) -> np.ndarray:
    """The least of every value's neighbours up to ``reach`` places away, or
    somewhat farther."""
    least, step, covered = rank.copy(), 1, 0
    while covered < reach:
        if step < len(rank):
            wide = least.copy()
            np.minimum(wide[step:], least[:-step], out=wide[step:])
            np.minimum(wide[:-step], least[step:], out=wide[:-step])
            least = wide
        covered += step
        step *= 2
    return least


_DDL = "doc_id long, ids array<int>, decoded string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def piece_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, ids (as the library encodes the whole
    text, without begin or end ids), decoded (the text of those ids).

    Null texts count as empty: no ids. Repeated rows are encoded each; there
    are no ties. Texts of any length are encoded whole, in slices of whole
    words. No rows give no rows; other columns are ignored.
    """
    def trip(batches):
        rounds = worker_state(PieceRounds, path)

        def flush(doc_ids, texts):
            ids = rounds.encode_all(texts)
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            decoded = [rounds.decode(x.tolist()) for x in ids]
            values = pa.array(np.concatenate(ids), pa.int32())
            return pa.record_batch([pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values),
                                    pa.array(decoded, pa.string())], schema=_SCHEMA)

        doc_ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                doc_ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if held > FLUSH_CHARS:
                    yield flush(doc_ids, texts)
                    doc_ids, texts, held = [], [], 0
        if doc_ids:
            yield flush(doc_ids, texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trip, _DDL)
