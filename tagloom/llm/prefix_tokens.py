"""Token counts by prefix dynamic programming.

The encoding of a text's prefix ends in one token, and what stands before that
token is the encoding of a shorter prefix. So the last token at every position
follows from earlier positions: of the pieces ending there, the one that is a
valid neighbour of the last token where it starts. Counts add up along the
way, and the table of all prefixes answers how many tokens a prefix has, where
to cut for a budget, and how many chunks a text needs, without encoding again.

Pieces hold the blank mark only at their start, so a text's table is made of
independent units (blank marks and the characters up to the next one), which
are kept per worker.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import worker_state

CACHE_UNITS = 250_000
CACHE_PAIRS = 1_000_000
FLUSH_CHARS = 1 << 20
MARK = "▁"
_UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")


class PrefixCounter:
    """Prefix token counts under a sentencepiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.longest = max(map(len, self.score))
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.score):
            raise ValueError("a piece holds a blank or a line end inside: units would not be independent")
        self.units, self.older, self.pairs, self.n_pairs = {}, {}, {}, 0
        self.model = model

    def merged(self, text: str) -> list[str]:
        """BPE of a short text: the best-scored neighbours merge first, the
        leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: str, right: str, known: dict) -> bool:
        """Whether the two tokens stand side by side in an encoding; kept in
        ``known``, the answers about ``left``."""
        answer = known[right] = self.merged(left + right) == ([left, right] if left else [right])
        self.n_pairs += 1
        return answer

    def unit(self, text: str) -> np.ndarray:
        """Token counts of the unit's prefixes of 1, 2, ... characters."""
        if self.n_pairs > CACHE_PAIRS:
            self.pairs, self.n_pairs = {}, 0
        score, longest, pairs = self.score, self.longest, self.pairs
        # at each position: the last token, what is known to follow it, the count
        last, after, counts = [""], [pairs.setdefault("", {})], [0]
        for end in range(1, len(text) + 1):
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                token = text[start:end]
                if token in score:
                    cost = 1
                elif start == end - 1:
                    cost = len(token.encode())  # a character without a piece is spelled in bytes
                else:
                    continue
                known = after[start]
                valid = known.get(token)
                if valid or valid is None and self.follows(last[start], token, known):
                    last.append(token)
                    after.append(pairs.get(token) or pairs.setdefault(token, {}))
                    counts.append(counts[start] + cost)
                    break
        return np.array(counts[1:], dtype=np.int32)

    def table(self, text: str) -> np.ndarray:
        """Token counts of the text's prefixes of 1, 2, ... characters."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        marked = MARK + text.replace(" ", MARK)
        if len(self.units) > CACHE_UNITS:  # what is used again moves on, the rest goes
            self.units, self.older = {}, self.units
        units, older, parts, lengths, ends = self.units, self.older, [], [], []
        for u in _UNIT.findall(marked):
            known = units.get(u)
            if known is None and older and u in older:
                known = units[u] = older[u]
            if known is None:
                counts = self.unit(u) if len(u) < 1000 or u[0] != "\n" else np.arange(1, len(u) + 1, dtype=np.int32)
                known = units[u] = (counts.tobytes(), len(u), int(counts[-1]))
            parts.append(known[0])
            lengths.append(known[1])
            ends.append(known[2])
        before = np.cumsum([0, *ends[:-1]], dtype=np.int32)
        return (np.frombuffer(b"".join(parts), dtype=np.int32) + np.repeat(before, lengths))[1:]


def prefix_tokens(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_bytes, prefix_tokens (element k: the
    tokens of the first k characters, from 1).

    Null texts count as empty: an empty table. Repeated rows are counted each.
    No rows give no rows; other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("prefix_tokens", pa.list_(pa.int32()))])

    def tables(batches):
        counter = worker_state(PrefixCounter, path)

        def flush(ids, sizes, counts):
            offsets = np.cumsum([0, *map(len, counts)], dtype=np.int32)
            values = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int32)
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], schema=schema)

        ids, sizes, counts, held = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                ids.append(doc_id)
                sizes.append(len(text.encode()))
                counts.append(counter.table(text))
                held += len(text)
                if held > FLUSH_CHARS:
                    yield flush(ids, sizes, counts)
                    ids, sizes, counts, held = [], [], [], 0
        if ids:
            yield flush(ids, sizes, counts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        tables, "doc_id long, n_bytes long, prefix_tokens array<int>")


def tokens_of(prefix: Column | str, chars: Column | int | None = None) -> Column:
    """Tokens of the first ``chars`` characters, or of the whole text."""
    prefix = F.col(prefix) if isinstance(prefix, str) else prefix
    at = F.size(prefix) if chars is None else F.least(F.lit(chars), F.size(prefix))
    return F.when(at < 1, F.lit(0)).otherwise(F.get(prefix, at - 1)).cast("long")


def fits_of(prefix: Column | str, budget: int) -> Column:
    """The most leading characters whose encoding has at most ``budget``
    tokens."""
    prefix = F.col(prefix) if isinstance(prefix, str) else prefix
    at = F.transform(prefix, lambda n, k: F.when(n <= budget, k + 1))
    return F.coalesce(F.array_max(at), F.lit(0)).cast("long")
