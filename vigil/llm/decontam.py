"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A test string is a window of ``WINDOW`` consecutive words of a benchmark item
(the whole item if it is shorter).  All windows of one length m share three
tables: a shift table indexed by a hash of the ``B`` words that end at the
scan position (how far the scan may jump when no window can end sooner),
buckets of the windows whose own last block hashes alike, and the windows'
bytes.  The scan runs over many stretches of text at once: every lane looks up
its shift and jumps; lanes at shift 0 look into their bucket, and candidates
are confirmed by direct comparison of the words' bytes.

The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of text; documents
are searched once per block and the hits of one document are merged, so the
broadcast tables have a size bound however large the benchmark grows.

Null and word-less texts have no words and no hits, null or word-less items
have no windows, equal items are all reported, a null item id is reported as
``null``.  Empty tables give empty (documents) or hit-less (benchmark) results.
Extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import held, staged

WINDOW = 10
BLOCK_BYTES = 4 << 20
_CHUNK = 1 << 20                 # bytes of text scanned at once
_LANE = 256                      # scan positions of one lane
_SLOTS = 20                      # log2 of the shift table
_P = np.uint64(0x100000001B3)    # odd, so that it has an inverse modulo 2^64
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: digits, a-z and every byte of a character beyond ASCII
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_P, _CHUNK + 1)
_DOWN = _powers(np.uint64(pow(int(_P), -1, 1 << 64)), _CHUNK + 1)


class Words:
    """The words of some texts: bytes, start and end of each word, its hash, and each text's first word."""

    def __init__(self, texts: list[bytes | None]):
        parts = [t or b"" for t in texts]
        self.data = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
        word = np.concatenate([[False], _IS_WORD[self.data]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        self.start, self.end = edge[0::2], edge[1::2]
        first_byte = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        self.first = np.searchsorted(self.start, first_byte)        # len(texts) + 1
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Polynomial hash of each word, from prefix sums over pieces of the buffer."""
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(out):
            base = int(self.start[at])
            to = max(at + 1, int(np.searchsorted(self.end, base + _CHUNK, "right")))
            piece = self.data[base:int(self.end[to - 1])]
            up, down = (_UP, _DOWN) if len(piece) <= _CHUNK else (
                _powers(_P, len(piece) + 1), _powers(np.uint64(pow(int(_P), -1, 1 << 64)), len(piece) + 1))
            total = np.concatenate([[np.uint64(0)], np.cumsum((piece + np.uint64(1)) * up[:len(piece)], dtype=np.uint64)])
            s, e = self.start[at:to] - base, self.end[at:to] - base
            out[at:to] = (total[e] - total[s]) * down[s]
            at = to
        return out


def _block(hashes: np.ndarray, ends: np.ndarray, b: int) -> np.ndarray:
    """Hash of the ``b`` words that end at each of ``ends``."""
    out = np.zeros(len(ends), np.uint64)
    for i in range(b):
        out = out + (hashes[ends - i] ^ (hashes[ends - i] >> np.uint64(29))) * _MIX[i]
    return out ^ (out >> np.uint64(31))


class Search:
    """Wu-Manber tables of the windows of length ``m`` of some items."""

    def __init__(self, words: Words, starts: np.ndarray, item: np.ndarray, m: int):
        self.m, self.b = m, 3 if m >= 6 else min(2, m)
        self.words, self.starts, self.item = words, starts, item
        self.shift = np.full(1 << _SLOTS, m - self.b + 1, np.int64)
        for j in range(self.b - 1, m):                     # blocks ending at word j of a window
            slot = self._slot(_block(words.hash, starts + j, self.b))
            np.minimum.at(self.shift, slot, m - 1 - j)
        suffix = _block(words.hash, starts + m - 1, self.b)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.starts, self.item = suffix[order], starts[order], item[order]
        self.prefix = words.hash[self.starts]

    @staticmethod
    def _slot(block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def occurrences(self, text: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word in the text, item) of every occurrence of a window."""
        lo, hi = text.first[:-1] + self.m - 1, text.first[1:]
        n = np.maximum(0, -(-(hi - lo) // _LANE))
        lane_text = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(lane_text)) - np.repeat(np.cumsum(n) - n, n)
        at = lo[lane_text] + nth * _LANE
        stop = np.minimum(at + _LANE, hi[lane_text])
        found = []
        while len(at):
            block = _block(text.hash, at, self.b)
            jump = self.shift[self._slot(block)]
            zero = jump == 0
            if zero.any():
                found.append((at[zero], block[zero]))
            at = at + np.maximum(jump, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        starts, items = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if found:
            ends, block = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            left, right = np.searchsorted(self.suffix, block, "left"), np.searchsorted(self.suffix, block, "right")
            size = right - left
            some = size > 0
            ends, left, size = ends[some], left[some], size[some]
            cut = np.searchsorted(np.cumsum(size), np.arange(0, size.sum(), 1 << 18))   # bounded slices
            cut = np.unique(np.append(cut, len(size)))
            for i, j in zip(cut[:-1], cut[1:]):
                n = size[i:j]
                k = np.repeat(left[i:j] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                first = np.repeat(ends[i:j], n) - self.m + 1
                same = text.hash[first] == self.prefix[k]
                first, k = first[same], k[same]
                same = self._equal(text, first, k)
                starts.append(first[same])
                items.append(self.item[k[same]])
        return np.concatenate(starts), np.concatenate(items)

    def _equal(self, text: Words, first: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Direct comparison of the bytes of the windows."""
        if not len(first):
            return np.zeros(0, bool)
        step = np.arange(self.m)
        a, b = (first[:, None] + step), (self.starts[k][:, None] + step)
        la, lb = text.end[a] - text.start[a], self.words.end[b] - self.words.start[b]
        ok = (la == lb).all(axis=1)
        rows = np.flatnonzero(ok)
        if len(rows):
            n = la[rows].ravel()
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x = text.data[np.repeat(text.start[a[rows]].ravel(), n) + inner]
            y = self.words.data[np.repeat(self.words.start[b[rows]].ravel(), n) + inner]
            per_row = la[rows].sum(axis=1)
            ok[rows] = np.logical_and.reduceat(x == y, np.cumsum(per_row) - per_row)
        return ok


def build(items: list[bytes | None], window: int = WINDOW) -> list[Search]:
    """One table set per window length found in the items."""
    words = Words(items)
    count = np.diff(words.first)
    out = []
    for m in sorted({int(min(c, window)) for c in count if c}):
        own = np.flatnonzero(count >= window) if m == window else np.flatnonzero(count == m)
        n = count[own] - m + 1
        starts = np.repeat(words.first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out.append(Search(words, starts, np.repeat(own, n), m))
    return out


def _scan(shared, window: int, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = shared.value
        # the items are kept beside their tables, so that their number stays theirs
        searches = held(("decontam", id(ids)), lambda: (ids, build(texts, window)))[1]
        for batch in batches:
            col, i = batch.column(1), 0
            while i < batch.num_rows:
                docs, size, first = [], 0, i
                while i < batch.num_rows and size < _CHUNK:
                    docs.append(col[i].as_py())
                    size += len(docs[-1] or b"")
                    i += 1
                words = Words(docs)
                n_words = np.diff(words.first)
                begins, owner = np.zeros(len(words.start) + 1, np.int64), []
                for s in searches:
                    at, item = s.occurrences(words)
                    np.add.at(begins, at, 1)
                    np.add.at(begins, at + s.m, -1)
                    owner.append(np.stack([np.searchsorted(words.first, at, "right") - 1, item]))
                hit = np.cumsum(begins)[:-1] > 0
                total = np.concatenate([[0], np.cumsum(hit)])
                n_hit = total[words.first[1:]] - total[words.first[:-1]]
                found: list[set] = [set() for _ in docs]
                if owner:
                    for d, k in np.unique(np.concatenate(owner, axis=1), axis=1).T:
                        found[d].add(ids[k])
                out = [batch.column(0).slice(first, len(docs)), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                       pa.array([sorted(f) for f in found], pa.list_(pa.string()))]
                names = ["doc_id", "n_words", "n_hit", "items"]
                if spans:
                    edge = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
                    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                    rows: list[list] = [[] for _ in docs]
                    for x, y in zip(a, b):     # a run may cross from one text into the next
                        d = np.searchsorted(words.first, x, "right") - 1
                        while x < y:
                            z = min(y, words.first[d + 1])
                            if z > x:
                                rows[d].append([int(x - words.first[d]), int(z - words.first[d])])
                            x, d = z, d + 1
                    out.append(pa.array(rows, pa.list_(pa.list_(pa.int64()))))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """The items, collected one bounded block after the other."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
                            F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = staged(rows.distinct(), "decontam-items")       # a repeated row would fall into one block with all its copies
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        got = part.orderBy("item", "text").collect()
        yield n, [r["item"] for r in got], [bytes(r["text"]) for r in got]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id_col, n_words, n_hit, items) of every document; items are the ids found, sorted as strings.

    ``id_col`` may be of any type (a struct carries whole rows).
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    parts = []
    for n, ids, texts in _blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = sc.broadcast((ids, texts))
        if n == 1:
            return rows.mapInArrow(_scan(shared, window, False),
                                   f"doc_id {id_type}, n_words long, n_hit long, items array<string>") \
                .withColumnRenamed("doc_id", id_col)
        if not parts:      # several blocks: a stable row number brings the hits of one document together
            rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "decontam-docs")
        # block by block: the hits are written and the broadcast goes before the next one comes
        found = rows.select("row", "text").mapInArrow(
            _scan(shared, window, True),
            "doc_id long, n_words long, n_hit long, items array<string>, spans array<array<long>>").withColumnRenamed("doc_id", "row")
        parts.append(staged(found.where(F.lit(not parts) | (F.col("n_hit") > 0)), "decontam-hits"))
        shared.destroy()
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.union(p)
    # one row per document and block, so a group has as many rows as there are blocks
    one = merged.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def covered(spans: pd.Series) -> pd.Series:
        def length(x):
            end = total = 0
            for a, b in sorted(map(tuple, x)):
                total += max(0, b - max(a, end))
                end = max(end, b)
            return total
        return spans.map(length)

    count = F.pandas_udf(covered, "long")
    return (rows.select("row", "doc_id").join(one.withColumn("n_hit", count("spans")), "row")
            .select(F.col("doc_id").alias(id_col), "n_words", "n_hit", "items"))
