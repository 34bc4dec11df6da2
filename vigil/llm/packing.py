"""Best-fit packing with swap-based local search.

Documents are tokenised once; only those longer than a sequence are cut (the
first piece takes the remainder, so every other piece fills a sequence).  The
shorter pieces are dealt by a row number's hash into groups of about
``GROUP_ITEMS``; a group is packed best-fit decreasing and then improved by
local search: a document of the emptiest underfull bin moves into another
underfull bin, or is exchanged one-for-one, one-for-two or two-for-one, whenever
that raises the summed squared fill, until the emptiest bin is empty and goes.
Bins that stay clearly underfull meet those of other groups on the next level,
where the search goes on, until one group is left or a level neither fills nor
empties ``MIN_GAIN`` of the bins that came in: what is left then has no partners
(say, only documents of more than half a sequence) and its bins stay as they
are.  So the number of open bins falls by that share with every level, and no
task holds more than one group.  Rows are dealt by number, not by length: a
length that a third of the rows share is spread over all groups alike.

Null text counts as empty (its one id is the end mark); equal rows are packed
one by one; an empty table gives an empty result.  Extra columns are ignored.
"""
from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import held, staged

CAPACITY = 1024
END_ID = 2
GROUP_ITEMS = 16_384
OPEN_FILL = 0.98          # bins filled less go to the next level
MIN_GAIN = 0.01           # share of the open bins that a level must fill or empty for another one to follow

LONG_RUN = 50_000         # characters of a run that only ``tokenizers`` encodes
_RUNS = re.compile(r"\s+|\S+")

# ------------------------------------------------------------------ tokens
class Encoder:
    """Ids of a byte-level BPE file of ``tokenizers``.

    ``tiktoken`` merges by the same ranks several times faster, so it does the
    bulk, with the ranks taken from the file itself; the first text of every
    batch is encoded by ``tokenizers`` too and must give the same ids.  A text
    that holds an added token of the file, or a run of white space or of other characters of at least ``LONG_RUN``
    (too long for the other library's pattern matcher), is encoded by ``tokenizers`` alone.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, sorted(special))) if special else r"(?!)")
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in w): i for w, i in self.tokenizer.get_vocab().items() if w not in special}
        self.fast = tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if self.added.search(text) or _has_long_run(text):
            return np.asarray(self._slow(text), "<u4").tobytes()
        return np.asarray(self.fast.encode_ordinary(text), "<u4").tobytes()

    def _slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def check(self, text: str) -> None:
        if self.ids(text) != np.asarray(self._slow(text), "<u4").tobytes():
            raise ValueError("the merge ranks do not reproduce the tokenizer file")


def _has_long_run(text: str) -> bool:
    if len(text) < LONG_RUN:
        return False
    return any(m.end() - m.start() >= LONG_RUN for m in _RUNS.finditer(text))


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the rest."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, n, capacity)]


def _tokenise(path: str, capacity: int, end_id: int):
    tail = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(("packing", path), lambda: Encoder(path))
        for b in batches:
            ids, rows = [], []
            if b.num_rows:
                encoder.check(b.column(1)[0].as_py() or "")
            for d, t in zip(b.column(0), b.column(1)):
                data = encoder.ids(t.as_py() or "") + tail
                for k, (s, n) in enumerate(cut(len(data) // 4, capacity)):
                    ids.append(d.as_py())
                    rows.append((k, s, n, zlib.crc32(data[4 * s:4 * (s + n)])))
            piece, start, length, crc = (np.asarray([r[i] for r in rows], np.int64) for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_tokenise(tokenizer_path, capacity, end_id), _PIECE)


# ------------------------------------------------------------------ search
def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of item numbers."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0                                                   # bit g: some bin has gap g
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        s = sizes[i]
        rest = mask >> s
        if rest:
            gap = s + (rest & -rest).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                mask ^= 1 << gap
        else:
            b, gap = len(bins), capacity
            bins.append([])
        bins[b].append(i)
        if gap > s:
            by_gap[gap - s].append(b)
            mask |= 1 << (gap - s)
    return bins


class _Index:
    """Which underfull bins hold a unit (nothing, a document or two) of a given size, by gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros((capacity + 1, capacity + 1), np.int32)      # [gap, size]
        self.best = np.full(capacity + 1, -1, np.int64)                    # largest gap per size
        self.bins: dict[tuple[int, int], set[int]] = defaultdict(set)

    def add(self, b: int, gap: int, sizes) -> None:
        for s in sizes:
            self.bins[gap, s].add(b)
            self.count[gap, s] += 1
            if gap > self.best[s]:
                self.best[s] = gap

    def drop(self, b: int, gap: int, sizes) -> None:
        for s in sizes:
            self.bins[gap, s].discard(b)
            self.count[gap, s] -= 1
            if not self.count[gap, s] and gap == self.best[s]:
                left = np.flatnonzero(self.count[:gap, s])
                self.best[s] = left[-1] if len(left) else -1

    def tightest(self, size: int) -> int | None:
        """The fullest bin with room for a document of this size (for the index of plain moves)."""
        gaps = np.flatnonzero(self.count[size:, 0])
        return next(iter(self.bins[size + int(gaps[0]), 0])) if len(gaps) else None

    def find(self, total: int) -> tuple[int, int] | None:
        """(bin, size s) with s < total and total - s <= gap: an exact fit, else the largest shift."""
        s = np.arange(total)
        exact = np.flatnonzero(self.count[total - s, s])
        if len(exact):
            s = int(exact[0])
            return next(iter(self.bins[total - s, s])), s
        loose = np.flatnonzero(self.best[:total] >= total - s)
        if len(loose):
            s = int(loose[0])
            return next(iter(self.bins[int(self.best[s]), s])), s
        return None


def improve(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Local search over the underfull bins; returns the bins that are left.

    Donors are taken emptiest first.  A step gives a larger unit for a smaller
    one (or none) of a receiver with room for the difference, and only if the
    receiver ends fuller than the donor was, so the summed squared fill rises
    with every step and the search ends; it ends when no donor has a step left.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    zero, single, pair = _Index(capacity), _Index(capacity), _Index(capacity)

    def units(b):
        own = sorted({sizes[i] for i in bins[b]})
        many = {s for s in own if sum(sizes[i] == s for i in bins[b]) > 1}
        return own, {x + y for k, x in enumerate(own) for y in own[k + 1:]} | {2 * s for s in many}

    def enter(b):
        gap = capacity - fill[b]
        if gap > 0 and bins[b]:
            one, two = units(b)
            zero.add(b, gap, [0])
            single.add(b, gap, one)
            pair.add(b, gap, two)

    def leave(b):
        gap = capacity - fill[b]
        if gap > 0 and bins[b]:
            one, two = units(b)
            zero.drop(b, gap, [0])
            single.drop(b, gap, one)
            pair.drop(b, gap, two)

    def pick(b, total, n):
        """Items of bin b: n of them with this total size."""
        if n == 0:
            return []
        if n == 1:
            return [next(i for i in bins[b] if sizes[i] == total)]
        at = {}
        for i in bins[b]:
            if total - sizes[i] in at:
                return [at[total - sizes[i]], i]
            at.setdefault(sizes[i], i)
        raise AssertionError("no such pair")

    def exchange(donor, give, b, take):
        out, back = pick(donor, *give), pick(b, *take)
        leave(b)
        bins[donor] = [i for i in bins[donor] if i not in out] + back
        bins[b] = [i for i in bins[b] if i not in back] + out
        shift = give[0] - take[0]
        fill[donor] -= shift
        fill[b] += shift
        enter(b)

    def step(donor):
        one, two = units(donor)
        for total in reversed(one):
            b = zero.tightest(total)
            if b is not None and fill[b] + total > fill[donor]:
                exchange(donor, (total, 1), b, (0, 0))
                return True
        for total in reversed(one):
            for index, n in ((single, 1), (pair, 2)):
                hit = index.find(total)
                if hit and fill[hit[0]] + total - hit[1] > fill[donor]:
                    exchange(donor, (total, 1), hit[0], (hit[1], n))
                    return True
        for total in sorted(two, reverse=True):
            if total <= capacity:
                hit = single.find(total)
                if hit and fill[hit[0]] + total - hit[1] > fill[donor]:
                    exchange(donor, (total, 2), hit[0], (hit[1], 1))
                    return True
        return False

    for b in range(len(bins)):
        enter(b)
    moved = True
    while moved:
        moved = False
        order = sorted((b for b in range(len(bins)) if bins[b] and fill[b] < capacity), key=lambda b: fill[b])
        for donor in order:
            if not bins[donor] or fill[donor] >= capacity:
                continue
            leave(donor)
            while bins[donor] and step(donor):
                moved = True
            if bins[donor]:
                enter(donor)
    return [b for b in bins if b]


def _pack_group(level: int, capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["seq", "rid"], ignore_index=True)
        sizes = pdf["length"].tolist()
        if level == 0:
            bins = best_fit(sizes, capacity)
        else:
            bins = [list(g) for g in pdf.groupby("seq").indices.values()]
        bins = improve(bins, sizes, capacity)
        seq, offset, fill = (np.zeros(len(pdf), np.int64) for _ in range(3))
        base = (level << 50) + (int(pdf["grp"].iloc[0]) << 24)      # 2^13 levels, 2^26 groups, 2^24 bins
        for k, b in enumerate(bins):
            at = 0
            for i in b:
                seq[i], offset[i] = base + k, at
                at += sizes[i]
            fill[b] = at
        return pdf.assign(seq=seq, offset=offset, fill=fill)
    return run


def pack(parts: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS,
         open_fill: float = OPEN_FILL) -> DataFrame:
    """The pieces with sequence_id and offset (gapless from 0 in each sequence)."""
    cols = parts.columns
    rows = staged(parts.withColumn("rid", F.monotonically_increasing_id()), "packing-pieces")
    full = rows.where(F.col("length") >= capacity).select(
        *cols, (-F.col("rid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out, todo, level = [full], rows.where(F.col("length") < capacity).withColumn("seq", F.lit(0).cast("long")), 0
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, grp long, seq long, offset long, fill long"
    n = bins = todo.count()                                             # pieces, and the open bins that they are in
    while n:
        groups = -(-n // group_items)
        key = F.col("rid") if level == 0 else F.col("seq")              # later levels keep a bin together
        dealt = todo.withColumn("grp", F.pmod(F.xxhash64(key, F.lit(level)), F.lit(groups)))
        packed = staged(dealt.select(*rows.columns, "grp", "seq").groupBy("grp")
                        .applyInPandas(_typed(_pack_group(level, capacity)), schema), "packing-level")
        still = packed.where(F.col("fill") < open_fill * capacity)
        n, left = still.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
        last = groups == 1 or left > (1 - MIN_GAIN) * bins
        done = packed if last else packed.where(F.col("fill") >= open_fill * capacity)
        out.append(done.select(*cols, F.col("seq").alias("sequence_id"), "offset"))
        if last:
            break
        todo, bins, level = still.select(*rows.columns, "seq"), left, level + 1
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result


def _typed(fn):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fn(pdf)
        return out[[c for c in out.columns if c not in ("grp", "seq", "offset", "fill")] + ["grp", "seq", "offset", "fill"]]
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, tokenizer_path, id_col, text_col, capacity), capacity)
