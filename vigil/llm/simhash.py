"""SimHash near-duplicates by tiled exact comparison.

A document's fingerprint is the bitwise majority of the XXH64 values of its
word shingles.  Distinct fingerprints are cut into tiles of equal population
counts (one count per 16-bit quarter of the fingerprint, so the Hamming
distance of two fingerprints is at least the summed difference of their
counts).  Tile pairs whose counts differ by more than the radius in sum are
skipped; the others are compared completely with numpy exclusive-or and bit
counts.  A tile pair hands on spanning links only, never all pairs of a group,
and connected components give every document the least id of its group.

Null text counts as empty; a document without words has fingerprint zero and
links like any other.  Equal texts share a fingerprint, which is compared once.
An empty table gives an empty result.  Extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import held, staged
from vigil.llm.components import connected_components, spanning_links

SHINGLE = 3
RADIUS = 3
SEED = 42
SEGMENTS = 4          # population counts per fingerprint
TILE_ROWS = 2048      # fingerprints in a tile at most (on average, where a count signature is crowded)
_CHUNK = 1 << 16      # shingles whose bits are unpacked at once


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit majority fingerprint of one text (0 for no words)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        grams = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        grams = [joined[s:e] for s, e in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(g, seed) for g in grams], np.uint64, len(grams))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _CHUNK):
        bits = np.unpackbits(h[i:i + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def _fingerprints(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("simhash", dict)          # needs no tables: those of an operator before it go
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(width, seed), "doc_id long, fp long")


def signature(fp: Column) -> Column:
    """Population counts of the fingerprint's quarters, as digits of one int (base 17)."""
    bits = 64 // SEGMENTS
    out = F.lit(0)
    for i in range(SEGMENTS):
        part = F.shiftrightunsigned(fp, i * bits).bitwiseAND(F.lit((1 << bits) - 1))
        out = out * F.lit(bits + 1) + F.bit_count(part)
    return out.cast("int")


def _neighbours(sig: Column, radius: int) -> Column:
    """Signatures not below ``sig`` whose counts differ by at most ``radius`` in sum."""
    base = 64 // SEGMENTS + 1
    digits = [F.pmod(F.floor(sig / F.lit(base ** (SEGMENTS - 1 - i))), F.lit(base)).cast("int") for i in range(SEGMENTS)]
    options = []
    for step in product(range(-radius, radius + 1), repeat=SEGMENTS):
        if sum(map(abs, step)) <= radius and step >= (0,) * SEGMENTS:
            offset = sum(d * base ** (SEGMENTS - 1 - i) for i, d in enumerate(step))
            ok = F.lit(True)
            for d, digit in zip(step, digits):
                if d > 0:
                    ok = ok & (digit + F.lit(d) < F.lit(base))
                elif d < 0:
                    ok = ok & (digit + F.lit(d) >= F.lit(0))
            options.append(F.when(ok, sig + F.lit(offset)))
    return F.array_compact(F.array(*options))


def _compare(radius: int):
    """Spanning links of the tile pairs (left, right) of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys, held = [], [], 0
        for b in batches:
            same = b.column(0).to_pylist()
            left, right = b.column(1), b.column(2)
            for i in range(b.num_rows):
                x = left[i].values.to_numpy()
                y = x if same[i] else right[i].values.to_numpy()
                step = max(1, (1 << 20) // max(1, len(y)))
                for k in range(0, len(x), step):
                    near = np.bitwise_count((x[k:k + step, None] ^ y[None, :]).view(np.uint64)) <= radius
                    p, q = np.nonzero(near)
                    if same[i]:
                        keep = p + k < q
                        p, q = p[keep], q[keep]
                    if len(p):
                        u, v = spanning_links(x[p + k], y[q])
                        xs.append(u)
                        ys.append(v)
                        held += len(u)
                if held > 200_000:
                    u, v = spanning_links(np.concatenate(xs), np.concatenate(ys))
                    xs, ys, held = [u], [v], len(u)
                    if held > 100_000:
                        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                        xs, ys, held = [], [], 0
        if xs:
            u, v = spanning_links(np.concatenate(xs), np.concatenate(ys))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
    return run


def links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints (column fp) within ``radius`` bits."""
    rows = distinct.select("fp", signature(F.col("fp")).alias("sig"))
    # at most 17^4 signatures: the crowding table is bounded whatever the data size
    crowd = rows.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).cast("int").alias("subs"))
    tiles = (rows.join(F.broadcast(crowd), "sig")
             .withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")).cast("int"))
             .groupBy("sig", "sub").agg(F.sort_array(F.collect_list("fp")).alias("fps")))
    tiles = staged(tiles, "simhash-tiles")
    here = tiles.select("sig", "sub")
    pairs = (here.select(F.col("sig").alias("lsig"), F.col("sub").alias("lsub"),
                         F.explode(_neighbours(F.col("sig"), radius)).alias("sig"))
             .join(here, "sig")
             .where((F.col("lsig") != F.col("sig")) | (F.col("lsub") <= F.col("sub")))
             .select("lsig", "lsub", F.col("sig").alias("rsig"), F.col("sub").alias("rsub")))
    pairs = staged(pairs, "simhash-pairs")
    left = tiles.select(F.col("sig").alias("lsig"), F.col("sub").alias("lsub"), F.col("fps").alias("x"))
    right = tiles.select(F.col("sig").alias("rsig"), F.col("sub").alias("rsub"), F.col("fps").alias("y"))
    both = (pairs.join(right, ["rsig", "rsub"]).join(left, ["lsig", "lsub"])
            .select(((F.col("lsig") == F.col("rsig")) & (F.col("lsub") == F.col("rsub"))).alias("same"), "x", "y"))
    return both.mapInArrow(_compare(radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    radius: int = RADIUS, seed: int = SEED, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id reachable over links."""
    prints = staged(fingerprints(docs, id_col, text_col, width, seed), "simhash-prints")
    n = prints.count()          # from the footers; none of the tables below has more rows
    # one row per fingerprint: its least document
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct", n)
    member = connected_components(links(distinct, radius, tile_rows))
    member = staged(member.select(F.col("node").alias("fp"), F.col("component").alias("root")), "simhash-member", n)
    classed = distinct.join(member, "fp")
    least = classed.groupBy("root").agg(F.min("rep").alias("least"))
    moved = staged(classed.join(least, "root").select("fp", F.col("least").alias("class_id")), "simhash-classes", n)
    classes = staged(distinct.join(moved, "fp", "left")
                     .select("fp", F.coalesce("class_id", "rep").alias("component_id")), "simhash-all", n)
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")
