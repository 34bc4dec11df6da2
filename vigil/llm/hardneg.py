"""Hard negatives by length buckets and coordinate pruning.

Rows are ranged by (label, falling length) into strips of bounded size.  An
anchor meets the strips it can find partners in, in blocks of anchors, so a task
holds one strip and one block of anchors whatever the number of rows.  Within a
strip, rows fall into buckets of falling length; a bucket keeps, for every
coordinate, its rows in order of that coordinate of the unit vector.

For an anchor q that needs scores of at least s, a bucket whose longest vector
has length l must have cosines of at least t = s / (|q| l).  The bucket is left
out when t > 1.  Otherwise a vector at an angle of at most arccos t to q has its
coordinate f between cos(b + arccos t) and cos(b - arccos t), where cos b is q's
own coordinate: for the anchor's focus coordinates (the largest ones) these
ranges are found in the sorted lists, the rows in all of them are the
candidates, and exact integer products decide.  Where every range holds most of
the bucket, all its rows are verified at once.  The score that an anchor needs
rises as its list fills.

Two rounds: the best rows of the anchor's label (its positives), then, for each
positive, the best rows of other labels whose score lies between the given
shares of the positive's score.

Rows with a null label, a null vector or any null or non-finite component take
no part.  Components are whole numbers floor(scale * x), clamped to a long;
scores are exact and clamped to a long where they are returned.  Vectors of
different lengths are not compared.  A null id is never an anchor; as a partner
it comes behind equal scores.  Repeated ids are separate rows; equal rows tie
and come in order of their ids.  An empty table gives an empty result; extra
columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import staged

STRIP_VALUES = 4_194_304   # components of the vectors of a strip, about
MAX_STRIP_ROWS = 65_536
BLOCK_ANCHORS = 16_384     # anchors that meet a strip in one task, about
BUCKET_ROWS = 2048
FOCUS = 4                  # focus coordinates of an anchor
DENSE = 0.7                # a narrowest range with more of the bucket prunes too little to pay
MARGIN = 1e-9              # ranges and bounds are this much wider, so that rounding never decides them

NULL_ID = np.iinfo(np.int64).max


# ------------------------------------------------------------------ one strip, one block of anchors
def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) in double precision, as long."""
    y = np.floor(scale * np.asarray(x, np.float64))
    over, under = y >= 2.0 ** 63, y < -2.0 ** 63
    out = np.where(over | under, 0.0, y).astype(np.int64)
    out[over], out[under] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of a with the rows of b."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if bound < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(object) @ b.astype(object).T


class Bucket:
    """Rows of similar length with a sorted list per coordinate."""

    def __init__(self, x: np.ndarray, length: np.ndarray):
        self.x = x
        self.longest = float(length.max())
        unit = x / np.where(length > 0, length, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").astype(np.int32).T.copy()
        self.values = np.take_along_axis(unit.T, self.order, axis=1)

    def candidates(self, unit: np.ndarray, length: np.ndarray, need: np.ndarray, focus: np.ndarray):
        """Per anchor: None (nothing can reach ``need``), 'all', or the rows that its focus ranges share."""
        m, top = len(self.x), length * self.longest
        found: list = ["all"] * len(need)
        over = need > 0
        for i in np.flatnonzero(over & (need > top * (1 + MARGIN) + MARGIN)):
            found[i] = None
        live = np.flatnonzero(over & (need <= top * (1 + MARGIN) + MARGIN) & (top > 0))
        if not len(live):
            return found
        t = np.minimum(1.0, need[live] / top[live])
        gamma = np.arccos(np.maximum(-1.0, t - MARGIN))
        beta = np.arccos(np.clip(np.take_along_axis(unit[live], focus[live], axis=1), -1.0, 1.0))
        low = np.cos(np.minimum(np.pi, beta + gamma[:, None])) - MARGIN
        high = np.cos(np.maximum(0.0, beta - gamma[:, None])) + MARGIN
        first, last = np.empty(low.shape, np.int64), np.empty(low.shape, np.int64)
        for f in np.unique(focus[live]):
            p, k = np.nonzero(focus[live] == f)
            first[p, k] = np.searchsorted(self.values[f], low[p, k], "left")
            last[p, k] = np.searchsorted(self.values[f], high[p, k], "right")
        count = last - first
        for p in np.flatnonzero(count.min(axis=1) <= DENSE * m):
            hits = np.zeros(m, np.int8)
            narrow = np.flatnonzero(count[p] < m)
            for k in narrow:
                hits[self.order[focus[live[p], k], first[p, k]:last[p, k]]] += 1
            found[live[p]] = np.flatnonzero(hits == len(narrow))
        return found


class Best:
    """The k best (score falling, id, row) rows seen."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.row = [], [], []

    @property
    def need(self):
        """The score that a further row must reach, or None."""
        return self.score[-1] if len(self.score) == self.k else None

    def offer(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(score) > 8 * self.k:                 # a few of the best scores, with all their ties
            kth = np.partition(score, len(score) - self.k)[len(score) - self.k]
            on = score >= kth
            score, ids, rows = score[on], ids[on], rows[on]
            order = np.lexsort((rows, ids, -score)) if score.dtype != object else range(len(score))
            if score.dtype != object:
                order = order[:self.k]
            score, ids, rows = score[order], ids[order], rows[order]
        every = sorted(zip([-s for s in self.score] + [-int(s) for s in score], self.id + ids.tolist(), self.row + rows.tolist()))
        every = every[:self.k]
        self.score, self.id, self.row = [-e[0] for e in every], [e[1] for e in every], [e[2] for e in every]


def search(strip: dict, anchors: dict, windows: list[list[tuple[int, int]]] | None, k: int):
    """Best rows of the strip for every anchor, as lists of ``Best``.

    Without windows: one list an anchor, over the rows of its label but itself.  With windows: one list per (low, high)
    of the anchor, over the rows of other labels with scores in it.
    """
    n = len(anchors["row"])
    best = [[Best(k) for _ in (windows[i] if windows is not None else [0])] for i in range(n)]
    x, a = strip["x"], anchors["x"]
    size = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    length = np.sqrt((a.astype(np.float64) ** 2).sum(axis=1))
    unit = a / np.where(length > 0, length, 1.0)[:, None]
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
    order = np.argsort(-size, kind="stable")

    def needed(i: int) -> float:
        if windows is None:
            worst = best[i][0].need
            return -np.inf if worst is None else float(worst)
        return min((float(low) if b.need is None else float(max(low, b.need))
                    for (low, high), b in zip(windows[i], best[i]) if low <= high), default=np.inf)

    def take(i: int, at: np.ndarray, score: np.ndarray) -> None:
        same = strip["label"][at] == anchors["label"][i]
        if windows is None:
            ok = same & (strip["row"][at] != anchors["row"][i])
            if best[i][0].need is not None:
                ok &= score >= best[i][0].need
            if ok.any():
                best[i][0].offer(score[ok], strip["id"][at[ok]], strip["row"][at[ok]])
            return
        for (low, high), b in zip(windows[i], best[i]):
            if low > high:
                continue
            ok = ~same & (score >= (low if b.need is None else max(low, b.need))) & (score <= high)
            ok = ok.astype(bool)
            if ok.any():
                b.offer(score[ok], strip["id"][at[ok]], strip["row"][at[ok]])

    for at in range(0, len(order), BUCKET_ROWS):
        rows = order[at:at + BUCKET_ROWS]
        bucket = Bucket(x[rows], size[rows])
        for lo in range(0, n, 2048):                 # anchors in slices, so that dense products stay small
            ids = np.arange(lo, min(n, lo + 2048))
            need = np.asarray([needed(i) for i in ids])
            found = bucket.candidates(unit[ids], length[ids], need, focus[ids])
            dense = [i for i, f in zip(ids, found) if isinstance(f, str)]
            if dense:
                table = products(a[dense], bucket.x)
                for i, score in zip(dense, table):
                    take(i, rows, score)
            for i, f in zip(ids, found):
                if isinstance(f, np.ndarray) and len(f):
                    take(i, rows[f], products(a[i:i + 1], bucket.x[f])[0])
    return best


# ------------------------------------------------------------------ Spark
def _side(table: pa.Table, scale: float) -> list[dict]:
    """The rows of a group, one dict of arrays per vector length, with the place of each row."""
    vectors = table.column("embedding").combine_chunks()
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks) if vectors.num_chunks else pa.array([], vectors.type)
    dims = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.empty(0, np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(dims)])
    ids = table.column("id").fill_null(int(NULL_ID)).to_numpy()
    label, row = table.column("label").to_numpy(), table.column("row").to_numpy()
    out = []
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        x = values[(starts[at][:, None] + np.arange(d)[None, :])] if d else np.zeros((len(at), 0))
        out.append({"dim": int(d), "at": at, "x": whole(x, scale), "id": ids[at], "label": label[at], "row": row[at]})
    return out


def _cells(scale: float, k: int, shares: tuple[int, int] | None):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        strips = {s["dim"]: s for s in _side(left, scale)}
        for anchors in _side(right, scale):
            strip = strips.get(anchors["dim"])
            if strip is None:
                continue
            windows = None
            if shares is not None:
                given = right.column("positives").to_pylist()
                # low * positive <= 100 * score <= high * positive, in whole numbers
                windows = [[(-((-shares[0] * s) // 100), (shares[1] * s) // 100) for s in given[i]] for i in anchors["at"]]
            for row, lists in zip(anchors["row"].tolist(), search(strip, anchors, windows, k)):
                for j, b in enumerate(lists):
                    out += [(row, j, s, None if i == NULL_ID else i, r) for s, i, r in zip(b.score, b.id, b.row)]
        cols = list(zip(*out)) or [[]] * 5
        clamp = [min(max(int(s), -2 ** 63), 2 ** 63 - 1) for s in cols[2]]
        return pa.table({"anchor": pa.array(cols[0], pa.int64()), "nth": pa.array(cols[1], pa.int32()),
                         "score": pa.array(clamp, pa.int64()), "id": pa.array(cols[3], pa.int64()),
                         "row": pa.array(cols[4], pa.int64())})
    return run


_FOUND = "anchor long, nth int, score long, id long, row long"


def _meet(strips: DataFrame, asked: DataFrame, blocks: int, cells: int, scale: float, k: int,
          shares: tuple[int, int] | None) -> DataFrame:
    """Strips and anchors (each with the strips it is to meet) by (strip, block of anchors)."""
    left = strips.select(*[F.col(c).alias(c) for c in strips.columns],           # columns of its own: both sides read one table
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    tasks = max(1, min(20_000, 2 * cells))           # by count: the work of a cell is not its bytes
    return left.repartition(tasks, "strip", "block").groupBy("strip", "block") \
        .cogroup(right.repartition(tasks, "strip", "block").groupBy("strip", "block")) \
        .applyInArrow(_cells(scale, k, shares), _FOUND)


def _top(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, id_col: str = "vec_id",
         label_col: str = "label", vector_col: str = "embedding", scale: float = 256.0, n_positives: int = 5,
         n_negatives: int = 3, low: int = 50, high: int = 95, strip_values: int = STRIP_VALUES,
         block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the columns ``id`` and ``label``; ``label`` (on the same columns) replaces the label
    that rows carry.  ``low`` and ``high`` bound a negative's score, in percent of the positive's.
    """
    spark = vectors.sparkSession
    v = F.col("embedding")
    good = F.col("label").isNotNull() & v.isNotNull() & ~F.exists(
        v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                          F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("embedding")).where(good)
    if label is not None:
        rows = rows.withColumn("label", label.cast("long"))
    length = F.aggregate(v, F.lit(0.0), lambda s, c: s + F.pow(F.floor(F.lit(scale) * c.cast("double")).cast("double"), F.lit(2)))
    rows = staged(rows.withColumn("length", length).withColumn("anchor", F.coalesce(is_anchor, F.lit(False))), "hardneg-rows")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("d"),
                    F.count_if("anchor").alias("a")).first()
    strip_rows = max(1024, min(MAX_STRIP_ROWS, strip_values // max(1, seen["d"] or 1)))
    parts = max(1, -(-seen["n"] // strip_rows), min(spark.sparkContext.defaultParallelism, -(-seen["n"] // BUCKET_ROWS)))
    pieces = staged(rows.repartitionByRange(parts, "label", F.desc("length"), "row")
                    .select(F.spark_partition_id().alias("piece"), "row", "id", "label", "embedding", "anchor"), "hardneg-strips")
    # a session may raise the number of partitions: neighbouring ones make up a strip, so that the strips stay as many
    last = pieces.agg(F.coalesce(F.max("piece"), F.lit(0))).first()[0]
    strips = pieces.withColumn("strip", F.floor(F.col("piece") * F.lit(parts) / F.lit(last + 1)).cast("int")).drop("piece")
    blocks = max(1, -(-seen["a"] // block_anchors))
    anchors = strips.where("anchor").select("row", "id", "label", "embedding")
    bare = strips.drop("anchor")

    # positives: an anchor meets the strips that hold its label
    holds = strips.select("strip", "label").distinct()
    own = _meet(bare, anchors.join(holds, "label").select("strip", "row", "id", "label", "embedding"), blocks,
                parts * blocks, scale, n_positives, None)
    positives = staged(_top(staged(own, "hardneg-own"), ["anchor"], n_positives)
                       .select("anchor", "place", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")),
                       "hardneg-positives")
    # negatives: an anchor meets the strips that hold another label; at most n_positives scores an anchor
    scores = positives.groupBy(F.col("anchor").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("p")) \
        .select("row", F.col("p.positive_score").alias("positives"))
    range_of = strips.groupBy("strip").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    mixed = range_of.select("strip", F.when(F.col("least") == F.col("most"), F.col("least")).alias("only"))
    asked = anchors.join(scores, "row").withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = asked.join(mixed, "strip").where(F.col("only").isNull() | (F.col("only") != F.col("label"))).drop("only")
    other = _meet(bare, asked.select("strip", "row", "id", "label", "embedding", "positives"), blocks, parts * blocks,
                  scale, n_negatives, (low, high))
    negatives = _top(staged(other, "hardneg-other"), ["anchor", "nth"], n_negatives)
    names = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return negatives.select("anchor", (F.col("nth") + 1).alias("place"), F.col("place").alias("rank"),
                            F.col("id").alias("negative_id"), F.col("score").alias("negative_score")) \
        .join(positives, ["anchor", "place"]).join(names, "anchor") \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                "negative_score")

