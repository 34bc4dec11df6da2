"""Exact stratified train/test split at scale.

Allocation follows the usual rule: test = ceil(test_size·n); the training
share of each class is the largest-remainder apportionment of n_train
(ties: larger remainder first, then label name); the rest of each class is
test.  Stratifying needs every class to have ≥ 2 rows and more than one
class, else a plain hash split is used (as upstream, with a warning).

Which rows: ordered by ``md5(seed ':' id)`` inside each class, the first
``test_c`` rows go to test.  Done without ranking whole classes:
(1) a 16-bit bucket from the hash; (2) counts per (class, bucket) — at most
k·65,536 tiny rows; (3) whole buckets below each class's cut-off bucket are
test; (4) only the rows of the single cut-off bucket per class are ranked.
"""
from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import constants as C


def row_hash(key: Column, seed: int = C.RANDOM_SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key, F.lit(""))))


def apportion(counts: dict[str, int], n_draws: int) -> dict[str, int]:
    """Largest-remainder apportionment of ``n_draws`` over classes (exact integers)."""
    total = sum(counts.values())
    base = {c: (n_draws * k) // total for c, k in counts.items()}
    rem = {c: (n_draws * k) % total for c, k in counts.items()}
    left = n_draws - sum(base.values())
    for c in sorted(counts, key=lambda c: (-rem[c], c))[:left]:
        base[c] += 1
    return base


def allocation(counts: dict[str, int], test_size: float = C.TEST_SIZE) -> tuple[dict[str, int], bool]:
    """Per-class test counts and whether the split is stratified."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    stratify = len(counts) > 1 and all(v >= 2 for v in counts.values())
    if not stratify:
        warnings.warn(f"labels {counts}: at least two labels with two rows each are needed to split by label; "
                      "the test rows are drawn from all rows together")
        return {"*": n_test}, False
    k = len(counts)
    if n_test < k or n_train < k:
        raise ValueError(f"{k} classes do not fit into {n_train} training and {n_test} test rows")
    train = apportion(counts, n_train)
    return {c: counts[c] - train[c] for c in counts}, True


def stratified_split(df: DataFrame, label: str = "heuristic_label", key: str = "id",
                     test_size: float = C.TEST_SIZE, seed: int = C.RANDOM_SEED) -> DataFrame:
    """``df`` plus a boolean ``is_test``.  Persist ``df`` first: it is read three
    times (class counts, bucket counts, rows)."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # ≤ #classes rows
    alloc, stratified = allocation(counts, test_size)
    grp = F.col(label) if stratified else F.lit("*")
    h = row_hash(F.col(key), seed)
    tie = F.col("seq") if "seq" in df.columns else F.col(key)
    base = df.withColumns({"_grp": grp, "_h": h,
                           "_bucket": F.conv(F.substring(h, 1, 4), 16, 10).cast("int")})
    need_map = F.create_map(*[x for g, v in alloc.items() for x in (F.lit(g), F.lit(v))])

    bc = base.groupBy("_grp", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_grp").orderBy("_bucket")
    bc = bc.withColumns({"_cum": F.sum("_n").over(w), "_need": F.element_at(need_map, F.col("_grp"))})
    cut = (bc.filter((F.col("_need") > 0) & (F.col("_cum") >= F.col("_need")))
           .groupBy("_grp").agg(F.min_by(F.struct("_bucket", (F.col("_cum") - F.col("_n"))
                                                   .alias("_before"), "_need"), F.col("_bucket"))
                                .alias("_c"))
           .select("_grp", F.col("_c._bucket").alias("_cut"),
                   (F.col("_c._need") - F.col("_c._before")).alias("_take")))
    # ``cut`` has at most one row per class: broadcast is bounded by construction.
    j = base.join(F.broadcast(cut), "_grp", "left")
    outside = j.filter(F.col("_cut").isNull() | (F.col("_bucket") != F.col("_cut"))) \
        .withColumn("is_test", F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False)))
    inside = j.filter(F.col("_bucket") == F.col("_cut")).withColumn(
        "is_test", F.row_number().over(Window.partitionBy("_grp").orderBy("_h", tie))
        <= F.col("_take"))
    drop = ["_grp", "_h", "_bucket", "_cut", "_take"]
    return outside.drop(*drop).unionByName(inside.drop(*drop))
