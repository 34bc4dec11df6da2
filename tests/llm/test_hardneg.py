"""Hard negatives against a plain search over all rows."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import hardneg
from vigil.llm.common import ship

SCHEMA = "vec_id long, embedding array<float>, label int, row long, strip int, anchor boolean, score long, id string, place int, block int"
EXTRA = (1, 2, True, 3, "i", 4, 5)


def relabel():
    return F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.fixture(scope="module")
def sp(spark):
    ship(spark)
    return spark


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def brute(rows, every=50, n_positives=5, n_negatives=3):
    """The contract, row by row, in Python integers."""
    kept = []
    for place, (i, e, label) in enumerate(rows):
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        if i is not None and i % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        kept.append((place, i, label, [math.floor(256 * float(np.float32(x))) for x in e]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))       # noqa: E731
    out = []
    for p, i, label, e in kept:
        if i is None or i % every:
            continue
        other = [(-dot(e, f), j is None, j or 0, q, j, g) for q, j, g, f in kept if q != p and len(f) == len(e)]
        for s, _, _, _, positive, _ in sorted(o for o in other if o[5] == label)[:n_positives]:
            ok = sorted(o for o in other if o[5] != label and 50 * -s <= 100 * -o[0] <= 95 * -s)
            out += [(i, positive, rank, o[4], -s, -o[0]) for rank, o in enumerate(ok[:n_negatives], 1)]
    return out


def order(rows):
    return sorted(tuple((v is not None, v if v is not None else 0) for v in r) for r in rows)


def mined(spark, rows, **kw):
    got = hardneg.mine(frame(spark, rows), is_anchor=F.col("id") % 50 == 0, label=relabel(), **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return [tuple(r) for r in got.collect()]


def clustered(n, d, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, d)) + 1.0
    own = rng.integers(0, labels, n)
    x = (centres[own] * rng.uniform(0.2, 2.0, size=(n, 1)) + 0.4 * rng.normal(size=(n, d))).astype(np.float32)
    return [(int(i), [float(v) for v in x[i]], int(own[i])) for i in range(n)]


@pytest.mark.parametrize("seed,d", [(1, 6), (2, 24)])
def test_against_all_pairs(sp, monkeypatch, seed, d):
    rows = clustered(1500, d, seed)
    want = brute(rows)
    assert len(want) > 50
    assert order(mined(sp, rows)) == order(want)
    # several strips and several blocks of anchors give the same
    assert order(mined(sp, rows, strip_values=1, block_anchors=7)) == order(want)


def test_odd_rows(sp):
    inf, nan = float("inf"), float("nan")
    good = clustered(230, 5, 3, labels=2)
    odd = [(500, None, 1), (550, [1.0] * 5, None), (600, [1.0, nan, 0.0, 0.0, 0.0], 0), (650, [inf, 1.0, 0.0, 0.0, 0.0], 0),
           (700, [0.0] * 5, 1), (750, [1.0, 2.0], 1), (751, [1.0, 1.5], 0), (752, [1.0, 2.1], 1), (800, [], 0), (801, [], 1), (802, [], 0),
           (None, good[0][1], 0), (None, good[0][1], 1), (None, None, None)]
    ties = [(900 + k, good[50][1], k % 2) for k in range(40)]
    rows = good + odd + ties
    assert order(mined(sp, rows)) == order(brute(rows))


def test_repeated_ids_and_negative_scores(sp):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (50, [-1.0, 0.0], 2), (51, [1.0, 0.0], 2), (52, [-0.9, 0.1], 3), (53, [0.7, 0.1], 3)]
    assert order(mined(sp, rows)) == order(brute(rows))


def test_scores_are_exact_beyond_double_precision(sp):
    rows = [(0, [1e14, 1.0], 1), (1, [1e14, 3.0], 1), (2, [6e13, 7.0], 2), (3, [6e13, 7.5], 2), (4, [5.5e13, -7.5], 2)]
    want = [tuple(min(max(v, -2 ** 63), 2 ** 63 - 1) for v in r) for r in brute(rows)]
    assert [r[:4] for r in sorted(mined(sp, rows))] == [r[:4] for r in sorted(want)]


def test_empty_table_and_no_anchor(sp):
    assert mined(sp, []) == []
    assert mined(sp, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]) == []


@pytest.mark.parametrize("need", [0.2, 0.7, 0.95, 1.5])
def test_pruning_keeps_every_row_that_reaches_the_score(need):
    rng = np.random.default_rng(int(need * 100))
    x = rng.integers(-200, 200, size=(600, 8))
    a = rng.integers(-200, 200, size=(40, 8))
    length, size = np.sqrt((a * a).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    unit = a / length[:, None]
    bucket = hardneg.Bucket(x, size)
    focus = np.argsort(-np.abs(unit), axis=1)[:, :hardneg.FOCUS]
    needs = need * length * size.max()
    pruned = 0
    for i, found in enumerate(bucket.candidates(unit, length, needs, focus)):
        hits = set(np.flatnonzero(a[i] @ x.T >= needs[i]).tolist())
        left = set() if found is None else set(range(600)) if isinstance(found, str) else set(found.tolist())
        assert hits <= left
        pruned += 600 - len(left)
    assert pruned >= {0.2: 0, 0.7: 1, 0.95: 600 * 40 * 0.5, 1.5: 600 * 40}[need]
