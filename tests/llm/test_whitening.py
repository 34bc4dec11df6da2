"""Whitening against numpy's eigenvectors, and the qd kernels by themselves."""
import numpy as np
import pytest

from vigil.llm import whitening as wh
from vigil.llm.common import ship
from vigil.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, dim int, n long, whitened double, component string, part int"


@pytest.fixture(scope="module")
def sp(spark):
    ship(spark)
    return spark


def kinds():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    h = np.ones((1, 1))
    for _ in range(5):
        h = np.block([[h, h], [h, -h]])
    constant = rng.normal(size=(300, 12))
    constant[:, 3], constant[:, 5] = 0.0, constant[:, 6]
    w = np.diag(np.abs(np.arange(21) - 10.0) + 2) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    return {"normal": rng.normal(size=(500, 40)), "graded": rng.normal(size=(200, 40)) * np.logspace(0, -9, 40),
            "few rows": rng.normal(size=(10, 40)), "constant and equal columns": constant, "identity": np.eye(20),
            "all equal": np.vstack([h, h]), "clusters": np.diag([3.0] * 10 + [2.0] * 10 + [0.0] * 20) @ q,
            "tight": np.diag(1 + 1e-9 * np.arange(40)) @ q, "wilkinson": np.linalg.cholesky(w).T, "one column": np.ones((5, 1)),
            "zero": np.zeros((6, 5)), "diagonal": np.diag(np.arange(1.0, 30.0)), "ones": np.ones((9, 7)),
            "rising": np.diag(np.logspace(-8, 0, 20)) + np.diag(np.logspace(-8, 0, 20)[1:], 1)}


@pytest.mark.parametrize("name", sorted(kinds()))
def test_directions(name):
    x = kinds()[name]
    d = x.shape[1]
    values, v = wh.directions(np.linalg.qr(x, mode="r"), d)
    want = np.zeros(d)
    s = np.linalg.svd(x, compute_uv=False)
    want[:len(s)] = s ** 2
    top = max(want[0], 1e-300)
    assert (np.diff(values) <= 0).all() and np.abs(values - want).max() <= 1e-13 * top
    assert np.abs(v.T @ v - np.eye(d)).max() < 1e-13
    assert np.abs(x.T @ (x @ v) - v * values).max() <= 1e-13 * top


def test_small_singular_values_keep_their_digits():
    d = np.logspace(0, -12, 25)
    b = np.diag(d) + np.diag(0.5 * d[1:], 1)
    got = np.sqrt(wh.singular_values_squared(np.diag(b), np.diag(b, 1)))
    from fractions import Fraction
    # the product of the singular values is that of the diagonal, exactly
    want = float(np.prod([Fraction(float(x)) for x in d]))
    assert abs(np.prod(got) / want - 1) < 1e-12
    assert np.allclose(got[:10], np.linalg.svd(b, compute_uv=False)[:10], rtol=1e-9)


@pytest.mark.parametrize("seed", range(5))
def test_bidiagonal_has_the_singular_values(seed):
    r = np.triu(np.random.default_rng(seed).normal(size=(15, 15)))
    diagonal, upper, v = wh.bidiagonalise(r)
    b = np.diag(diagonal) + np.diag(upper, 1)
    assert np.abs(v.T @ v - np.eye(15)).max() < 1e-14
    assert np.allclose((r @ v).T @ (r @ v), b.T @ b, atol=1e-12)


def check(rows, x):
    """Rows of one length against the eigenvectors of the covariance of ``x`` (whole numbers)."""
    n, d = x.shape
    k = min(32, d)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert all(sorted(v) == list(range(1, k + 1)) for v in by.values()) and len(by) == n
    dev = n * x.astype(object) - x.astype(object).sum(axis=0)
    c = dev.astype(float) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    got = np.asarray([[by[i][j].whitened for j in range(1, k + 1)] for i in sorted(by)])
    want = c @ v / np.sqrt(e)
    want *= np.sign((want * got).sum(axis=0))
    assert np.abs(got - want).max() < 1e-6
    for p, i in enumerate(sorted(by)):
        for j, r in by[i].items():
            assert r.n == n and r.deviation == int((dev[p] ** 2).sum())
            assert abs(r.explained / (e[j - 1] / np.trace(c.T @ c / n)) - 1) < 1e-9
            assert r.identity_error < 1e-9


def whole(x):
    return np.floor(64.0 * np.asarray(x, np.float32).astype(float)).astype(np.int64) + 1_000_000


def test_query(spark):
    rows = REGISTRY["op13_whiten_dqds"](spark, SF).collect()
    table = sorted(spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    check(rows, whole([r.embedding for r in table]))


def test_odd_rows_and_clashing_columns(sp):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 6)).astype(np.float32) * 20
    inf, nan = float("inf"), float("nan")
    rows = [(i, x[i].tolist(), None) for i in range(300)]
    odd = [(900, None, 1), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (902, [nan] * 6, 1), (903, [inf] * 6, 1), (904, [], 1)]
    short = [(1000 + i, (x[i, :2] * 3).tolist(), 2) for i in range(50)]
    df = sp.createDataFrame([(*r, 1, 2, 0.5, "c", 3) for r in rows + odd + short], SCHEMA).repartition(7)
    got = wh.whiten(df).collect()
    assert not [r for r in got if 900 <= r.vec_id < 1000]
    check([r for r in got if r.vec_id < 900], whole(x))
    check([r for r in got if r.vec_id >= 1000], whole(x[:50, :2] * 3))      # a length of its own fit


def test_no_variance_nulls_and_repeats(sp):
    rows = [(1, [1.0, 2.0, 5.0]), (1, [1.0, 2.0, 5.0]), (None, [1.0, 3.0, 5.0]), (2, [1.0, 4.0, 5.0])]
    df = sp.createDataFrame([(i, e, 1, 1, 2, 0.5, "c", 3) for i, e in rows], SCHEMA)
    got = wh.whiten(df).collect()
    assert len(got) == 12 and sum(r.vec_id is None for r in got) == 3 and sum(r.vec_id == 1 for r in got) == 6
    assert {round(r.explained, 9) for r in got} == {0.0, 1.0}
    assert all(r.whitened == 0.0 for r in got if r.component > 1) and all(r.identity_error < 1e-9 for r in got)
    one = wh.whiten(df.where("vec_id = 2")).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(0, 0.0, 0.0, 0.0)] * 3
    assert wh.whiten(df.limit(0)).count() == 0


def test_very_large_entries_are_clamped_and_exact(sp):
    rows = [(1, [1e36, 0.0]), (2, [-1e36, 1.0]), (3, [0.0, 2.0]), (4, [1e12, -1.0])]
    got = wh.whiten(sp.createDataFrame([(i, e, 1, 1, 2, 0.5, "c", 3) for i, e in rows], SCHEMA)).collect()
    assert len(got) == 8 and all(r.deviation is None and np.isfinite(r.whitened) for r in got)


def test_triangles_of_many_tasks_are_stacked(sp, monkeypatch):
    monkeypatch.setattr(wh, "FAN_IN", 2)
    x = np.random.default_rng(9).normal(size=(200, 4)).astype(np.float32)
    df = sp.createDataFrame([(i, x[i].tolist(), 1, 1, 2, 0.5, "c", 3) for i in range(200)], SCHEMA).repartition(11)
    check(wh.whiten(df).collect(), whole(x))
