import numpy as np
import pytest

from tests.conftest import SF001
from tidepool.llm import whitening as wh

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, i) for i, v in rows], "vec_id long, embedding array<float>, x int, n long")


def check(spark, rows, most=16, df=None):
    """The result equals dense eigenvectors of the fit list's covariance."""
    got = wh.whiten(df if df is not None else frame(spark, rows), most=most)
    assert got.columns == COLUMNS
    got = got.toPandas()
    ok = [(i, np.array(v, np.float32)) for i, v in rows if v is not None and all(c is not None for c in v) and np.isfinite(v).all() and len(v)]
    x = np.array([np.floor(64 * v.astype(np.float64)).astype(np.int64) + 1_000_000 for _, v in ok])
    u = np.unique(x, axis=0)
    n, total = len(u), u.sum(0)
    c = (n * u - total) / n
    cov = c.T @ c / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    k = min(most, int((e > 1e-9 * max(e[0], 1e-300)).sum())) if e[0] > 0 else 0
    assert len(got) == k * len(ok)
    if not k:
        return got
    got = got.sort_values(["vec_id", "component"], kind="stable")
    assert (got.n == n).all() and got.identity_error.max() < 1e-9
    assert got.component.tolist() == list(range(1, k + 1)) * len(ok)
    order = np.argsort([i for i, _ in ok], kind="stable")
    w = got.whitened.to_numpy().reshape(-1, k)
    dev = ((n * x - total) ** 2).sum(1)[order]
    assert (got.deviation.to_numpy().reshape(-1, k) == dev[:, None]).all()
    assert np.allclose(got.explained.to_numpy().reshape(-1, k), e[:k] / np.trace(cov), rtol=1e-9)
    rows_c = ((n * x - total) / n)[order]
    # eigenvalues may be equal: compare the projectors of each run of them
    at = 0
    while at < k:
        to = at + 1
        while to < len(e) and e[at] - e[to] < 1e-9 * e[0]:
            to += 1
        if to <= k:
            want = rows_c @ q[:, at:to] / np.sqrt(e[at:to])
            assert np.allclose(w[:, at:to] @ w[:, at:to].T, want @ want.T, atol=1e-7)
        at = to
    return got


def test_matches_dense_eigenvectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 9)) * np.linspace(3, 0.2, 9) + rng.normal(size=9)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[0].tolist()) for i in range(150)]  # a hot vector
    check(spark, rows, most=4)
    check(spark, rows)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding")
    check(spark, [(r[0], r[1]) for r in df.collect()], df=df)


@pytest.mark.parametrize("most", [3, 16])
def test_equal_eigenvalues(spark, most):
    rows = [(2 * i + s, [0.0] * i + [float(2 - 4 * s)] + [0.0] * (7 - i)) for i in range(8) for s in (0, 1)]
    check(spark, rows, most=most)


def test_wide_with_few_wanted(spark):
    """Stops early; a repeated eigenvalue among the wanted is not missed."""
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(400, 40)))[0]
    x = q * np.concatenate([[900, 500, 500], np.geomspace(60, 1, 37)])
    check(spark, [(i, v.tolist()) for i, v in enumerate(x)], most=3)


def test_rank_and_few_vectors(spark):
    rng = np.random.default_rng(3)
    low = rng.integers(-40, 40, size=(60, 2)) @ rng.integers(-3, 4, size=(2, 6)) / 64
    check(spark, [(i, v.tolist()) for i, v in enumerate(low)])
    check(spark, [(1, [1.0, 2.0, 3.0]), (2, [0.5, 2.0, 1.0])])
    assert len(check(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])) == 0
    assert len(check(spark, [(7, [3.5])])) == 0


def test_odd_vectors_and_widths(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=3).tolist()) for i in range(30)]
    odd = [(100, None), (101, [None, 1.0, 1.0]), (102, [float("nan"), 1.0, 1.0]), (103, [float("inf"), 0.0, 0.0]), (104, [])]
    check(spark, good + odd)
    twice = wh.whiten(frame(spark, [*good, (5, good[5][1]), (5, good[6][1])])).toPandas()  # an id again
    assert len(twice) == 32 * 3 and (twice.n == 30).all()
    other = [(200 + i, rng.normal(size=2).tolist()) for i in range(20)]
    got = wh.whiten(frame(spark, good + other + [(None, good[0][1])])).toPandas()
    assert got.vec_id.isna().sum() == 3 and (got[got.vec_id >= 200].n == 20).all() and (got[got.vec_id < 200].n == 30).all()
    assert len(got) == 31 * 3 + 20 * 2
    assert wh.whiten(frame(spark, odd)).collect() == [] and wh.whiten(frame(spark, good).limit(0)).collect() == []
    far = wh.whiten(frame(spark, [(1, [3e38, 0.0]), (2, [0.0, -3e38]), (3, [1.0, 1.0])])).toPandas()
    assert len(far) == 6 and far.whitened.notna().all() and far.identity_error.max() < 1e-9


def test_sums_meet_in_steps(spark, monkeypatch):
    monkeypatch.setattr(wh, "FAN", 2)
    df = spark.createDataFrame([([i, -i, 2 * i],) for i in range(1000)], "x array<long>").repartition(9)
    fit = wh._Fit(df, 3)
    assert fit.n == 1000 and fit.total.tolist() == [499500, -499500, 999000]
    assert fit.over_centred(lambda x: x.sum(0), 3) == pytest.approx([0, 0, 0], abs=1e-6)


def test_far_entries_are_exact():
    x = np.array([[1 << 40, 0], [0, 0]], np.int64)
    total = x.sum(0)
    assert wh._deviation(x, 2, total) == [None, None] and wh._deviation(x >> 20, 2, total >> 20) == [1 << 40, 1 << 40]
    assert wh._centred(x, 2, total).tolist() == [[2.0**39, 0.0], [-(2.0**39), 0.0]]
