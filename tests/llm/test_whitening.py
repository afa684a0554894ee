import math

import numpy as np
import pytest

from shopmart.llm import queries, whitening
from shopmart.llm.whitening import Spectrum, rank_one, secular_roots, whiten


def cases():
    rng = np.random.default_rng(3)
    normal = rng.normal(size=(200, 12)) * 20
    yield "normal", normal
    yield "few", normal[:3]
    yield "low rank", np.floor(rng.normal(size=(150, 3)) @ rng.normal(size=(3, 12)) * 30)
    yield "ties", rng.integers(-1, 2, size=(300, 12)).astype(float)
    yield "equal columns", np.concatenate([normal, normal], 1)
    yield "scales", normal * np.logspace(-5, 5, 12)
    yield "cross", np.concatenate([np.eye(12) * 7, np.zeros((1, 12))])
    yield "repeats", np.repeat(normal[:5], 30, axis=0)
    yield "one", normal[:1]


@pytest.mark.parametrize("name,x", list(cases()))
def test_spectrum_and_joined_spectra(name, x):
    parts = []
    for rows in np.array_split(x, 3):
        s = Spectrum.empty(x.shape[1])
        for r in rows:
            s.add(r)
        parts.append(Spectrum.unpacked(s.packed(), x.shape[1]))
    s = parts[0]
    for p in parts[1:]:
        s.join(p)
    want = (x - x.mean(0)).T @ (x - x.mean(0))
    size = max(np.abs(want).max(), 1e-9)
    assert s.n == len(x) and np.allclose(s.mean, x.mean(0))
    assert np.abs((s.basis * s.values) @ s.basis.T - want).max() < 1e-10 * size
    assert np.abs(s.basis.T @ s.basis - np.eye(x.shape[1])).max() < 1e-11
    assert (np.diff(s.values) >= 0).all()


def test_secular_roots_near_poles():
    d = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-9, 5.0])
    for z in ([1e-7, 1e-7, 1e-7, 1e-7, 1e-7], [1, 1e-6, 2, 1e-6, 3], [3, 2, 1, 1, 1]):
        z2 = np.array(z, float) ** 2
        near, x = secular_roots(d, z2)
        roots = d[near] + x
        assert (roots >= d).all() and (roots[:-1] <= d[1:]).all()
        value = 1 + (z2 / ((d[None, :] - d[near][:, None]) - x[:, None])).sum(1)
        spread = 1 + np.abs(z2 / ((d[None, :] - d[near][:, None]) - x[:, None])).sum(1)
        assert (np.abs(value) < 1e-11 * spread).all()


def test_untouched_components_stay():
    values, basis = np.array([1.0, 2.0, 2.0, 5.0]), np.eye(4)
    same = rank_one(values, basis, np.zeros(4))
    assert np.array_equal(same[0], values) and np.array_equal(same[1], basis)
    v, b = rank_one(values, basis, np.array([0, 3.0, 4.0, 0]))
    assert np.allclose(v, [1, 2, 5, 27]) and np.allclose(np.abs(b[:, 3]), [0, 0.6, 0.8, 0])


def brute(rows, most=16):
    """rows: (id, list); whitening by plain numpy."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) and abs(c) < 2 ** 46 for c in v)]
    width = max((len(v) for _, v in good), default=0)
    ints = [(i, tuple(math.floor(64 * c) + 1000000 for c in list(v) + [0.0] * (width - len(v)))) for i, v in good]
    fit = np.array(sorted(set(x for _, x in ints)), dtype=object)
    if len(fit) < 2 or not width:
        return None
    n, sums = len(fit), fit.sum(0)
    mean = np.array([float(s - n * 1000000) / n for s in sums])
    c = (fit - 1000000).astype(float) - mean
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > 1e-9 * e[0]).sum()))
    out = []
    for i, x in ints:
        y = (np.array([v - 1000000 for v in x], float) - mean) @ u[:, :k] / np.sqrt(e[:k])
        out.append((i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), y))
    return n, e[:k] / e.sum(), out


def same(got, want):
    n, share, rows = want
    k = len(share)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == k * len(rows) and set(by) == {i for i, _, _ in rows}
    sign = None
    for i, deviation, y in rows:
        mine = [by[i][j + 1] for j in range(k)]
        assert all(r.n == n and r.deviation == deviation for r in mine)
        assert np.allclose([r.explained for r in mine], share, rtol=1e-8)
        assert max(r.identity_error for r in mine) < 1e-9
        white = np.array([r.whitened for r in mine])
        if sign is None:
            sign = np.sign(white * y)
        assert np.allclose(white * sign, y, atol=1e-7)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, x string, component int").repartition(5)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_against_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 24)) @ rng.normal(size=(24, 24))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a hot vector
    rows += [(2000, None), (2001, [None] * 24), (2002, [float("nan")] * 24), (2003, [float("inf")] * 24), (2004, [1.0, 2.0]), (2005, [0.0] * 24), (2006, [])]
    got = whiten(frame(spark, rows, kind), ["vec_id"]).select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()
    same(got, brute(rows))


def test_many_partitions_join_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(400, 5)) * [1, 2, 3, 4, 5])]
    out = whiten(frame(spark, rows).repartition(16), ["vec_id", "x"])
    same(out.select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect(), brute(rows))
    assert {r.row.x for r in out.collect()} == {"clash"}


def test_without_variance(spark):
    assert whiten(frame(spark, []), ["vec_id"]).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [])]), ["vec_id"]).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), ["vec_id"]).count() == 0
    flat = whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0, 3.0])]), ["vec_id"]).collect()
    assert {(r.row.vec_id, r.component, abs(round(r.whitened, 9))) for r in flat} == {(1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0)}
    huge = whiten(frame(spark, [(1, [2.0 ** 45, 0.0]), (2, [0.0, 1.0]), (3, [1e300, 1.0])], "double"), ["vec_id"]).collect()
    assert {r.row.vec_id for r in huge} == {1, 2} and all(r.deviation is None for r in huge)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    same(queries.op11_embedding_whitening(spark, sf).collect(), brute(rows))
