import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from shopmart.llm import embedding_dedup
from shopmart.llm.embedding_dedup import near_duplicates


def brute(ids, vectors, least=0.9):
    n = len(ids)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    width = max([len(v) for v, o in zip(vectors, ok) if o], default=1)
    x = np.zeros((n, width))
    for i, v in enumerate(vectors):
        if ok[i]:
            w = np.array(v, float) / np.abs(v).max()
            x[i, :len(v)] = w / np.linalg.norm(w)
    link = x @ x.T >= least
    np.fill_diagonal(link, False)
    label = np.arange(n)
    while True:
        new = np.array([min(label[i], label[link[i]].min(initial=n)) for i in range(n)])
        if (new == label).all():
            break
        label = new
    out = []
    for i in range(n):
        c = min((ids[j] for j in range(n) if label[j] == label[i] and ids[j] is not None), default=None)
        out.append((ids[i], int(link[i].sum()), c, ids[i] == c if ids[i] is not None and c is not None else not link[i].any()))
    return out


def vectors(rng, n=400, dim=12):
    x = rng.normal(size=(n, dim))
    near = x[rng.integers(0, n, n)] + 0.35 * np.linalg.norm(x, axis=1).mean() / np.sqrt(dim) * rng.normal(size=(n, dim))
    ball = x[:1] + 0.1 * rng.normal(size=(150, dim))
    out = [list(map(float, v)) for v in np.concatenate([x, near, ball, x[:40], x[:40] * 3.0])]
    bad = [None, [], [0.0] * dim, [1.0, None] + [0.0] * (dim - 2), [float("nan")] * dim, [float("inf")] * dim, [1e300, 1e300], [1e-300, 1e-300]]
    return out + bad + bad


@pytest.mark.parametrize("kind", ["double", "float"])
def test_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(embedding_dedup, "CELL", 20)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)  # several blocks a cell
    monkeypatch.setattr(embedding_dedup, "VISITORS", 50)
    monkeypatch.setattr(embedding_dedup, "GROUP", 120)
    monkeypatch.setattr(embedding_dedup, "PAIRS", 500)
    v = vectors(np.random.default_rng(7))
    if kind == "float":
        v = [x if x is None else [y if y is None else float(np.float32(min(y, 1e38))) for y in x] for x in v]
    ids = [None if i % 41 == 3 else i * 13 % 997 for i in range(len(v))]
    df = spark.createDataFrame([(i, x, "c") for i, x in zip(ids, v)], f"vec_id long, embedding array<{kind}>, node string").repartition(4)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted(map(tuple, near_duplicates(df, reach=1.0).collect()), key=key)
    want = sorted(brute(ids, v), key=key)
    assert got == want
    assert sum(r[1] for r in got) > 1000


def test_recall_of_the_default_reach(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 60)
    v = vectors(np.random.default_rng(11), 800, 64)
    ids = list(range(len(v)))
    df = spark.createDataFrame(list(zip(ids, v)), "vec_id long, embedding array<double>")
    found, there = sum(r.n_links for r in near_duplicates(df).collect()), sum(r[1] for r in brute(ids, v))
    assert there > 5000 and 0.99 * there <= found <= there


def test_default_reach_is_exact_on_few_dimensions_and_many_cells(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CELL", 8)
    monkeypatch.setattr(embedding_dedup, "GROUP", 60)
    rng = np.random.default_rng(3)
    low = rng.normal(size=(400, 3)) @ rng.normal(size=(3, 64))  # all of rank 3
    plane = rng.normal(size=(200, 2)) @ rng.normal(size=(2, 64))
    v = [list(map(float, x)) for x in np.concatenate([low, plane, low[:20] + 0.01 * rng.normal(size=(20, 64))])]
    ids = list(range(len(v)))
    df = spark.createDataFrame(list(zip(ids, v)), "vec_id long, embedding array<double>").repartition(4)
    assert sorted(map(tuple, near_duplicates(df).collect())) == brute(ids, v)


def test_one_dense_ball(spark):
    """All vectors in one ball, over several blocks and fine cells: every pair may link."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1, 16)) + 0.3 / np.sqrt(16) * rng.normal(size=(900, 16))
    v = [list(map(float, r)) for r in x]
    df = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(tuple, near_duplicates(df).collect()))
    assert got == brute(list(range(len(v))), v) and sum(r[1] for r in got) > 300000


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicates(df).count() == 0
    assert tuple(near_duplicates(spark.createDataFrame([(4, None)], df.schema)).first()) == (4, 0, 4, True)


def test_vectors_leave_a_task_in_bounded_batches():
    """All vectors of a batch go to all groups: far more copies than what may be held at once."""
    n, groups = 3000, 60
    flat = pa.array([0.5] * (n * 16), pa.float32())
    vector = pa.ListArray.from_arrays(pa.array(range(0, n * 16 + 1, 16), pa.int32()), flat)
    visits = pa.array([[g for g in range(groups) if g != i % groups] for i in range(n)], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([i % groups for i in range(n)], pa.int32()), pa.array([0] * n, pa.int32()),
                                        visits, pa.array([1] * n, pa.int64()), vector], names=["node", "home", "cell", "visits", "copies", "vector"])
    residents, visitors = np.full(groups, 2), np.full(groups, 3)
    sent = list(embedding_dedup._dealt([batch.slice(0, 1000), batch.slice(1000)], residents, visitors))
    assert max(b.nbytes for b in sent) < 3 * embedding_dedup.DEALT
    rows = pa.Table.from_batches(sent)
    # a block against itself, both ways against the other block, against 3 blocks of visitors, and to 2 blocks of each group visited
    assert rows.num_rows == n * (1 + 2 + 3 + 2 * (groups - 1))
    got = sorted((r["task"], r["side"]) for r in rows.filter(pc.equal(rows["node"], 1501)).select(["task", "side"]).to_pylist())
    mine = int(1501 * 0x9E3779B97F4A7C15 % 2**64 >> 33)
    home, a, q = 1501 % groups, mine % 2, mine % 3
    want = [(f"{home} {a} {a}", 2), (f"{home} {a} {1 - a}", 0), (f"{home} {1 - a} {a}", 1)] + [(f"{home} {a} visit {v}", 0) for v in range(3)]
    assert got == sorted(want + [(f"{g} {j} visit {q}", 1) for g in range(groups) if g != home for j in range(2)])


def test_memory_of_a_comparison_is_bounded():
    """A dense cell among very many cells: neither its pairs nor the distances to all cells are held at once."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(2048, 4))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    n = 4000
    x = centres[7] + 0.01 * rng.normal(size=(n, 4))
    task = pa.table({"node": pa.array(range(n), pa.int64()), "home": [0] * n, "cell": pa.array([7] * n, pa.int32()), "copies": pa.array([1] * n, pa.int64()),
                     "vector": pa.array(x.tolist(), pa.list_(pa.float64())), "side": pa.array([2] * n, pa.int32())})
    tracemalloc.start()
    out = embedding_dedup._compared(task, 0.9, 4, centres, 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.column("links").to_pylist() == [n - 1] * n
    assert peak < 250 << 20
