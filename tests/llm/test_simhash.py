import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from shopmart.llm import simhash
from shopmart.llm._graph import components
from shopmart.llm.simhash import fingerprint, fingerprint_links, near_duplicates


def brute_print(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]), 42) for i in range(max(len(w) - k + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, ids, bits=3):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= bits:
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        r = root(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return [least[root(i)] for i in range(len(prints))]


def test_documents(spark):
    rng = random.Random(2)
    vocab = ["The", "the", "é", " x", "b,"] + [f"W{i}" for i in range(50)]
    texts = [None, "", " \t", "One", "one", "two words", "TWO\nwords", "a b c"]
    for _ in range(40):
        w = rng.choices(vocab, k=rng.randint(1, 300))
        texts.append(" ".join(w))
        if len(w) > 200:
            texts += [" ".join(w[:-1]), " ".join(w + ["tail"]), " ".join(w)]
    ids = [None if i % 13 == 5 else i * 7 % 101 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, n, "x") for n, (i, t) in enumerate(zip(ids, texts))], "doc_id long, text string, fp int, label string")
    prints = [brute_print(t) for t in texts]
    want = brute_components(prints, ids)
    got = near_duplicates(df, ["doc_id", "fp"]).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.fingerprint % (1 << 64) == prints[r.row.fp] and r.component_id == want[r.row.fp]
    assert len(set(want)) < len(set(ids))


def test_links_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    fp = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    near = fp[rng.integers(0, 3000, 2000)]
    for _ in range(3):
        near = near ^ np.where(rng.random(2000) < 0.8, np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64), np.uint64(0))
    ball = fp[0] ^ (np.uint64(1) << rng.integers(32, 64, 400, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(32, 64, 400, dtype=np.uint64))
    every = np.unique(np.concatenate([fp, near, ball]))
    monkeypatch.setattr(simhash, "SHARD", 300)
    monkeypatch.setattr(simhash, "LEAF", 20)
    df = spark.createDataFrame([(x,) for x in every.view(np.int64).tolist()], "fp long").repartition(4)
    links = fingerprint_links(df)
    pairs = [(r.a, r.b) for r in links.collect()]
    got = {r.node: r.label for r in components(links).collect()}
    want = brute_components([x for x in every.tolist()], every.view(np.int64).tolist())
    assert [got.get(x, x) for x in every.view(np.int64).tolist()] == want


def test_a_dense_ball_is_dealt_in_blocks(spark, monkeypatch):
    """Points that agree in one half, and a ball around one of them: no task holds more than two blocks."""
    rng = np.random.default_rng(8)
    base = np.uint64(0x0123456789ABCDEF)
    same = base ^ (rng.integers(0, 1 << 32, 900, dtype=np.uint64) << np.uint64(32))
    ball = np.full(900, base)
    for _ in range(5):
        ball ^= np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64)
    tight = base ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64))
    every = np.unique(np.concatenate([same, ball, tight, rng.integers(0, 1 << 63, 500, dtype=np.uint64)]))
    for name, value in (("SHARD", 200), ("LEAF", 30), ("BLOCK", 150)):
        monkeypatch.setattr(simhash, name, value)
    trees = [simhash._grow(simhash._half(every, t), 1, 200, 1.0) for t in (0, 1)]
    assert max(n for n in trees[1] if isinstance(n, int)) > 3
    fp = pa.RecordBatch.from_arrays([pa.array(every.view(np.int64))], names=["fp"])
    dealt = pa.Table.from_batches(simhash._dealt([fp], trees, 1)).group_by(["shard", "pair"]).aggregate([("fp", "count")])
    assert max(dealt["fp_count"].to_pylist()) < 3 * 150
    df = spark.createDataFrame([(x,) for x in every.view(np.int64).tolist()], "fp long").repartition(4)
    got = {r.node: r.label for r in components(fingerprint_links(df)).collect()}
    ids = every.view(np.int64).tolist()
    want = brute_components(every.tolist(), ids)
    assert [got.get(x, x) for x in ids] == want and 400 < len(set(want)) < len(ids) - 300


def test_a_sphere_leaves_fewer_pairs():
    """No split of a dense ball doubles the work; spread points are parted."""
    rng = np.random.default_rng(9)
    ball = np.unique(np.uint64(7) ^ (np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64)))
    assert simhash._split(ball, 3) is None
    spread = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    point, radius = simhash._split(spread >> np.uint64(32), 1)
    d = np.bitwise_count((spread >> np.uint64(32)) ^ point)
    assert (d <= radius + 1).mean() ** 2 + (d > radius).mean() ** 2 <= simhash.GAIN


def test_long_and_empty(spark):
    t = "w" * 5 + " x y z" * 30000
    assert fingerprint(t) == brute_print(t)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df, ["doc_id"]).count() == 0


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101), (5, 5), (None, 3), (7, None)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}
