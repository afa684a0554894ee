import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmart.llm import mixing
from shopmart.llm.mixing import mix, n_words


def rows(rng, n=900):
    out = []
    for i in range(n):
        text = " ".join(rng.choices(["a", "bb", "é", "|", "***"], [9, 9, 3, 0.2, 0.2], k=rng.randint(0, 30)))
        out.append((None if i % 97 == 5 else i, rng.choice([text, text, None]) if i % 10 == 0 else text, rng.choice(["s1"] * 6 + ["s2", "s3", None]), rng.choice(["en", "en", "de"])))
    return out


def form(t):
    return "table" if " | " in t else "markup" if "***" in t else "prose"


def brute(data, temper):
    """Raking on a numpy cube."""
    keys = [(s, lang, form(t or "")) for _, t, s, lang in data]
    tokens = np.array([len((t or "").split()) for _, t, _, _ in data], float)
    values = [sorted({k[d] for k, n in zip(keys, tokens) if n}, key=str) for d in range(3)]
    cube = np.zeros([len(v) for v in values])
    for k, n in zip(keys, tokens):
        if n:
            cube[tuple(v.index(x) for v, x in zip(values, k))] += n
    w = cube.copy()
    targets = []
    for d in range(3):
        t = cube.sum(tuple(x for x in range(3) if x != d)) ** temper[mixing.DIMS[d]]
        targets.append(t / t.sum())
    for _ in range(500):
        for d in range(3):
            s = w.sum(tuple(x for x in range(3) if x != d), keepdims=True)
            w = w * targets[d].reshape([-1 if x == d else 1 for x in range(3)]) / s
    f = np.divide(w, cube, out=np.zeros_like(w), where=cube > 0)
    f /= f.max()
    return [f[tuple(v.index(x) for v, x in zip(values, k))] if n else 0.0 for k, n in zip(keys, tokens)], f * cube, targets


def test_against_brute_force(spark):
    data = rows(random.Random(1))
    df = spark.createDataFrame([(*r, "clash", i) for i, r in enumerate(data)], "doc_id long, text string, source string, lang string, p string, tokens long").repartition(6)
    got = sorted(mix(df).collect(), key=lambda r: r.row.tokens)
    want, drawn, targets = brute(data, mixing.TEMPER)
    assert [r.probability for r in got] == pytest.approx(want, abs=1e-8)
    for d in range(3):  # the expected weights of the sample have the target marginals
        s = drawn.sum(tuple(x for x in range(3) if x != d))
        assert s / s.sum() == pytest.approx(targets[d], abs=1e-6)
    for r, (i, t, _, _) in zip(got, data):
        u = int(hashlib.md5(":".join(x for x in ("mix", None if i is None else str(i), t) if x is not None).encode()).hexdigest()[:13], 16) / (1 << 52)
        assert r.kept == (u < r.probability) and r.n_tokens == len((t or "").split())
    assert max(r.probability for r in got) == pytest.approx(1)
    share = sum(r.kept for r in got) / sum(r.probability for r in got)
    assert 0.85 < share < 1.15


def test_given_targets_and_topic(spark):
    data = [(i, "w " * 10, "a" if i % 3 else "b", "x") for i in range(30)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string")
    targets = spark.createDataFrame([("source", "=a", 1.0), ("source", "=b", 1.0), ("source", "=unseen", 0.0), ("lang", "=x", 2.0), ("topic", "=t", 1.0)], "dim string, value string, share double")
    got = mix(df, topic=F.lit("t"), targets=targets).groupBy("row.source").agg(F.max("probability").alias("p")).collect()
    assert {r.source: pytest.approx(r.p) for r in got} == {"a": 0.5, "b": 1.0}
    none = spark.createDataFrame([("source", "=a", 1.0), ("lang", "=x", 1.0), ("topic", "=t", 1.0)], targets.schema)
    assert not mix(df, topic=F.lit("t"), targets=none).filter("row.source = 'b' AND kept").count()


def test_edges(spark):
    schema = "doc_id long, text string, source string, lang string"
    assert mix(spark.createDataFrame([], schema)).count() == 0
    only = mix(spark.createDataFrame([(1, None, None, None), (2, " \t", "a", "x")], schema)).collect()
    assert [(r.n_tokens, r.probability, r.kept) for r in only] == [(0, 0.0, False)] * 2
    twice = mix(spark.createDataFrame([(1, "a b", "s", "x")] * 2 + [(2, "w " * 40000, "s", "x")], schema)).collect()
    assert {(r.row.doc_id, r.n_tokens, r.kept) for r in twice} == {(1, 2, True), (2, 40000, True)}
    assert spark.range(1).select(n_words(F.lit("\t a\x0b b \r\n"))).first()[0] == 2
    assert "Python" not in mix(spark.createDataFrame([(1, "a", "s", "x")], schema))._jdf.queryExecution().toString()


def brute_sized(cube, targets, size):
    """Take short cells whole, rake the others to what the targets lack."""
    whole = np.zeros(cube.shape, bool)
    while True:
        free = np.where(whole, 0.0, cube)
        left, w = size - cube[whole].sum(), free.copy()
        lacking = []
        for d in range(3):
            others = tuple(x for x in range(3) if x != d)
            t = np.maximum(targets[d] * size - np.where(whole, cube, 0).sum(others), 0) * (free.sum(others) > 0)
            lacking.append(t / max(t.sum(), 1e-300))
        for _ in range(60):
            for d in range(3):
                s = w.sum(tuple(x for x in range(3) if x != d), keepdims=True)
                w = w * np.divide(lacking[d].reshape([-1 if x == d else 1 for x in range(3)]), s, out=np.zeros_like(s), where=s > 0)
        w *= max(left, 0.0)
        short = ~whole & (cube > 0) & (w >= cube)
        if not short.any():
            return np.where(whole, 1.0, np.divide(w, cube, out=np.zeros_like(w), where=cube > 0))
        whole |= short


def test_a_target_size(spark):
    """One tiny cell that the targets raise does not shrink a mix of a given size."""
    rng = random.Random(6)
    data = []
    for i in range(400):
        k = (rng.choice(["s1"] * 8 + ["s2"] * 3), rng.choice(["en", "en", "de"]))
        data.append((i, " ".join(["w"] * rng.randint(1, 40)), *k))
    data += [(900, "w w w", "tiny", "en"), (901, None, "s1", "en"), (902, "", None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, lang string")
    total = sum(len((t or "").split()) for _, t, _, _ in data)
    plain = mix(df).agg(F.sum(F.col("probability") * F.col("n_tokens"))).first()[0]
    size = 0.5 * total
    assert plain < 0.2 * size
    got = mix(df, tokens=size).collect()
    cells = {}
    for _, t, a, b in data:
        if t:
            cells[a, b, "prose"] = cells.get((a, b, "prose"), 0) + len(t.split())
    values = [sorted({k[d] for k in cells}) for d in range(3)]
    cube = np.zeros([len(v) for v in values])
    for k, n in cells.items():
        cube[tuple(v.index(x) for v, x in zip(values, k))] = n
    targets = []
    for d in range(3):
        t = cube.sum(tuple(x for x in range(3) if x != d)) ** mixing.TEMPER[mixing.DIMS[d]]
        targets.append(t / t.sum())
    want = brute_sized(cube, targets, size)
    for r in got:
        p = want[tuple(v.index(x) for v, x in zip(values, (r.row.source, r.row.lang, "prose")))] if r.n_tokens else 0.0
        assert r.probability == pytest.approx(p, abs=1e-6)
    assert {r.probability for r in got if r.row.source == "tiny"} == {1.0}
    assert sum(r.probability * r.n_tokens for r in got) == pytest.approx(size, rel=1e-6)
    every = mix(df, tokens=2.0 * total).collect()
    assert all(r.probability == (1.0 if r.n_tokens else 0.0) for r in every) and len(every) == len(data)
    assert mix(df.limit(0), tokens=10.0).count() == 0
