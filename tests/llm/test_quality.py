import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shopmart.llm import quality
from shopmart.llm.quality import dual_coordinate_descent, features, fit, score


def corpus(rng, n=300):
    words = ["the", "and", "of", "tree", "house", "river", "stone", "was", "in", "a"]
    rows = []
    for i in range(n):
        w = [rng.choice(words) + rng.choice(words) for _ in range(rng.randint(3, 60))]
        good = rng.random() < 0.7
        rows.append((i, " ".join(w if good else [x.upper() + "!!" for x in w]), int(good)))
    return rows


def test_features_are_distinct_and_by_document():
    texts = ["a b a b", None, "", "a b", "x " * 50]
    doc, f = features(pa.array(texts))
    assert len(set(zip(doc.tolist(), f.tolist()))) == len(doc) and (np.diff(doc) >= 0).all()
    for i, t in enumerate(texts):
        alone = features(pa.array([t]))[1]
        assert np.array_equal(alone, f[doc == i])


def test_long_texts_in_stretches(monkeypatch):
    """Features do not depend on where a long text is cut, words longer than a stretch included."""
    rng = random.Random(7)
    words = ["a", "a", "Bc!", "é", "x" * 40, "y" * 300, "42"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", "  \t"]) for _ in range(rng.randint(0, 60))) for _ in range(30)]
    texts += [None, "", " " * 90, "z" * 900, "z" * 900 + " z", " a a"]
    want = features(pa.array(texts))
    for stretch in (1, 7, 50, 400):
        monkeypatch.setattr(quality, "STRETCH", stretch)
        got = features(pa.array(texts))
        assert all(np.array_equal(x, y) for x, y in zip(got, want))


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5))
    y = np.where(x @ [1, -2, 0.5, 0, 1] + 0.3 * rng.normal(size=60) > 0, 1, -1)
    rows = [(np.arange(5), v) for v in x]
    cost = np.full(60, 0.7)
    w = dual_coordinate_descent(rows, y, 5, cost, epochs=2000)

    def primal(w):
        return w @ w / 2 + (cost * np.maximum(0, 1 - y * (x @ w))).sum()

    assert all(primal(w) <= primal(w + d) + 1e-3 for d in 0.05 * rng.normal(size=(300, 5)))


def test_held_out_accuracy_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 150)  # fewer rows than there are
    rows = corpus(random.Random(3))
    train = spark.createDataFrame(rows[:200] + [(1000, None, 1), (1001, "", 1), (1002, "odd label", 7), (1003, "none", None), (None, "the", 1)], "doc_id long, text string, quality int")
    model = fit(train)
    test = spark.createDataFrame([(i, t, "clash", q) for i, t, q in rows[200:]] + [(None, None, "x", None), (5, "", "x", None), (6, "x " * 30000, "x", None)], "doc_id long, text string, score string, label int")
    got = score(test, model, ["doc_id", "score", "label"]).collect()
    assert len(got) == 103 and all(0 <= r.score <= 1 for r in got)
    judged = [(r.score >= 0.3) == bool(r.row.label) for r in got if r.row.label is not None]
    assert np.mean(judged) >= 0.97
    empty = {r.score for r in got if r.row.doc_id in (None, 5) and r.row.label is None}
    assert len(empty) == 1
    again = score(test, fit(train.repartition(7)), ["doc_id"]).agg(F.sum("score")).first()[0]
    assert abs(again - sum(r.score for r in got)) < 1e-6  # however the rows are dealt


def test_without_classes(spark):
    schema = "doc_id long, text string, quality int"
    one = fit(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema))
    none = fit(spark.createDataFrame([], schema))
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert score(docs, one, ["doc_id"]).first().score > 0.9
    assert score(docs, none, ["doc_id"]).first().score == 0.5
    assert score(docs.limit(0), none, ["doc_id"]).count() == 0
