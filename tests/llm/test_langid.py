import math
import random
from collections import Counter

import pytest

from shopmart.llm import langid
from shopmart.llm.langid import Model, fit, grams, predict

WORDS = {"aa": "the and of with that this from were".split(), "bb": "der die und nicht für über schön größe".split(), "cc": "что это как так и не он".split()}


def rows(rng, n):
    return [(i, " ".join(rng.choices(WORDS[lang], k=rng.randint(1, 30))) + rng.choice(["", " 123", "!"]), lang) for i, lang in enumerate(rng.choices(list(WORDS), k=n))]


def brute_grams(text):
    """n-grams as text, non-letters blanked, that hold a letter where the operator looks for it."""
    t = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    out = [c for c in t if c != " "]
    out += [t[i:i + 2] for i in range(len(t) - 1) if t[i:i + 2].strip()]
    return out + [t[i:i + 3] for i in range(len(t) - 2) if t[i + 1] != " "]


def test_grams_against_brute_force():
    texts = ["Ab c", None, "", "1 2", "é𝔸x", "a", "  z ", "ß" * 300]
    doc, h, has = grams(texts)
    for i, t in enumerate(texts):
        assert (doc == i).sum() == len(brute_grams(t)) and has[i] == any(c.isalpha() for c in t or "")
    name = {}
    for t in texts:  # equal n-grams, equal hashes, whatever surrounds them
        for a in ([t], ["q", t]):
            d, x, _ = grams(a)
            assert Counter(x[d == len(a) - 1].tolist()) == Counter(grams([t])[1].tolist())
    assert not name


def test_long_texts_in_stretches(monkeypatch):
    texts = ["ΑΣ ΣΑΣ" * 9, None, "x", "1" * 50, "ab 1 " * 20, "İé𝔸x" * 13, ""]
    doc, h, has = grams(texts)
    want = [Counter(h[doc == i].tolist()) for i in range(len(texts))]
    for stretch in (1, 2, 3, 10, 64):
        monkeypatch.setattr(langid, "STRETCH", stretch)
        got, letters = [Counter() for _ in texts], [False] * len(texts)
        for at, d, x, some in langid._parts(texts):
            for k, i in enumerate(at.tolist()):
                got[i].update(x[d == k].tolist())
                letters[i] |= bool(some[k])
        assert got == want and letters == has.tolist()


def test_against_naive_bayes(spark):
    rng = random.Random(5)
    train, test = rows(rng, 150), rows(rng, 60)
    extra = [(900, None, "aa"), (901, "...", "bb"), (902, "was", None)]
    model = fit(spark.createDataFrame(train + extra, "doc_id long, text string, lang string").repartition(5))
    assert model.langs == ["aa", "bb", "cc"]
    counts = {k: Counter() for k in WORDS}
    for _, t, lang in train:
        counts[lang].update(grams([t])[1].tolist())
    docs = Counter(lang for _, _, lang in train)
    logp = {k: [(docs[k] + 1) / (len(train) + 3), sum(c.values()) + (1 << langid.BITS), c] for k, c in counts.items()}
    got = predict(spark.createDataFrame([(i, t, 1) for i, t, _ in test], "doc_id long, text string, score int"), model, ["doc_id"]).collect()
    right = 0
    for r in got:
        _, t, lang = test[r.row.doc_id]
        total = {k: math.log(p) + sum(math.log((c[x] + 1) / n) for x in grams([t])[1].tolist()) for k, (p, n, c) in logp.items()}
        best = max(total, key=total.get)
        assert r.lang_pred == best and r.score == pytest.approx(1 / sum(math.exp(v - total[best]) for v in total.values()))
        right += best == lang
    assert right >= 0.95 * len(test)


def test_edge_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 .."), (None, "the"), (None, "the"), (4, "und " * 30000)], "doc_id long, text string")
    nothing = fit(spark.createDataFrame([], "text string, lang string"))
    assert {(r.lang_pred, r.score) for r in predict(docs, nothing, ["doc_id"]).collect()} == {("und", 0.0)}
    train = spark.createDataFrame([(w, k) for k, v in WORDS.items() for w in v], "text string, lang string")
    got = predict(docs, fit(train), ["doc_id"]).collect()
    assert sorted((r.row.doc_id or 0, r.lang_pred) for r in got) == [(0, "aa"), (0, "aa"), (1, "und"), (2, "und"), (3, "und"), (4, "bb")]
    assert predict(docs.limit(0), Model([], nothing.log_prob, nothing.prior), ["doc_id"]).count() == 0
    monkeypatch.setattr(langid, "MAX_LANGS", 2)
    with pytest.raises(ValueError):
        fit(train)
