import random
import re

import numpy as np
import pytest

from shopmart.llm import decontaminate
from shopmart.llm.decontaminate import contaminated, find_benchmark
from shopmart.llm.fm_index import FMIndex, suffix_order

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return [m.span() + (m.group(),) for m in WORD.finditer(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))]


def brute(text, items, k):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        p = [x[2] for x in words(t)]
        for win in [p[i:i + k] for i in range(len(p) - k + 1)] if len(p) >= k else [p] if p else []:
            for i in range(len(w) - len(win) + 1):
                if [x[2] for x in w[i:i + len(win)]] == win:
                    hit.update(range(i, i + len(win)))
                    if item is not None:
                        found.add(str(item))
    spans = []
    for i in sorted(hit):
        a, b = (len((text[:x]).encode()) for x in w[i][:2])
        if i - 1 in hit:
            spans[-1] = b
        else:
            spans += [a, b]
    return len(w), len(hit), sorted(found), spans


def test_index_against_brute_force():
    rng = np.random.default_rng(1)
    for n_symbols in (2, 3, 9):
        seq = np.concatenate([np.append(rng.integers(1, n_symbols, n), 0) for n in (1, 5, 40, 40, 200)])
        order = suffix_order(seq)
        assert sorted(order) == list(range(len(seq)))
        text = "".join(chr(64 + x) for x in seq)
        by = sorted(range(len(seq)), key=lambda i: text[i:].split("@")[0])
        assert [text[i:].split("@")[0] for i in order] == [text[i:].split("@")[0] for i in by]
        index = FMIndex(seq, n_symbols)
        phrases = np.array([np.pad(rng.integers(1, n_symbols, m), (0, 4 - m)) for m in rng.integers(1, 5, 50)])
        lengths = (phrases > 0).sum(1)
        low, high = index.search(phrases, lengths)
        for p, m, a, b in zip(phrases, lengths, low, high):
            want = {i for i in range(len(seq) - m + 1) if (seq[i:i + m] == p[:m]).all()}
            assert set(index.locate(np.arange(a, max(a, b))).tolist()) == want


@pytest.mark.parametrize("block", [32 << 20, 1])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "MAX_BENCHMARK_BYTES", block)  # 1: each item a pass of its own
    rng = random.Random(5)
    vocab = ["A", "b", "Çé", "c1", "dd", "x"] + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(4, 12)))) for i in range(3)]
    items += [(7, "q9 z"), (8, None), (9, " .,"), (None, "null item words here"), items[0], (11, items[1][1])]
    texts = [None, "", "...", "q9, Z!", "Q9", items[0][1], items[0][1].upper() + " " + items[0][1], "null ITEM words here"]
    for _ in range(60):
        mid = rng.choice(items[:4])[1].split()
        texts.append(rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, k=rng.randint(0, 40)) + mid[rng.randint(0, 3):] + rng.choices(vocab, k=rng.randint(0, 40))))
    texts.append("c1 " * 3000 + items[2][1])
    rows = [(None if i % 9 == 0 else i, t, "clash", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, items string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_benchmark(docs, bench, ["doc_id", "n_hit"], window=5).withColumn("bad", contaminated())
    for r in got.collect():
        n, hit, found, spans = brute(texts[r.row.n_hit], items, 5)
        assert (r.n_words, r.n_hit, r["items"], r.spans) == (n, hit, found, spans)
        assert r.bad == (hit > 0 and 20 * hit >= n)
        assert r.row.doc_id == rows[r.row.n_hit][0]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    r = find_benchmark(docs, none, ["doc_id"]).first()
    assert (r.n_words, r.n_hit, r["items"]) == (3, 0, [])
    assert find_benchmark(docs.limit(0), spark.createDataFrame([(1, "a b")], none.schema), ["doc_id"]).count() == 0


def test_pieces_and_blocks(spark, monkeypatch):
    """Long items in pieces, several blocks: as in one."""
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randint(0, 9)}" for _ in range(n))) for i, n in enumerate([300, 0, 1, 3, 4, 5, 41])]
    texts = [" ".join(f"w{rng.randint(0, 9)}" for _ in range(60)) + " " + items[0][1][at:at + 200] for at in range(0, 700, 90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    want = [brute(t, items, 4) for t in texts]
    for piece, limit in ((1 << 16, 32 << 20), (7, 32 << 20), (50, 1000)):
        monkeypatch.setattr(decontaminate, "PIECE", piece)
        monkeypatch.setattr(decontaminate, "MAX_BENCHMARK_BYTES", limit)
        got = find_benchmark(docs, bench, ["doc_id"], window=4).orderBy("row.doc_id").collect()
        assert [(r.n_words, r.n_hit, r["items"], r.spans) for r in got] == want
