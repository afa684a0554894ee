import random
import re
from collections import Counter

import numpy as np
import pytest

from shopmart.llm import collocations as C


@pytest.mark.parametrize("bits", [2, 13, 26, 63, 64, 65, 70, 125, 128, 130, 160])
def test_permutation_is_invertible_and_spreads(bits):
    rng = np.random.default_rng(bits)
    n = 4000
    sizes = C.lanes(bits)
    assert sum(sizes) == bits and max(sizes) <= 64
    key = [rng.integers(0, 1 << min(s, 62), n, dtype=np.uint64) & C._mask(s) for s in sizes]
    made = C.permuted(key, bits)
    assert all((m <= C._mask(s)).all() for m, s in zip(made, sizes))
    assert all(np.array_equal(a, b) for a, b in zip(C.restored(made, bits), key))
    if bits == 2:  # the whole domain
        assert sorted(C.permuted([np.arange(4, dtype=np.uint64)], 2)[0]) == [0, 1, 2, 3]
    elif bits > 20:
        key = [np.zeros(n, np.uint64) for _ in sizes]  # neighbours, alike in the high bits
        key[-1] = np.arange(n, dtype=np.uint64)
        top = C.permuted(key, bits)[0] >> np.uint64(sizes[0] - 4)
        assert np.bincount(top.astype(int), minlength=16).max() < n / 8


@pytest.mark.parametrize("width,n", [(1, 2), (9, 3), (13, 5), (25, 5), (26, 5), (32, 5), (32, 2)])
def test_packed_phrases(width, n):
    rng = np.random.default_rng(n)
    words = [rng.integers(0, 1 << width, 500, dtype=np.uint64).astype(np.uint32) for _ in range(n)]
    back = C.unpacked(C.packed(words, width), width, n)
    assert all(np.array_equal(a, b) for a, b in zip(words, back))


@pytest.mark.parametrize("bits,quotient,cut", [(26, 10, 3), (26, 26, 5), (39, 0, 0), (64, 12, 12), (70, 20, 4), (130, 11, 2), (160, 9, 9)])
def test_filter_is_lossless(bits, quotient, cut):
    rng = np.random.default_rng(bits)
    sizes = C.lanes(bits)
    keys = [rng.integers(0, 1 << min(s, 62), 300, dtype=np.uint64) & C._mask(s) for s in sizes]
    want, parts = Counter(), {}
    for _ in range(3):  # three shards
        at = np.concatenate([rng.integers(0, 300, 2000), np.zeros(900, int)])  # one key is hot
        key = [k[at] for k in keys]
        want.update(zip(*(k.tolist() for k in key)))
        made = C.Filter.of(key)
        assert made.counts.sum() == len(at)
        for number, data in made.segments(bits, quotient, cut):
            parts.setdefault(number, []).append(C.Filter.decoded(data, number, bits, quotient, cut))
    got = Counter()
    for number, filters in parts.items():
        f = C.Filter.merged(filters)
        assert not cut or set((f.key[0] >> np.uint64(sizes[0] - cut)).tolist()) == {number}
        got.update(dict(zip(zip(*(k.tolist() for k in f.key)), f.counts.tolist())))
    assert got == want


def brute(rows, least, top, longest=5):
    """rows: (lang, text)."""
    out = []
    by = {}
    for lang, text in rows:
        by.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in by.items():
        f, n = Counter(), 0
        for t in texts:
            t = re.sub("[A-Z]", lambda m: m[0].lower(), t)
            for piece in re.split("[.,;:!?\x0a-\x0d]", t):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                for k in range(1, longest + 1):
                    f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        often = {g: a for g, a in f.items() if a >= least}
        found = []
        for g, a in often.items():
            if len(g) < 2:
                continue
            if any(b >= a and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in often.items() if len(h) > len(g)):
                continue
            score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def texts(rng, n=160):
    vocab = ["the", "The", "of", "a", "new", "york", "city", "é", "ß\x01", "x|y", "\x1cq", " ", "-"] + [f"w{i}" for i in range(12)]
    rows = [(None, None), ("en", ""), ("en", " \t . ,\n"), ("en", "the " * 700), (None, "und one. " * 30), ("en", "tail"), ("de", "rare only here")]
    for i in range(n):
        words = rng.choices(vocab, weights=[1 / (j + 1) for j in range(len(vocab))], k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 4)):
            words[rng.randint(0, len(words)):0] = ["new", "york", "city", "hall", "steps"][: rng.randint(2, 5)]
        rows.append((rng.choice(["en", "de"]), "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\r\n", "?"]) for w in words)))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # several stretches, chunks, filters and segments
        monkeypatch.setattr(C.T, "SLICE_BYTES", 900)
        monkeypatch.setattr(C.T.slices, "__defaults__", (900,))
        monkeypatch.setattr(C, "CHUNK", 64)
        monkeypatch.setattr(C, "FILTER", 50)
        monkeypatch.setattr(C, "SEGMENT_BYTES", 200)
    rows = texts(random.Random(4))
    df = spark.createDataFrame([(l, t, "clash", 1) for l, t in rows], "lang string, text string, words string, at int").repartition(6)
    got = sorted(map(tuple, C.collocations(df, least=8, top=60).collect()))
    want = brute(rows, 8, 60)
    assert got == want and len({w[0] for w in want}) >= 2


def test_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000
    df = spark.createDataFrame([(big, 3 * big + 1, big + 7, big + 11), (100, 9 * 10**17, 100, 100)], "a long, n long, l long, r long")
    got = [r[0] for r in df.select(C._score(*(df[c] for c in "anlr"))).collect()]
    assert got == [1000 * big * (3 * big + 1) // ((big + 7) * (big + 11)), 1000 * 100 * 9 * 10**17 // 10**4]


def test_empty_and_rare(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(df).count() == 0
    rows = [("en", "a b c"), (None, None), ("en", "a. a. a. a.")]
    assert C.collocations(spark.createDataFrame(rows, df.schema), least=3).count() == 0
