import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shopmart.llm import _text as T
from shopmart.llm import substring_dedup
from shopmart.llm.substring_dedup import remove_repeated_windows


def brute(texts, k):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(d[i:i + k]) for d in docs for i in range(len(d) - k + 1))
    out = []
    for d in docs:
        gone = set()
        for i in range(len(d) - k + 1):
            if seen[tuple(d[i:i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((len(d), len(gone), " ".join(w for i, w in enumerate(d) if i not in gone)))
    return out


def texts(rng, n=60):
    vocab = ["a", "bb", "é", "x y", "ccc", "dé", " ", "1"] + [f"w{i}" for i in range(40)]
    shared = [" ".join(rng.choices(vocab, k=rng.randint(3, 25))) for _ in range(4)]
    out = [None, "", "   \t\n", "one", shared[0], shared[0]]
    for _ in range(n):
        out.append(rng.choice([" ", "\n", "\t ", "\x0b"]).join(rng.choices(vocab, k=rng.randint(1, 60)) + rng.choice([[], [rng.choice(shared)]]) + rng.choices(vocab, k=rng.randint(0, 9))))
    return out + ["a " * 500, out[-1], out[-1]]


def run(spark, rows, k):
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string, slice int")
    got = remove_repeated_windows(df, window=k)
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect())


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    t = texts(rng)
    ids = [None if i % 17 == 0 else i % 50 for i in range(len(t))]  # null and repeated ids
    rows = [(i, x, "clash", None) for i, x in zip(ids, t)]
    for k in (3, 8):
        want = Counter((i, *w) for i, w in zip(ids, brute(t, k)))
        assert run(spark, rows, k) == want
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 500)  # many buckets
    assert run(spark, rows, 3) == Counter((i, *w) for i, w in zip(ids, brute(t, 3)))


def test_sizes_follow_the_corpus(spark, monkeypatch):
    bucket, piece = substring_dedup.BUCKET_BYTES, T.SLICE_BYTES
    assert substring_dedup.sizes(0) == substring_dedup.sizes(10 ** 11) == (bucket, piece)
    for size in (10 ** 12, 10 ** 13, 10 ** 14):
        b, s = substring_dedup.sizes(size)
        rows = (size / b) * (size / s)
        assert 0.99 * substring_dedup.ROW_BYTES <= size / rows <= 1.01 * substring_dedup.ROW_BYTES
    assert max(substring_dedup.sizes(10 ** 14)) < 400 << 20
    t = texts(random.Random(8))
    monkeypatch.setattr(substring_dedup, "ROW_BYTES", 10 ** 13)  # as if the corpus were large
    assert run(spark, [(i, x, "clash", None) for i, x in enumerate(t)], 5) == Counter((i, *w) for i, w in enumerate(brute(t, 5)))


def test_small_slices_and_spans(spark):
    a = " ".join(f"p{i}" for i in range(50))
    df = spark.createDataFrame([(1, "x " + a), (2, a + " y"), (3, "z")], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in remove_repeated_windows(df).collect()}
    assert got[1].removed == [1, 51] and got[2].removed == [0, 50] and got[3].removed == []
    assert got[1].kept == "x" and got[2].kept == "y"


def test_hashes_do_not_depend_on_the_stretch(monkeypatch):
    data = np.frombuffer(" ".join(random.Random(1).choices(["a", "bb", "é" * 40, "ccc"], k=500)).encode(), np.uint8)
    start, end, first = T.words(data, np.array([0, len(data)]), T.RAW_WORD)
    whole = T.word_hashes(data, start, end)
    windows = T.window_hashes(whole, T.window_starts(first, 7), 7)
    monkeypatch.setattr(T, "SLICE_BYTES", 50)
    assert np.array_equal(T.word_hashes(data, start, end), whole)
    assert np.array_equal(T.window_hashes(whole, T.window_starts(first, 7), 7), windows)
    words = bytes(data).split()
    assert len(set(whole.tolist())) == len(set(words)) and len(dict(zip(whole.tolist(), words))) == len(set(words))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeated_windows(df).count() == 0
    empty = spark.createDataFrame([(None, None)], "doc_id long, text string")
    r = remove_repeated_windows(empty).withColumn("h", F.sha2("kept", 256)).first()
    assert (r.n_words, r.n_removed, r.h) == (0, 0, hashlib.sha256(b"").hexdigest())


def test_long_words_that_sums_modulo_two_to_the_64_take_for_equal():
    a = [0]
    while len(a) < 4096:
        a += [1 - x for x in a]
    data = np.array(a + [1 - x for x in a], np.uint8) + 0x61
    hashes = T.word_hashes(data, np.array([0, 4096, 8000]), np.array([4096, 8192, 8192]))
    assert len(set(hashes.tolist())) == 3
    short = T.word_hashes(data, np.array([0, 10]), np.array([10, 20]))
    again = T.word_hashes(data[10:], np.array([0]), np.array([10]))
    assert short[1] == again[0] != short[0]
