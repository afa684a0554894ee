"""Quality classifier: linear SVM on n-gram indicators scaled by naive Bayes log-count ratios.

Indicators: hashed word unigrams and bigrams, and unigrams to trigrams of
word shapes (case, final characters, length, whether the word repeats the one
before).  The log-count ratios count every labelled training row; the hinge
loss is fitted by dual coordinate descent on a bounded sample of them
(``SAMPLE``), part of which is kept back to turn margins into probabilities.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm import _text as T
from shopmart.llm._store import shipped

BITS = 18
#: Labelled rows on which the hinge loss is fitted, at most; every fourth is kept back for calibration.
SAMPLE = 8192
_BLOCKS, _SPREAD = 32, 64
#: Bytes of a long text that are taken at a time.
STRETCH = T.SLICE_BYTES


def _kind_table() -> np.ndarray:
    kind = np.zeros(256, np.uint64)  # other characters count as themselves
    kind[:] = np.arange(256) + 8
    kind[0x30:0x3A], kind[0x41:0x5B], kind[0x61:0x7B], kind[0x80:] = 1, 2, 3, 4
    return kind


_KIND = _kind_table()


def _values(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape of each word; ``last`` holds the word before the first one, if there is one."""
    word = T.word_hashes(T.LOWER[data], start, end)
    new_doc = np.zeros(len(start) + 1, bool)
    new_doc[first] = True
    repeats = np.concatenate([[False], word[1:] == word[:-1]]) & ~new_doc[:-1]
    if len(last):
        repeats[0] = word[0] == last[0]
    shape = _KIND[data[start]]
    for at, room in ((np.minimum(start + 1, end - 1), 300), (np.maximum(end - 2, start), 300), (end - 1, 300)):
        shape = shape * np.uint64(room) + _KIND[data[at]]
    shape = shape * np.uint64(10) + np.minimum(np.log2(end - start).astype(np.uint64), 4) * np.uint64(2) + repeats.astype(np.uint64)
    return word, T.mix(shape)


def _keys(word: np.ndarray, shape: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct document << ``BITS`` | feature, sorted."""
    doc_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keys = []
    for salt, (values, n) in enumerate([(word, 1), (word, 2), (shape, 1), (shape, 2), (shape, 3)]):
        at = T.window_starts(first, n)
        h = T.mix(T.window_hashes(values, at, n) + np.uint64(salt)) >> np.uint64(64 - BITS)
        keys.append((doc_of[at] << BITS) + h.astype(np.int64))
    keys = np.sort(np.concatenate(keys))
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _of_long(data: np.ndarray) -> np.ndarray:
    """Features of one long text, a stretch at a time; the last two words go along to the next stretch."""
    word, shape, found = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for part in T.stretches(data, STRETCH):
        start, end, first = T.words(part, np.array([0, len(part)]), T.RAW_WORD)
        if len(start):
            w, s = _values(part, start, end, first, word[-1:])
            word, shape = np.concatenate([word[-2:], w]), np.concatenate([shape[-2:], s])
            found = np.union1d(found, _keys(word, shape, np.array([0, len(word)])))
    return found


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs of a slice, by document."""
    data, off = T.utf8(column)
    edges = [0]  # long texts by themselves, what lies between them together
    for d in np.flatnonzero(np.diff(off) > STRETCH).tolist():
        edges += [d, d + 1]
    keys = [np.zeros(0, np.int64)]
    for a, b in zip(edges, [*edges[1:], len(off) - 1]):
        if a == b:
            continue
        part, inner = data[off[a]: off[b]], off[a: b + 1] - off[a]
        if b == a + 1 and len(part) > STRETCH:
            found = _of_long(part)
        else:
            start, end, first = T.words(part, inner, T.RAW_WORD)
            found = _keys(*_values(part, start, end, first, start[:0]), first) if len(start) else keys[0][:0]
        keys.append(found + (a << BITS))
    keys = np.concatenate(keys)
    return keys >> BITS, keys & ((1 << BITS) - 1)


@dataclass
class Model:
    weight: np.ndarray  # ratio * w, and the ratio's square for the norm
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, column: pa.Array) -> np.ndarray:
        doc, f = features(column)
        n = len(column)
        norm = np.sqrt(np.bincount(doc, self.square[f], n))
        return np.bincount(doc, self.weight[f], n) / np.maximum(norm, 1e-12) + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(column) + self.shift, -60, 60)))


def _gathered(batches):
    """Per task: feature counts by class (in blocks), and the features of sampled rows (columns text, label, sampled, u)."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    names = ["block", "counts", "label", "features", "u"]
    seen = False
    for part in T.slices(batches, 0):
        seen = True
        doc, f = features(part.column(0))
        label = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        counts += np.bincount((label[doc] << BITS) + f, minlength=2 << BITS).reshape(2, -1)
        sampled = np.flatnonzero(part.column(2).to_numpy(zero_copy_only=False))
        if len(sampled):
            cut = np.searchsorted(doc, [sampled, sampled + 1])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(sampled), -1), pa.int32()), pa.nulls(len(sampled), pa.binary()), pa.array(label[sampled], pa.int32()),
                pa.array([f[a:b].astype("<i4").tobytes() for a, b in zip(*cut)], pa.binary()), part.column(3).take(pa.array(sampled))], names=names)
    if seen:
        blocks = counts.astype("<i4").reshape(2, _BLOCKS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(_BLOCKS), pa.int32()), pa.array([blocks[:, b].tobytes() for b in range(_BLOCKS)], pa.binary()), pa.nulls(_BLOCKS, pa.int32()), pa.nulls(_BLOCKS, pa.binary()), pa.nulls(_BLOCKS, pa.int64())], names=names)


def _summed(batches, kind: str):
    """Blocks of counts, summed as the rows stream in; sampled rows pass through."""
    sums: dict[int, np.ndarray] = {}
    names = ["block", "counts", "label", "features", "u"]
    for batch in batches:
        sample = batch.filter(pa.array(batch.column(0).to_numpy() < 0))
        if sample.num_rows:
            yield sample
        for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if b >= 0:
                sums[b] = sums.get(b, 0) + np.frombuffer(c, kind).astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary()), pa.nulls(len(sums), pa.int32()), pa.nulls(len(sums), pa.binary()), pa.nulls(len(sums), pa.int64())], names=names)


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: np.ndarray, epochs: int = 12, seed: int = 5) -> np.ndarray:
    """Weights of the L2-regularised hinge loss: one dual variable a row, in [0, cost], each set to its optimum in turn."""
    w, alpha = np.zeros(size), np.zeros(len(rows))
    square = np.array([v @ v for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        change = 0.0
        for i in rng.permutation(len(rows)):
            f, v = rows[i]
            new = min(max(alpha[i] - (y[i] * (w[f] @ v) - 1) / square[i], 0.0), cost[i])
            if new != alpha[i]:
                w[f] += (new - alpha[i]) * y[i] * v
                change = max(change, abs(new - alpha[i]))
                alpha[i] = new
        if change < 1e-3:
            break
    return w


def _calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of the margins (Newton steps, smoothed targets)."""
    good = y > 0
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    x, p = np.stack([margin, np.ones(len(margin))], 1), np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (q * (1 - q))[:, None]) + 1e-3 * np.eye(2), x.T @ (q - target) + 1e-3 * p)
        p = p - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(p[0]), float(p[1])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Texts with their labels.  Labels grow with the documents, so they are never broadcast: one plan at every size.

    Rows without an id have no label; a document with several labels is a row for each.
    """
    return docs.select(id_col, text_col).join(labels.select(id_col, label_col).hint("merge"), id_col)


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "quality", key_col: str = "doc_id", cost: float = 1.0) -> Model:
    """Fit on rows with a label 0 or 1 (others are left out); ``key_col`` only picks the sample.

    Null and empty texts are rows without features.  Without rows of both
    classes the model scores every text by the share of label 1 (0.5 for none).
    """
    spark = labelled.sparkSession
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("label"), F.pmod(F.xxhash64(F.lit(4), F.col(key_col)), F.lit(1 << 20)).alias("u"))
    n = rows.count()  # reads no text
    share = -(-(1 << 20) * SAMPLE // n) if n > SAMPLE else 1 << 20
    gathered = rows.select("text", "label", (F.col("u") < share).alias("sampled"), "u").mapInArrow(_gathered, "block int, counts binary, label int, features binary, u long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # two steps, so that no task receives the counts of all tasks
    apart = F.pmod(F.xxhash64("features", "u"), F.lit(parts))  # copies of a text have ids of their own
    some = gathered.repartition(parts, "block", F.when(F.col("block") >= 0, F.spark_partition_id() % _SPREAD).otherwise(apart)).mapInArrow(lambda it: _summed(it, "<i4"), gathered.schema)
    out = some.repartition(parts, "block", F.when(F.col("block") < 0, apart)).mapInArrow(lambda it: _summed(it, "<i8"), gathered.schema).toArrow()
    counts, x, y = np.zeros((2, _BLOCKS, (1 << BITS) // _BLOCKS)), [], []
    for b, c, label, f in zip(*(out.column(i).to_pylist() for i in range(4))):
        if b >= 0:
            counts[:, b] = np.frombuffer(c, np.int64).reshape(2, -1)
        else:
            x.append(np.frombuffer(f, "<i4"))
            y.append(2 * label - 1)
    del out
    counts = counts.reshape(2, -1) + 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    order = sorted(range(len(x)), key=lambda i: (hashlib.blake2b(x[i], digest_size=16).digest(), y[i]))  # as it came is not an order
    y = np.array([y[i] for i in order])
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(1 << BITS), ratio ** 2, 0.0, 0.0, 0.0 if not len(y) else 4.0 * y[0])
    bias = 1 << BITS  # a feature of its own
    rows = []
    for i in order:
        v = ratio[x[i]]
        v /= max(np.linalg.norm(v), 1e-12)
        rows.append((np.append(x[i], np.int32(bias)), np.append(v, 1.0).astype(np.float32)))
        x[i] = None
    balance = len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    kept_back = np.zeros(len(y), bool)
    for sign in (-1, 1):  # every fourth of each class
        kept_back[np.flatnonzero(y == sign)[3::4]] = True
    if len(set(y[kept_back].tolist())) < 2:
        kept_back[:] = False
    on = np.flatnonzero(~kept_back)
    w = dual_coordinate_descent([rows[i] for i in on], y[on], bias + 1, cost * balance[on])
    check = np.flatnonzero(kept_back) if kept_back.any() else on
    slope, shift = _calibrated(np.array([w[rows[i][0]] @ rows[i][1] for i in check]), y[check])
    return Model(ratio * w[:-1], ratio ** 2, float(w[-1]), slope, shift)


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (the columns in ``keep``) and ``score`` (0 to 1) for every text.

    Null and empty texts have no features and all get the same score, that of
    the bias.  The score depends on the text alone, so repeated rows agree.
    """
    get = shipped(docs.sparkSession, model)
    return T.map_text(docs, text_col, keep, "score double", lambda text: [pa.array(get().scores(text), pa.float64())])
