"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the 1- to 3-grams of all labelled texts, task by task, into a
language x hash matrix that Spark sums by language; the log-probability matrix
(bounded: ``MAX_LANGS`` x 2**``BITS``) is broadcast and texts are scored in
sparse batches: the rows of the n-grams that occur, summed by document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm import _text as T
from shopmart.llm._store import shipped

BITS = 16
#: Languages that may be learned; bounds the matrix that is broadcast.
MAX_LANGS = 512
_SLICE = 1 << 20
#: Characters of a long text that are taken at a time.
STRETCH = 1 << 20


_LETTERS = T.Cache()


def _letters(code: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS["low"] = np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16)
    letter = _LETTERS["low"][np.minimum(code, (1 << 16) - 1)]
    high = np.flatnonzero(code >> 16)
    letter[high] = [chr(c).isalpha() for c in code[high].tolist()]
    return letter


def grams(texts: list[str | None], starts: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and hash of every n-gram that holds a letter, by document, and the documents that have a letter.

    Texts are lower-cased, characters that are no letters count as one blank
    each.  With ``starts``, only n-grams that begin in the first so many
    characters count (for one text).
    """
    texts = [(t or "").lower() for t in texts]
    size = np.array([len(t) for t in texts], np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    letter = _letters(code)
    code = np.where(letter, code, 32).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), size)
    docs, hashes = [], []
    h = code
    for n in (1, 2, 3):
        if len(code) < n:
            break
        if n > 1:
            h = h[:-1] * np.uint64(0x100000001B3) + code[n - 1:]
        here = doc[n - 1:] == doc[: len(doc) - n + 1]
        # a 1-gram is a letter, a 3-gram has one in the middle, a 2-gram at either end
        here &= letter[n // 3: n // 3 + len(h)] | (letter[1: 1 + len(h)] if n == 2 else False)
        if starts is not None:
            here[starts:] = False
        docs.append(doc[: len(h)][here])
        hashes.append((T.mix(h[here] + np.uint64(n << 56)) >> np.uint64(64 - BITS)).astype(np.int32))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(len(texts), bool)
    has = np.bincount(doc[letter], minlength=len(texts)) > 0
    return np.concatenate(docs), np.concatenate(hashes), has


def _parts(texts: list[str | None]):
    """The short texts together, and each long one a stretch at a time: numbers of the texts, and their ``grams``."""
    short = [i for i, t in enumerate(texts) if len(t or "") <= STRETCH]
    if short:
        yield np.array(short), *grams([texts[i] for i in short])
    for i, t in enumerate(texts):
        if len(t or "") > STRETCH:
            t = t.lower()
            for a in range(0, len(t), STRETCH):  # two characters more end the n-grams that begin here
                yield np.array([i]), *grams([t[a: a + STRETCH + 2]], STRETCH)


@dataclass
class Model:
    langs: list[str]
    log_prob: np.ndarray  # hash x language
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        total, has = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), bool)
        for at, doc, h, letters in _parts(texts):
            has[at] |= letters
            for k in range(len(self.langs)):
                total[at, k] += np.bincount(doc, self.log_prob[:, k][h], len(at))
        total += self.prior
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = np.argmax(total, 1)
        score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, has)], np.where(has, score, 0.0)


def _counted(batches):
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for part in T.slices(batches, 0, _SLICE):
        langs = np.array(part.column(1).to_pylist(), object)
        names, which = np.unique(langs.astype(str), return_inverse=True)
        found, has = np.zeros((len(names), 1 << BITS), np.int64), np.zeros(len(langs), bool)
        for at, doc, h, letters in _parts(part.column(0).to_pylist()):
            has[at] |= letters
            found += np.bincount((which[at[doc]].astype(np.int64) << BITS) + h, minlength=len(names) << BITS).reshape(len(names), -1)
        for k, name in enumerate(names):
            counts[name] = counts.get(name, 0) + found[k]
            docs[name] = docs.get(name, 0) + int(has[which == k].sum())
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array([docs[k] for k in counts], pa.int64()), pa.array([c.astype("<i8").tobytes() for c in counts.values()], pa.binary())], names=["lang", "docs", "counts"])


def _summed(batches):
    """Sums of the count rows of each language, as they stream in."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for name, n, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
            counts[name] = counts.get(name, 0) + np.frombuffer(c, "<i8")
            docs[name] = docs.get(name, 0) + n
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array([docs[k] for k in counts], pa.int64()), pa.array([c.astype("<i8").tobytes() for c in counts.values()], pa.binary())], names=["lang", "docs", "counts"])


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on all rows with a language; null or letterless texts add nothing.

    Raises ValueError beyond ``MAX_LANGS`` languages.  Add-one smoothing; the
    prior is a language's share of the training texts.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted = rows.mapInArrow(_counted, "lang string, docs long, counts binary")
    # rows are per task and language; two steps, so that no task receives those of all tasks
    parts = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = counted.repartition(parts, "lang", F.spark_partition_id() % 64).mapInArrow(_summed, counted.schema)
    found = some.repartition(parts, "lang").mapInArrow(_summed, counted.schema).limit(MAX_LANGS + 1).toArrow().sort_by("lang")
    if found.num_rows > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    langs = found.column("lang").to_pylist()
    if not langs:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    counts = np.stack([np.frombuffer(c, "<i8") for c in found.column("counts").to_pylist()], 1) + 1.0
    docs = found.column("docs").to_numpy() + 1.0
    return Model(langs, np.log(counts / counts.sum(0)), np.log(docs / docs.sum()))


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (the columns in ``keep``), ``lang_pred`` and ``score`` (posterior probability) of every whole text.

    ``und`` with score 0 if the text is null or has no letter, or nothing was
    learned; ties go to the first language by name.  Depends on the text alone.
    """
    get = shipped(docs.sparkSession, model)

    def run(text: pa.Array) -> list[pa.Array]:
        texts = text.to_pylist()
        langs, scores = get().predict(texts)
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return T.map_text(docs, text_col, keep, "lang_pred string, score double", run)
