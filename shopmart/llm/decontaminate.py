"""Benchmark decontamination: find the word windows of benchmark items in documents.

Each slice of documents is a training shard: an FM-index is built over its
word ids (suffix order by prefix doubling, wavelet tree over the transformed
sequence, sampled suffix positions), all test phrases are searched backward
at once, their occurrences are located and merged to spans of hit words.
Words outside the benchmark's vocabulary cannot take part in an occurrence:
they only separate runs, and runs shorter than the shortest phrase are left
out of the index.  One narrow pass over the documents, no shuffle.

Spark hashes the words of the items and packs them into blocks of checked size
(``MAX_BENCHMARK_BYTES``); long items are cut into pieces that share words, so
that no window is lost.  The phrases of one block at a time pass the driver
and are broadcast; a larger benchmark is searched in several passes, one for
each block, whose hits are merged by document, and a block is released before
the next one is sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.llm import _text as T
from shopmart.llm._store import lent, stored
from shopmart.llm.fm_index import FMIndex

#: Bytes of hashed benchmark words (8 a word) whose phrases are broadcast at once; what is sent has at most 40 bytes a word.
MAX_BENCHMARK_BYTES = 32 << 20
#: Windows of an item that stay together.
PIECE = 1 << 16


class Phrases:
    """The distinct phrases of a block of pieces of items, as ends and lengths in one sequence of vocabulary ids."""

    def __init__(self, ids: list, pieces: list, window: int):
        first = np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])
        self.vocabulary, word = np.unique(np.concatenate([np.zeros(0, np.uint64), *pieces]), return_inverse=True)
        self.symbols = word.astype(np.int32) + 1
        size = np.diff(first)
        length, n = np.minimum(size, window), np.where(size > 0, np.maximum(size - window, 0) + 1, 0)
        owner = np.repeat(np.arange(len(size)), n)
        start = first[owner] + np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
        self.ids = np.array(ids, object)
        which, ends, lengths = np.zeros(len(start), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for m in np.unique(length[owner]).tolist():
            on = np.flatnonzero(length[owner] == m)
            rank = np.zeros(len(on), np.int64)
            for t in range(m):  # equal ranks: the first t + 1 words are equal
                _, at, rank = np.unique(rank * (len(self.vocabulary) + 1) + self.symbols[start[on] + t], return_index=True, return_inverse=True)
            which[on] = rank + sum(map(len, ends))
            ends.append(start[on][at] + m)
            lengths.append(np.full(len(at), m))
        self.ends, self.lengths = np.concatenate(ends), np.concatenate(lengths)
        pairs = np.unique(np.stack([which, owner], 1), axis=0)
        self.owner_cut = np.searchsorted(pairs[:, 0], np.arange(len(self.ends) + 1))
        self.owners = pairs[:, 1].astype(np.int32)

    def find(self, text: pa.Array, items: pa.Array, spans: pa.Array) -> list[pa.Array]:
        """For each text: words, hit words, ids of the items found, byte spans of the hits, what is left; adds to what earlier blocks found."""
        raw, off = T.utf8(text)
        data = T.LOWER[raw]
        start, end, first = T.words(data, off, T.ALNUM_WORD)
        n_words = np.diff(first)
        n_hit, items, spans, clean = np.zeros(len(text), np.int64), items.to_pylist(), spans.to_pylist(), [None] * len(text)
        hit, pairs = np.zeros(len(start), bool), np.zeros((0, 2), np.int64)
        for d in [d for d, s in enumerate(spans) if s]:
            a, b = np.reshape(spans[d], (-1, 2)).T + off[d]
            hit |= T.covered(len(start), np.searchsorted(start, a), np.searchsorted(start, b) - np.searchsorted(start, a))
        if len(self.ends) and len(start):
            at, phrase = self.occurrences(T.word_hashes(data, start, end), first)
            hit |= T.covered(len(start), at, self.lengths[phrase])
            doc = np.searchsorted(first, at, side="right") - 1
            pairs = np.unique(np.stack([doc, phrase], 1), axis=0)
        n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[first])
        if n_hit.any():
            for d in np.flatnonzero(n_hit).tolist():
                found = pairs[np.searchsorted(pairs[:, 0], d): np.searchsorted(pairs[:, 0], d + 1), 1]
                owners = np.unique(np.concatenate([self.owners[:0], *(self.owners[self.owner_cut[p]: self.owner_cut[p + 1]] for p in found)]))
                items[d] = items[d] + self.ids[owners].tolist()
                run = T.runs(hit[first[d]: first[d + 1]]) + first[d]
                spans[d] = (np.stack([start[run[:, 0]], end[run[:, 1] - 1]], 1) - off[d]).ravel().tolist()
                whole = raw[off[d]: off[d + 1]].tobytes()
                clean[d] = b"".join(whole[a:b] for a, b in zip([0, *spans[d][1::2]], [*spans[d][::2], len(whole)])).decode()
        return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.int32())), pa.array(clean, pa.string())]

    def occurrences(self, word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and phrase of each occurrence in a shard."""
        near = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
        known = self.vocabulary[near] == word
        edge = np.zeros(len(word) + 1, np.int8)  # runs of known words end with their document
        doc_start = np.zeros(len(word) + 1, bool)
        doc_start[first] = True
        edge[:-1] = known & ~(np.concatenate([[False], known[:-1]]) & ~doc_start[:-1])
        begin = np.flatnonzero(edge)
        last = known & (~np.concatenate([known[1:], [False]]) | doc_start[1:])
        length = np.flatnonzero(last) + 1 - begin
        begin, length = (x[length >= self.lengths.min()] for x in (begin, length))
        if not len(begin):
            return begin, begin
        put = np.cumsum(length + 1) - length - 1
        place = np.full(int((length + 1).sum()), -1)
        inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        place[np.repeat(put, length) + inside] = np.repeat(begin, length) + inside
        seq = np.where(place >= 0, near[place] + 1, 0)
        index = FMIndex(seq, len(self.vocabulary) + 1)
        low, high = index.search_in(self.symbols, self.ends, self.lengths)
        n = np.maximum(high - low, 0)
        rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return place[index.locate(rows)], np.repeat(np.arange(len(n)), n)


def _pieces(batches, window: int, most: int):
    """Items as hashed words, in pieces of at most ``most`` windows; consecutive pieces share window - 1 words."""
    for part in T.slices(batches, 1):
        raw, off = T.utf8(part.column(1))
        data = T.LOWER[raw]
        start, end, first = T.words(data, off, T.ALNUM_WORD)
        word, ids = T.word_hashes(data, start, end), part.column(0).to_pylist()
        cuts = [(ids[i], word[at: min(at + most + window - 1, b)].tobytes())
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist()))
                for at in range(a, max(b - window + 1, a + (b > a)), most)]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in cuts], pa.string()), pa.array([w for _, w in cuts], pa.binary())], names=["item", "words"])


def _packed(batches, most: int):
    """Numbers the pieces of a task so that no number holds more than ``most`` bytes, unless it holds one piece only."""
    block, filled = 0, 0
    for batch in batches:
        blocks = []
        for w in batch.column(1):
            n = len(w.as_buffer())
            if filled and filled + n > most:
                block, filled = block + 1, 0
            blocks.append(block)
            filled += n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.int64())], names=["item", "words", "block"])


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int):
    """Item ids and hashed pieces, one block under the broadcast limit at a time on the driver."""
    limit, parts = MAX_BENCHMARK_BYTES, int(benchmark.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text")).filter("text <> ''")
    pieces = stored(items.mapInArrow(lambda it: _pieces(it, window, PIECE), "item string, words binary").distinct())
    size = pieces.agg(F.sum(F.length("words"))).first()[0] or 0
    tasks = min(-(-size // (8 * limit)), parts)  # each packs several blocks, so few are left half empty
    dealt = pieces.repartition(tasks, F.xxhash64("item", "words")) if tasks > 1 else pieces.coalesce(1)
    packed = stored(dealt.mapInArrow(lambda it: _packed(it, limit), "item string, words binary, block long").select("item", "words", "block", F.spark_partition_id().alias("task")))
    for task, block in sorted(tuple(r) for r in packed.select("task", "block").distinct().collect()):
        rows = packed.filter((F.col("task") == task) & (F.col("block") == block)).select("item", "words").toArrow()
        yield rows.column(0).to_pylist(), [np.frombuffer(w, np.uint64) for w in rows.column(1).to_pylist()]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", window: int = 13) -> DataFrame:
    """Occurrences of benchmark phrases in documents.

    Words are runs of ASCII letters and digits and of non-ASCII characters,
    A-Z lower-cased.  A phrase is any ``window`` consecutive words of an item,
    or the whole item if it has fewer, but not none.

    Returns ``row`` (the columns in ``keep``), ``n_words``, ``n_hit`` (words
    inside any occurrence), ``items`` (ids of the items found, as strings,
    sorted, distinct), ``spans`` (byte offsets start, end, start, end ... in
    the text, one pair for each maximal run of hit words) and ``clean`` (the
    text without these spans; null if there are none).

    Null or empty texts have no words and no hits; null or empty items have
    no phrases (with no item at all, nothing is hit); an item with a null id
    is found, its hits count, but it has no entry in ``items``; rows that
    repeat are documents of their own, items that repeat are one id.
    """
    fields = "n_words long, n_hit long, items array<string>, spans array<int>, clean string"
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"),
                      F.array().cast("array<string>").alias("items"), F.array().cast("array<int>").alias("spans"))
    blocks = _blocks(benchmark, item_col, item_text, window)
    block = next(blocks, ([], []))
    while block is not None:
        phrases, held = lent(docs.sparkSession, Phrases(*block, window))
        block = next(blocks, None)
        carried = ["row", "text"] if block else ["row"]
        out = T.map_text(out, "text", carried, fields, lambda *c, b=phrases: b().find(*c), also=("items", "spans"))
        out = out.select("row.*", *[f.split()[0] for f in fields.split(", ")])
        if block:
            out = stored(out)
            held.unpersist()
    return out.withColumn("items", F.array_sort(F.array_distinct(F.array_compact("items"))))


def contaminated() -> Column:
    """At least one word hit and at least a twentieth of the words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
