"""Substring dedup: remove every word inside a window of words that occurs more than once.

Rabin-Karp hashes of every window of ``window`` words are counted over all
documents: a task packs the hashes of a slice of documents by bucket (one
binary row per slice and bucket, 9 bytes a window), the buckets are dealt to
the reducers, each of which sorts its bucket and sends back the positions of
the windows seen twice.  The repeated windows of a document merge into
maximal removal intervals.

A window that already repeats within its slice is sent once, without
positions, so a window that fills a third of the corpus reaches its bucket
once per slice only.  The bucket is taken from a second, independent hash:
two windows are held equal when the 64-bit hash and the bucket agree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shopmart.llm import _text as T
from shopmart.llm._store import stored

#: Text bytes whose window hashes make one bucket (about 1.3 times as many bytes of hashes), at least.
BUCKET_BYTES = 16 << 20
#: Text bytes for each row of hashes (one slice in one bucket), at least: some thirty windows.
ROW_BYTES = 200
_PACKED = "bucket int, slice binary, hashes binary, gaps binary, known binary, docs binary, firsts binary, flagged binary"


def _pack_ints(x: np.ndarray) -> bytes:
    """Increasing positions as gaps, byte planes apart (the high planes are zeros and compress away)."""
    return np.diff(x, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack_ints(b: bytes) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


def sizes(size: int) -> tuple[int, int]:
    """Text bytes of a bucket and of a slice for a corpus of ``size`` bytes.

    There is a row for every slice and bucket, so with fixed sizes the rows
    would grow as the square of the corpus.  Beyond some 160 GB both sizes grow
    as its square root (16 and 2 MB; about 390 and 49 MB for 100 TB), which
    keeps ``ROW_BYTES`` of text a row.
    """
    grown = max(1.0, (ROW_BYTES * size / (BUCKET_BYTES * T.SLICE_BYTES)) ** 0.5)
    return int(BUCKET_BYTES * grown), int(T.SLICE_BYTES * grown)


def _hashed(batches, window: int, buckets: int, limit: int):
    schema = pa.schema([("bucket", pa.int32())] + [(n, pa.binary()) for n in ("slice", "hashes", "gaps", "known", "docs", "firsts", "flagged")])
    for part in T.slices(batches, 2, limit):
        data, off = T.utf8(part.column(2))
        start, end, first = T.words(data, off, T.RAW_WORD)
        at = T.window_starts(first, window)
        if not len(at):
            continue
        word = T.word_hashes(data, start, end)
        h = T.window_hashes(word, at, window)
        bucket = (T.window_hashes(word, at, window, other=True) % np.uint64(buckets)).astype(np.int32)
        keys = np.stack([part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False)], 1).astype(np.int64)
        name = hashlib.blake2b(keys.tobytes(), digest_size=16).digest()
        s = np.sort(h)
        again = np.unique(s[1:][s[1:] == s[:-1]])
        local = np.zeros(len(h), bool)
        if len(again):
            near = np.minimum(np.searchsorted(again, h), len(again) - 1)
            local = again[near] == h
        rows: dict[str, list] = {n: [] for n in schema.names}

        def add(**row):
            for n in schema.names:
                rows[n].append(row.get(n))

        add(bucket=int(bucket[0]), slice=name, docs=keys.tobytes(), firsts=first.tobytes(), flagged=_pack_ints(at[local]))
        once = np.flatnonzero(~local)
        once = once[np.argsort(bucket[once], kind="stable")]
        known, where = np.unique(h[local], return_index=True)
        known_bucket = bucket[local][where]
        known = known[(by := np.argsort(known_bucket, kind="stable"))]
        cut, known_cut = (np.searchsorted(b, np.arange(buckets + 1)) for b in (bucket[once], known_bucket[by]))
        for b in np.flatnonzero((np.diff(cut) > 0) | (np.diff(known_cut) > 0)).tolist():
            mine = once[cut[b]: cut[b + 1]]
            add(bucket=b, slice=name, hashes=h[mine].tobytes(), gaps=_pack_ints(at[mine]), known=known[known_cut[b]: known_cut[b + 1]].tobytes())
        yield pa.RecordBatch.from_pydict(rows, schema=schema)


def _repeated(batches):
    """One bucket: positions, by slice, of the windows that occur again in the bucket."""
    schema = pa.schema([(n, pa.binary()) for n in ("slice", "docs", "firsts", "flagged")])
    names, hashes, gaps, known = [], [], [], []
    for batch in batches:
        c = batch.to_pydict()
        meta = [i for i, d in enumerate(c["docs"]) if d is not None]
        if meta:
            yield pa.RecordBatch.from_pydict({n: [c[n][i] for i in meta] for n in schema.names}, schema=schema)
        for i, h in enumerate(c["hashes"]):
            if h is not None:
                names.append(c["slice"][i])
                hashes.append(np.frombuffer(h, np.uint64))
                gaps.append(c["gaps"][i])
                known.append(np.frombuffer(c["known"][i], np.uint64))
    if not hashes:
        return
    cut = np.cumsum([0] + [len(h) for h in hashes])
    sent = np.unique(np.concatenate(known))
    every = np.concatenate([*hashes, sent])
    order = np.argsort(every, kind="stable")
    s = every[order]
    same = s[1:] == s[:-1]
    flags = np.zeros(len(every), bool)
    flags[order[1:]] = same
    flags[order[:-1]] |= same
    rows: dict[str, list] = {n: [] for n in schema.names}
    for i, name in enumerate(names):
        mine = flags[cut[i]: cut[i + 1]]
        if mine.any():
            rows["slice"].append(name)
            rows["flagged"].append(_pack_ints(_unpack_ints(gaps[i])[mine]))
            rows["docs"].append(None)
            rows["firsts"].append(None)
    yield pa.RecordBatch.from_pydict(rows, schema=schema)


def _intervals(group: pa.Table, window: int) -> pa.Table:
    """The removal intervals of the documents of one slice."""
    c = group.to_pydict()
    meta = next(i for i, d in enumerate(c["docs"]) if d is not None)
    keys = np.frombuffer(c["docs"][meta], np.int64).reshape(-1, 2)
    first = np.frombuffer(c["firsts"][meta], np.int64)
    flagged = np.unique(np.concatenate([_unpack_ints(f) for f in c["flagged"]]))
    gone = T.covered(int(first[-1]), flagged, window)
    hit = [d for d in range(len(keys)) if gone[first[d]: first[d + 1]].any()]
    spans = [T.runs(gone[first[d]: first[d + 1]]).ravel().tolist() for d in hit]
    return pa.table({"k1": pa.array(keys[hit, 0], pa.int64()), "k2": pa.array(keys[hit, 1], pa.int64()), "spans": pa.array(spans, pa.list_(pa.int32()))})


def _cut(batches, id_field: pa.Field):
    schema = pa.schema([id_field, ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("removed", pa.list_(pa.int32()))])
    for part in T.slices(batches, 1):
        n_words, n_removed, kept, removed = [], [], [], []
        for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
            w = (text or "").encode().split()  # bytes split at ASCII whitespace only
            n_words.append(len(w))
            spans = spans or []
            for a, b in zip(spans[-2::-2], spans[-1::-2]):
                del w[a:b]
            n_removed.append(n_words[-1] - len(w))
            kept.append(b" ".join(w).decode())
            removed.append(spans)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, schema.field("removed").type)], schema=schema)


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Remove the words covered by a window of ``window`` words that occurs more than once.

    Returns ``id_col``, ``n_words``, ``n_removed``, ``kept`` (the words left,
    joined by one space) and ``removed`` (start, end, start, end ... of the
    maximal removed word intervals).  One row per input row; other columns
    are ignored.  Windows are judged on the input, all copies go.

    A null or empty text has no words and keeps its row; a text of fewer
    words than the window loses nothing; rows that repeat, also with the same
    or a null id, are documents of their own and remove each other's windows.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                      F.xxhash64(F.col(text_col)).alias("k1"), F.xxhash64(F.lit(1), F.col(text_col)).alias("k2"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bucket_bytes, slice_bytes = sizes(size)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    hashed = src.select("k1", "k2", "text").mapInArrow(lambda it: _hashed(it, window, buckets, slice_bytes), _PACKED)
    dealt = hashed.repartitionById(buckets, F.col("bucket"))
    found = dealt.mapInArrow(_repeated, "slice binary, docs binary, firsts binary, flagged binary")
    spans = found.groupBy("slice").applyInArrow(lambda t: _intervals(t, window), "k1 long, k2 long, spans array<int>")
    # stored, so that the join below has an exchange of its own, which adaptive execution may split at a hot text
    spans = stored(spans.groupBy("k1", "k2").agg(F.first("spans").alias("spans")))
    id_type = src.schema["id"].dataType
    field = pa.field("id", to_arrow_type(id_type))
    out = (src.join(spans, ["k1", "k2"], "left").select("id", "text", "spans")
           .mapInArrow(lambda it: _cut(it, field), f"id {id_type.simpleString()}, n_words long, n_removed long, kept string, removed array<int>"))
    return out.withColumnRenamed("id", id_col)
