"""Numpy helpers over Arrow text columns, used inside tasks.

A *slice* is a run of whole documents of about ``SLICE_BYTES`` of text (a
longer document is a slice of its own), which bounds the memory of a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

SLICE_BYTES = 2 << 20
LONG_WORD = 256
_BASE = 0x9E3779B97F4A7C15
_OTHER_BASE = 0xD1342543DE82EF95
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Cache(dict):
    """Values that each process computes for itself: empty when a task is shipped."""

    def __reduce__(self):
        return Cache, ()


_POWERS = Cache()

#: ASCII whitespace is x20 and x09-x0D; every other byte belongs to a word.
RAW_WORD = np.ones(256, bool)
RAW_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: ASCII letters and digits and every byte of a non-ASCII character.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True
#: Lower-cases A-Z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def slices(batches, text: int, limit: int = SLICE_BYTES):
    """Cut record batches into slices; ``text`` is the index of the text column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a text column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def stretches(data: np.ndarray, limit: int):
    """Cut the bytes of one text at ASCII whitespace into pieces of about ``limit`` bytes (a longer word stays whole)."""
    at = 0
    while at < len(data):
        to = at + limit
        while to < len(data):
            space = np.flatnonzero(~RAW_WORD[data[to: to + limit]])
            if len(space):
                to += int(space[0])
                break
            to += limit
        yield data[at: to]
        at = to


def words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
    """Start and end byte of each word, and the first word of each document (one more entry at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = is_word[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(start, off)


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value (splitmix)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _rolling(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp value modulo 2**64 of values[start:end], from prefix sums.

    The starts increase; sums are taken over stretches of bounded length, so a
    very long text needs no longer arrays than a slice.
    """
    out = np.empty(len(start), np.uint64)
    inverse = pow(base, -1, 1 << 64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + SLICE_BYTES)))
        a, b = int(start[i]), int(end[j - 1])
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(values[a:b] * _powers(base, b - a), out=sums[1:])
        out[i:j] = (sums[end[i:j] - a] - sums[start[i:j] - a]) * _powers(inverse, b - a + 1)[start[i:j] - a]
        i = j
    return out


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word.  Sums modulo 2**64 cannot tell certain long words apart, so long ones take XXH64."""
    out = mix(_rolling(_Looked(data), start, np.minimum(end, start + LONG_WORD), _BASE))
    for i in np.flatnonzero(end - start >= LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i]: end[i]].tobytes(), 7)
    return out


def window_hashes(word_hash: np.ndarray, start: np.ndarray, n: int, other: bool = False) -> np.ndarray:
    """Hash of the n words from each start; ``other`` gives a second, independent one."""
    return mix(_rolling(word_hash, start, start + n, _OTHER_BASE if other else _BASE))


class _Looked:
    """Bytes as random 64-bit values, looked up a stretch at a time."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def __getitem__(self, stretch: slice) -> np.ndarray:
        return _TABLE[self.data[stretch]]


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Words at which n words of the same document begin."""
    at = np.arange(first[-1])
    return at[np.repeat(first[1:], np.diff(first)) - at >= n]


def covered(n_words: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Words inside any of the given windows."""
    edge = np.bincount(starts, minlength=n_words + 1)[: n_words + 1].astype(np.int64)
    edge -= np.bincount(starts + lengths, minlength=n_words + 1)[: n_words + 1]
    return np.cumsum(edge)[:n_words] > 0


def runs(flags: np.ndarray) -> np.ndarray:
    """Maximal runs of true flags as (start, end) rows."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], 1)


def map_text(docs: DataFrame, text_col: str, keep: list[str], fields: str, fn, also: tuple[str, ...] = ()) -> DataFrame:
    """Apply ``fn(text column, also columns ...) -> arrays`` slice by slice.

    Returns ``row`` (a struct of the columns in ``keep``, so that no name can
    clash) and the columns of ``fields`` (DDL).
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    more = [F.col(f"`{c}`").alias(f"also{i}") for i, c in enumerate(also)]
    at = keep.index(text_col) if text_col in keep and docs.schema[text_col].dataType == StringType() else None
    text = [] if at is not None else [F.col(f"`{text_col}`").cast("string").alias("text")]  # sent once
    src = docs.select(row, *text, *more)
    schema = StructType([src.schema["row"], *StructType.fromDDL(fields).fields])
    names = schema.names

    def run(batches):
        for batch in batches:
            if at is not None:
                inner = pc.struct_field(batch.column(0), [at])
                batch = pa.RecordBatch.from_arrays([batch.column(0), inner, *batch.columns[1:]], names=["row", "text", *batch.schema.names[1:]])
            for part in slices([batch], 1):
                yield pa.RecordBatch.from_arrays([part.column(0), *fn(*part.columns[1:])], names=names)

    return src.mapInArrow(run, schema)
