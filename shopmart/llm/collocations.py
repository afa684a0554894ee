"""Phrase collocation mining with counting quotient filters.

Documents become streams of word ids: a task lists the distinct words of a
slice of documents once, with counts; words that occur often enough get ids
by a join, and the streams are rewritten to them (other words and ends of
pieces are 0, which no phrase crosses).

Phrases of 2, 3, ... words are counted one length after the other.  The packed
ids of a phrase are permuted invertibly and split into a quotient, which is
the place in the filter, and a remainder, which is stored in full: the filter
is a lossless sorted map from phrases to counts, at a few bytes each.  A task
merges the filters of its streams, cuts the result by quotient into segments,
and the segments of all tasks with the same quotients are merged again.  The
permutation spreads phrases evenly, and a very common phrase is one counter in
each filter, so segments are of like size whatever the counts.

A phrase can only be frequent if its first and last words but one are: a
Bloom filter of the frequent phrases of the length before, of bounded size,
spares most others.  It has no false negatives, so nothing is lost.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopmart.llm import _text as T
from shopmart.llm._store import shipped, stored

#: Phrases that a task counts before it compresses them, and that its filter holds before it is sent on.
CHUNK, FILTER = 1 << 21, 1 << 22
#: Bytes of a segment's entries over all tasks; bits of the Bloom filter for each phrase, and at most (64 MB).
SEGMENT_BYTES, BLOOM_BITS, BLOOM_MOST = 8 << 20, 12, 1 << 29
_BLOOM_CHUNK = 1 << 16  # bits of a part of the Bloom filter, the whole of which one phrase uses

# What ends a piece, and lower case of A-Z; blanks are x20 and x09.
_BYTES = bytearray(T.LOWER.tobytes())
for _c in b".,;:!?\n\x0b\x0c\r":
    _BYTES[_c] = 0x2E
_BYTES[0x09] = 0x20
_BYTES = bytes(_BYTES)
_END = b"."


def _tokens(data: bytes):
    """Words of a text, and ``.`` between pieces, a stretch at a time."""
    at = 0
    while at < len(data):
        to = at + T.SLICE_BYTES
        if to < len(data):  # end at a blank or the end of a piece
            while to < len(data) and data[to] != 0x20 and data[to] != 0x2E:
                to += 1
        # only x20 is left of the blanks that split() knows
        yield data[at:to].replace(_END, b" . ").split(b" ")
        at = to


def _streams(batches):
    """For each slice and language: the stream of local word numbers (from 1; 0 ends a piece), the words and their counts."""
    for part in T.slices(batches, 1):
        langs, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
        by: dict[str, list[bytes]] = {}
        for lang, text in zip(langs, texts):
            if text:
                by.setdefault(lang, []).append(text.encode().translate(_BYTES))
        rows = []
        for lang, docs in by.items():
            number = defaultdict(count().__next__)
            number[_END], number[b""]  # 0 and 1
            made = [np.fromiter(map(number.__getitem__, tokens), np.uint32) for tokens in _tokens(_END.join(docs))]
            ids = np.concatenate(made)
            ids = ids[ids != 1]
            ids[ids > 1] -= 1
            counts = np.bincount(ids, minlength=len(number) - 1)[1:]
            if len(counts):
                rows.append((lang, ids.tobytes(), [w.decode() for w in number][2:], counts))
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.list_(pa.string())),
                                          pa.array([c.tolist() for c in columns[3]], pa.list_(pa.int64()))], names=["lang", "stream", "words", "counts"])


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows numbered from 1 without a gap (``id``): by part, then within the part."""
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row for each task
    offset = rows.groupBy(part.alias("part")).count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("part", part).join(offset, "part").select(*[c for c in rows.columns if c != "at"], (within + F.col("offset") + 1).alias("id"))


def _rewritten(batches):
    """Streams of ids from streams of local numbers and the ids of their words (0 where rare)."""
    for batch in batches:
        out = []
        for stream, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            local = np.frombuffer(stream, np.uint32)
            table = np.zeros(int(local.max(initial=0)) + 1, np.uint32)
            if known:
                table[[k["at"] for k in known]] = [k["id"] for k in known]
            ids = table[local]
            # of a run of breaks one is enough
            ids = ids[(ids > 0) | np.append(True, ids[:-1] > 0)]
            out.append(ids.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["stream"])


# ---- packed phrases -------------------------------------------------------------
# A key is a list of lanes (uint64 arrays), highest first; ``sizes`` are their bits.

def lanes(bits: int) -> list[int]:
    """Bits of each lane of keys of ``bits`` bits: as few lanes as do, of like size."""
    n = -(-bits // 64)
    return [bits // n + (i < bits % n) for i in range(n)]


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def packed(words: list[np.ndarray], width: int) -> list[np.ndarray]:
    """Keys of phrases given as one array of ids for each word, ``width`` bits a word."""
    sizes = lanes(width * len(words))
    key = [np.zeros(len(words[0]), np.uint64) for _ in sizes]
    for w in words:
        for i in range(len(key)):
            from_next = key[i + 1] >> np.uint64(sizes[i + 1] - width) if i + 1 < len(key) else w.astype(np.uint64)
            key[i] = ((key[i] << np.uint64(width)) | from_next) & _mask(sizes[i])
    return key


def unpacked(key: list[np.ndarray], width: int, n: int) -> list[np.ndarray]:
    sizes, key, out = lanes(width * n), list(key), []
    for _ in range(n):
        out.append(key[-1] & _mask(width))
        for i in range(len(key) - 1, -1, -1):
            key[i] = key[i] >> np.uint64(width)
            if i:
                key[i] |= (key[i - 1] & _mask(width)) << np.uint64(sizes[i] - width)
    return out[::-1]


_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def permuted(key: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """An invertible permutation of the keys of ``bits`` bits that spreads them evenly over the high bits."""
    sizes, key = lanes(bits), list(key)
    for turn in range(2):
        for i in range(len(key)):  # every lane by the mix of the next
            if len(key) > 1:
                key[i] = (key[i] + T.mix(key[(i + 1) % len(key)] + np.uint64(turn))) & _mask(sizes[i])
        for i, s in enumerate(sizes):
            key[i] = (key[i] * np.uint64(_ODD[turn])) & _mask(s)
            key[i] = key[i] ^ (key[i] >> np.uint64((s + 1) // 2))
    return key


def restored(key: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """The inverse of ``permuted``."""
    sizes, key = lanes(bits), list(key)
    for turn in (1, 0):
        for i, s in enumerate(sizes):
            key[i] = key[i] ^ (key[i] >> np.uint64((s + 1) // 2))
            key[i] = (key[i] * np.uint64(pow(_ODD[turn], -1, 1 << 64))) & _mask(s)
        for i in range(len(key) - 1, -1, -1):
            if len(key) > 1:
                key[i] = (key[i] - T.mix(key[(i + 1) % len(key)] + np.uint64(turn))) & _mask(sizes[i])
    return key


class Filter:
    """A counting quotient filter: permuted keys in order, each with its count."""

    def __init__(self, key: list[np.ndarray], counts: np.ndarray):
        self.key, self.counts = key, counts

    @classmethod
    def of(cls, key: list[np.ndarray], counts: np.ndarray | None = None) -> Filter:
        """Sort keys and add up the counts of equal ones."""
        if counts is None and len(key) == 1:
            only, counts = np.unique(key[0], return_counts=True)
            return cls([only], counts)
        counts = np.ones(len(key[0]), np.int64) if counts is None else counts
        # stable sorting merges sorted runs as such
        order = np.argsort(key[0], kind="stable") if len(key) == 1 else np.lexsort(key[::-1])
        key = [k[order] for k in key]
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in key], axis=0) if len(order) else new[1:]
        first = np.flatnonzero(new)
        return cls([k[first] for k in key], np.add.reduceat(counts[order], first) if len(first) else counts[:0])

    def __len__(self) -> int:
        return len(self.counts)

    @classmethod
    def merged(cls, filters: list[Filter]) -> Filter:
        return cls.of([np.concatenate(k) for k in zip(*(f.key for f in filters))], np.concatenate([f.counts for f in filters]))

    def segments(self, bits: int, quotient: int, cut: int):
        """(number, bytes) of the segment of each value of the ``cut`` highest bits that holds keys."""
        top = self.key[0] >> np.uint64(lanes(bits)[0] - cut) if cut else np.zeros(len(self), np.uint64)
        first = np.flatnonzero(np.append(True, top[1:] != top[:-1])) if len(top) else []
        for a, b in zip(first, [*first[1:], len(top)]):
            yield int(top[a]), Filter([k[a:b] for k in self.key], self.counts[a:b])._encoded(bits, quotient, cut)

    def _encoded(self, bits: int, quotient: int, cut: int) -> bytes:
        """A bit for each quotient of the segment (occupied), a bit for each entry (end of a run), remainders, counters.

        A remainder has only the bytes it needs; a counter is one byte, or 255 and eight more at the end.
        """
        high = lanes(bits)[0]
        rest = high - quotient
        q = ((self.key[0] >> np.uint64(rest)) & _mask(quotient - cut)).astype(np.int64)
        occupied = np.zeros(1 << (quotient - cut), np.uint8)
        occupied[q] = 1
        ends = np.append(q[1:] != q[:-1], True).astype(np.uint8)
        remainders = [(self.key[0] & _mask(rest)) if rest else None, *self.key[1:]]
        out = [np.array([len(q)], np.int64).tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes()]
        for r, b in zip(remainders, [rest, *lanes(bits)[1:]]):
            if r is not None:
                out.append(np.ascontiguousarray(r.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-b // 8)]).tobytes())
        out.append(np.minimum(self.counts, 255).astype(np.uint8).tobytes())
        out.append(self.counts[self.counts >= 255].astype(np.int64).tobytes())
        return b"".join(out)

    @classmethod
    def decoded(cls, data: bytes, number: int, bits: int, quotient: int, cut: int) -> Filter:
        sizes = lanes(bits)
        rest, at = sizes[0] - quotient, 8
        n = int(np.frombuffer(data, np.int64, 1)[0])

        def take(size: int) -> np.ndarray:
            nonlocal at
            at += size
            return np.frombuffer(data, np.uint8, size, at - size)

        occupied = np.unpackbits(take(-(-(1 << (quotient - cut)) // 8)))[: 1 << (quotient - cut)]
        ends = np.unpackbits(take(-(-n // 8)))[:n]
        run = np.cumsum(ends) - ends
        q = np.flatnonzero(occupied)[run].astype(np.uint64) | np.uint64(number << (quotient - cut))
        key = [q << np.uint64(rest)]
        for i, b in enumerate([rest, *sizes[1:]]):
            if b:
                wide = np.zeros((n, 8), np.uint8)
                wide[:, : -(-b // 8)] = take(n * -(-b // 8)).reshape(n, -1)
                r = wide.reshape(-1).view("<u8").astype(np.uint64)
                if i:
                    key.append(r)
                else:
                    key[0] = key[0] | r
        counts = take(n).astype(np.int64)
        counts[counts == 255] = np.frombuffer(data, np.int64, -1, at)
        return cls(key, counts)


class Bloom:
    """Which phrases may be frequent: bits in parts of which each phrase uses one."""

    def __init__(self, parts: int):
        self.parts, self.bits = parts, np.zeros((parts, _BLOOM_CHUNK // 8), np.uint8)

    @staticmethod
    def places(key: list[np.ndarray], parts: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Part, and the bits in it, of each permuted key."""
        h = T.mix(key[0] + np.uint64(0x51ED270B) if len(key) == 1 else key[0] ^ T.mix(key[1] + (T.mix(key[2]) if len(key) > 2 else np.uint64(1))))
        bits = [(h >> np.uint64(16 * i)) & np.uint64(_BLOOM_CHUNK - 1) for i in range(3)]
        return (T.mix(h) >> np.uint64(20)) % np.uint64(parts), bits

    def has(self, key: list[np.ndarray]) -> np.ndarray:
        part, bits = self.places(key, self.parts)
        flat, base = self.bits.reshape(-1), part * np.uint64(_BLOOM_CHUNK // 8)
        found = np.ones(len(part), bool)
        for b in bits:
            found &= (flat[base + (b >> np.uint64(3))] >> (b & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return found


def _starts(ids: np.ndarray, n: int, width: int, bloom: Bloom | None) -> np.ndarray:
    """Places in the stream where phrases of ``n`` words begin that may be frequent."""
    whole = ids != 0
    ok = whole[: len(ids) - n + 1].copy()
    for i in range(1, n):
        ok &= whole[i: len(ids) - n + 1 + i]
    at = np.flatnonzero(ok)
    if bloom is None or not len(at):
        return at
    # the phrases one word shorter: each is the last words of one and the first of the next
    shorter = np.union1d(at, at + 1)
    key = permuted(packed([ids[shorter + i] for i in range(n - 1)], width), width * (n - 1))
    good = np.zeros(len(ids) + 1, bool)
    good[shorter[bloom.has(key)]] = True
    return at[good[at] & good[at + 1]]


def _counted(batches, n: int, width: int, quotient: int, cut: int, bloom: Bloom | None):
    """Segments of the filter of a task's phrases of ``n`` words."""
    bits = width * n
    have: list[Filter] = []

    def sent(filters):
        pairs = list(Filter.merged(filters).segments(bits, quotient, cut)) if filters else []
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.binary())], names=["number", "segment"])

    for batch in batches:
        for stream in batch.column(0).to_pylist():
            ids = np.frombuffer(stream, np.uint32)
            for a in range(0, max(len(ids) - n + 1, 0), CHUNK):
                part = ids[a: a + CHUNK + n - 1]
                at = _starts(part, n, width, bloom)
                if len(at):
                    have.append(Filter.of(permuted(packed([part[at + i] for i in range(n)], width), bits)))
                if sum(len(f) for f in have) > CHUNK and len(have) > 1:
                    have = [Filter.merged(have)]
                    if len(have[0]) > FILTER:
                        yield sent(have)
                        have = []
    if have:
        yield sent(have)


def _frequent(task: pa.Table, least: int, n: int, width: int, quotient: int, cut: int) -> pa.Table:
    """Merge the segments of one number; the phrases that are frequent enough."""
    bits = width * n
    number = task.column("number")[0].as_py()
    waiting: list[Filter] = []
    whole = None
    for data in task.column("segment").to_pylist():
        waiting.append(Filter.decoded(data, number, bits, quotient, cut))
        if whole is None or sum(len(f) for f in waiting) > len(whole):
            whole, waiting = Filter.merged([*waiting, *([whole] if whole else [])]), []
    whole = Filter.merged([whole, *waiting])
    on = whole.counts >= least
    words = unpacked(restored([k[on] for k in whole.key], bits), width, n)
    flat = np.stack(words, 1).astype(np.int64).reshape(-1)
    return pa.table({"ids": pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, n, dtype=np.int32)), pa.array(flat)), "a": pa.array(whole.counts[on])})


def _bloom(frequent: DataFrame, n: int, width: int) -> Bloom:
    """The Bloom filter of the frequent phrases of ``n`` words; its parts are built apart."""
    found = frequent.count()
    bloom = Bloom(int(np.clip(found * BLOOM_BITS // _BLOOM_CHUNK, 1, BLOOM_MOST // _BLOOM_CHUNK)))
    parts = bloom.parts

    def dealt(batches):
        for batch in batches:
            words = batch.column(0).flatten().to_numpy().reshape(-1, n)
            part, bits = Bloom.places(permuted(packed(list(words.T), width), width * n), parts)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(pa.array(b.astype(np.int32)) for b in bits)], names=["part", "b0", "b1", "b2"])

    def built(task: pa.Table) -> pa.Table:
        bits = np.zeros(_BLOOM_CHUNK, np.uint8)
        for i in range(3):
            bits[task.column(f"b{i}").to_numpy()] = 1
        return pa.table({"part": task.column("part")[:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    rows = frequent.select("ids").mapInArrow(dealt, "part int, b0 int, b1 int, b2 int").groupBy("part").applyInArrow(built, "part int, bits binary")
    for r in rows.toLocalIterator():  # BLOOM_MOST bits in all at most
        bloom.bits[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return bloom


def _level(streams: DataFrame, n: int, width: int, length: int, parts: int, least: int, bloom: Bloom | None) -> DataFrame:
    """The frequent phrases of ``n`` words of streams of ``length`` words."""
    bits = width * n
    high = lanes(bits)[0]
    # segments of bounded size, at least one for each task; a quotient for about every entry of a task's filter
    segments = max(length * (2 + bits / 8) / SEGMENT_BYTES, parts, 1)
    cut = min(int(np.ceil(np.log2(segments))), high)
    quotient = min(max(int(np.log2(max(min(length / parts, FILTER), 2))), cut), high)
    get = shipped(streams.sparkSession, bloom) if bloom else lambda: None
    made = streams.mapInArrow(lambda it: _counted(it, n, width, quotient, cut, get()), "number int, segment binary")
    return made.groupBy("number").applyInArrow(lambda t: _frequent(t, least, n, width, quotient, cut), "ids array<long>, a long")


def phrases(docs: DataFrame, least: int = 100, longest: int = 5, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that occur ``least`` times or more in a language.

    Returns three tables: ``words`` (lang, word, a, id; ids from 1 over all
    languages), ``found`` (ids, a: phrases of two words or more) and
    ``totals`` (lang, n: all word occurrences).
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und"))
    src = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    slices = src.mapInArrow(_streams, "lang string, stream binary, words array<string>, counts array<long>")
    slices = stored(slices.withColumn("slice", F.monotonically_increasing_id()))
    listed = slices.select("slice", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select("slice", "lang", (F.col("at") + 1).alias("at"), F.col("w.words").alias("word"), F.col("w.counts").alias("count"))
    words = stored(listed.groupBy("lang", "word").agg(F.sum("count").alias("a")))
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    often = stored(_numbered(words.filter(F.col("a") >= least)))
    width = max(int(often.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]).bit_length(), 1)
    if width > 32:
        raise ValueError("more than 2**32 frequent words")
    known = listed.select("slice", "lang", "at", "word").join(often, ["lang", "word"]).groupBy("slice").agg(F.collect_list(F.struct("at", "id")).alias("known"))
    streams = stored(slices.select("slice", "stream").join(known, "slice").select("stream", "known").mapInArrow(_rewritten, "stream binary"))
    length = int(streams.agg(F.coalesce(F.sum(F.octet_length("stream")), F.lit(0))).first()[0]) // 4
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found, bloom = [], None
    for n in range(2, longest + 1):
        rows = stored(_level(streams, n, width, length, parts, least, bloom))
        found.append(rows)
        if n < longest:
            bloom = _bloom(rows, n, width)
            if not bloom.bits.any():
                break
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return often, every, totals


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:
    """floor(1000 a n / (l r)) in exact decimals of 38 digits."""
    a, n, l, r = (c.cast("decimal(38,0)") for c in (a, n, l, r))
    return F.call_function("div", a * 1000 * n, l * r)


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language by their cohesion.

    A-Z are lower-cased, texts split at ``[.,;:!?\\x0A-\\x0D]`` into pieces
    and those at blanks and tabs into words.  A phrase of at least ``least``
    occurrences (a) is cut in two in every way, l and r being the occurrences
    of its parts and n all words of the language: the cut of least
    floor(1000 a n / (l r)) counts (ties: the shorter first part).  Phrases
    that always occur inside one longer phrase are dropped.

    Returns lang, rank (from 1, by score, a, both falling, and phrase in byte
    order), phrase, a, l, r, n, score.

    Null texts are empty, a null language is ``und``; rows that repeat count
    again; phrases do not cross documents.  An empty table has no rows.
    """
    words, found, totals = phrases(docs, least, longest, text_col, lang_col)
    every = stored(found.unionByName(words.select(F.array("id").alias("ids"), "a")))
    long = every.filter(F.size("ids") > 1)
    # every way to cut
    k = F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")
    cuts = long.select("ids", "a", k)
    cuts = cuts.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("left"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("right"))
    part = every.select(F.col("ids").alias("part"), F.col("a").alias("times"))
    cuts = cuts.join(part.toDF("left", "l"), "left").join(part.toDF("right", "r"), "right")
    # a word's id tells its language
    first = words.select(F.col("id").alias("first"), "lang").join(totals, "lang")
    cuts = cuts.withColumn("first", F.element_at("ids", 1)).join(first, "first").select("ids", "lang", "n", "a", "k", "l", "r")
    best = cuts.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = best.groupBy("ids").agg(F.min(F.struct("score", "k", "l", "r", "a", "n", "lang")).alias("b")).select("ids", "b.*")
    # inside a longer phrase: it is enough to look at those one word longer
    inner = F.explode(F.array(F.expr("slice(ids, 1, size(ids) - 1)"), F.expr("slice(ids, 2, size(ids) - 1)"))).alias("ids")
    within = long.filter(F.size("ids") > 2).select(inner, "a").groupBy("ids").agg(F.max("a").alias("longer"))
    left = stored(best.join(within, "ids", "left").filter("longer IS NULL OR longer < a").drop("longer"))
    # the words, which ties are ordered by
    spelt = left.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelt = spelt.groupBy("ids").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    ranked = left.join(spelt, "ids").withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")))
    return ranked.filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
