"""Sharding: best-fit-decreasing bin packing of indivisible groups (equal texts).

Groups enter in order of falling size the shard with the least room that still
holds them, found in a balanced tree of remaining capacities.  The packing has
two levels, so that no task and not the driver sees all groups: a group of more
than 1 / ``UNITS`` of all bytes or rows (at most 2 * ``UNITS`` such) is packed
by itself; the others are dealt to tasks, which pack theirs into parcels of at
most 1 / ``UNITS`` of all bytes.  Best fit leaves at most one parcel a task
half empty, which bounds the parcels by 2 * ``UNITS`` and one a task.  The
driver then packs large groups and parcels into shards.

With a given capacity that yields as few shards as best fit needs; with a
given number of shards, the capacity is the least (by bisection) at which best
fit needs no more, so that shards come out near equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopmart.llm._store import stored

#: Parts of the whole that a parcel holds at most one of.
UNITS = 1 << 14

_Key = tuple[int, int]


class Tree:
    """Balanced (AVL) tree of pairs (room, bin), as nested tuples (pair, left, right, height)."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _node(pair, left, right):
        return pair, left, right, 1 + max(left[3] if left else 0, right[3] if right else 0)

    @classmethod
    def _balanced(cls, pair, left, right):
        lean = (left[3] if left else 0) - (right[3] if right else 0)
        if lean > 1:
            p, a, b, _ = left
            if (a[3] if a else 0) >= (b[3] if b else 0):
                return cls._node(p, a, cls._node(pair, b, right))
            return cls._node(b[0], cls._node(p, a, b[1]), cls._node(pair, b[2], right))
        if lean < -1:
            p, a, b, _ = right
            if (b[3] if b else 0) >= (a[3] if a else 0):
                return cls._node(p, cls._node(pair, left, a), b)
            return cls._node(a[0], cls._node(pair, left, a[1]), cls._node(p, a[2], b))
        return cls._node(pair, left, right)

    def add(self, pair: _Key) -> None:
        def into(node):
            if node is None:
                return pair, None, None, 1
            p, a, b, _ = node
            return self._balanced(p, into(a), b) if pair < p else self._balanced(p, a, into(b))

        self.root = into(self.root)

    def remove(self, pair: _Key) -> None:
        def least(node):
            while node[1]:
                node = node[1]
            return node[0]

        def out(node, pair):
            p, a, b, _ = node
            if pair < p:
                return self._balanced(p, out(a, pair), b)
            if pair > p:
                return self._balanced(p, a, out(b, pair))
            if a is None or b is None:
                return a or b
            after = least(b)
            return self._balanced(after, a, out(b, after))

        self.root = out(self.root, pair)

    def tightest(self, size: int) -> _Key | None:
        """The pair of least room (ties: lowest bin) that holds ``size``."""
        node, found = self.root, None
        while node:
            if node[0][0] >= size:
                found, node = node[0], node[1]
            else:
                node = node[2]
        return found


class Bins:
    """Best-fit bins of one capacity; what is larger has a bin of its own."""

    def __init__(self, capacity: int):
        self.capacity, self.tree, self.n = capacity, Tree(), 0

    def put(self, size: int) -> int:
        found = self.tree.tightest(size)
        if found:
            self.tree.remove(found)
            room, at = found
        else:
            room, at = self.capacity, self.n
            self.n += 1
        if room > size:
            self.tree.add((room - size, at))
        return at


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each size (falling sizes); None if more than ``most`` bins are needed."""
    bins, out = Bins(capacity), []
    for s in sizes:
        out.append(bins.put(s))
        if most is not None and bins.n > most:
            return None
    return out


def level_fit(sizes: list[int], shards: int) -> list[int]:
    """Bin of each size (falling sizes) in ``shards`` bins as level as best fit makes them.

    A size of a fair share of what is left or more gets a bin of its own; the
    others share the bins left at the least capacity that suffices.
    """
    alone, left = 0, sum(sizes)
    while alone < min(shards - 1, len(sizes)) and sizes[alone] * (shards - alone) >= left:
        left -= sizes[alone]
        alone += 1
    rest, bins = sizes[alone:], shards - alone
    if not rest:
        return list(range(alone))
    low = max(-(-left // bins), rest[0])  # no less can do
    high = low + rest[0]  # always does: every bin that refuses a size is fuller than the average
    made = best_fit(rest, low, bins)
    while made is None or low < high:
        middle = (low + high) // 2
        tried = best_fit(rest, middle, bins)
        if tried is None:
            low = middle + 1
        else:
            made, high = tried, middle
    return [*range(alone), *(alone + b for b in made)]


def _parcelled(batches, capacity: int):
    """Parcel of each group of a task (groups by falling size)."""
    bins, task = Bins(capacity), TaskContext.get().partitionId()
    for batch in batches:
        parcel = [bins.put(s) for s in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(parcel), pa.int64()), pa.array(parcel, pa.int64())], names=["k1", "k2", "bytes", "task", "parcel"])


def _counted(batches):
    """Place of each row among those of its shard in this task."""
    task, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        shard = batch.column(batch.schema.get_field_index("shard")).to_numpy()
        nth = np.empty(len(shard), np.int64)
        for s in np.unique(shard).tolist():
            at = np.flatnonzero(shard == s)
            nth[at] = np.arange(len(at)) + seen.get(s, 0)
            seen[s] = seen.get(s, 0) + len(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(shard), task)), pa.array(nth)], names=[*batch.schema.names, "task", "nth"])


def _slotted(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 without a gap: counts a task, then the place within the task."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", task long, nth long"
    rows = stored(rows.mapInArrow(_counted, schema))
    before = W.partitionBy("shard").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offset = rows.groupBy("shard", "task").count().select("shard", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    return rows.join(offset, ["shard", "task"]).select(*[c for c in rows.columns if c not in ("task", "nth")], (F.col("offset") + F.col("nth")).alias("slot"))


def pack(docs: DataFrame, keep: list[str], text_col: str = "text", shards: int | None = 16, capacity: int | None = None) -> DataFrame:
    """Put all documents into shards, equal texts together.

    Give ``shards`` for that many shards of near equal bytes, or ``capacity``
    for as few shards of at most that many bytes as best fit needs (a group of
    more bytes is a shard by itself).

    Returns ``row`` (a struct of the columns in ``keep``), ``size`` (UTF-8
    bytes of the text plus 1), ``text_crc32``, ``shard`` and ``slot`` (from 0,
    gapless within a shard).

    A null text is an empty one.  Rows that repeat are rows of their own, in
    the same shard.  Groups of equal size enter by their hash, so the shards
    depend on the texts alone; slots follow the order of arrival.  With fewer
    groups than shards some shards are empty; an empty table has no rows.
    """
    if (capacity is None) == (shards is None):
        raise ValueError("give either shards or capacity")
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), (F.octet_length(text) + F.lit(1).cast("long")).alias("size"), F.crc32(text).alias("text_crc32"),
                              F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")))
    groups = stored(rows.groupBy("k1", "k2").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")))
    total, n = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    unit = max(1, total // UNITS) if capacity is None else max(1, min(total // UNITS, capacity))
    large = (F.col("bytes") > unit) | (F.col("n") * UNITS > n)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # every group is one row here: no key is hot
    small = groups.filter(~large).select("k1", "k2", "bytes").repartition(parts, "k1", "k2").sortWithinPartitions(F.col("bytes").desc(), "k1", "k2")
    small = stored(small.mapInArrow(lambda it: _parcelled(it, unit), "k1 long, k2 long, bytes long, task long, parcel long"))
    parcels = small.groupBy("task", "parcel").agg(F.sum("bytes").alias("bytes")).select("bytes", "task", "parcel", F.lit(True).alias("parcels"))
    single = groups.filter(large).select("bytes", F.col("k1").alias("task"), F.col("k2").alias("parcel"), F.lit(False))
    # at most 4 * UNITS rows and one for each task
    items = sorted(((r[0], r[3], r[1], r[2]) for r in parcels.union(single).toLocalIterator()), key=lambda r: (-r[0], *r[1:]))
    sizes = [r[0] for r in items]
    shard = level_fit(sizes, shards) if capacity is None else best_fit(sizes, capacity)
    table = [(bool(p), a, b, s) for (_, p, a, b), s in zip(items, shard)]
    place = spark.createDataFrame(table, "parcels boolean, a long, b long, shard int")
    hot = place.filter("NOT parcels").select(F.col("a").alias("k1"), F.col("b").alias("k2"), F.col("shard").alias("hot"))
    cold = small.join(F.broadcast(place.filter("parcels").select(F.col("a").alias("task"), F.col("b").alias("parcel"), "shard")), ["task", "parcel"]).select("k1", "k2", "shard")
    marked = rows.join(F.broadcast(hot), ["k1", "k2"], "left")
    out = ["row", "size", "text_crc32", "shard"]
    placed = marked.filter("hot IS NOT NULL").withColumnRenamed("hot", "shard").select(*out)
    placed = placed.unionByName(marked.filter("hot IS NULL").drop("hot").join(cold, ["k1", "k2"]).select(*out))
    return _slotted(placed)


def write_shards(packed: DataFrame, path: str) -> None:
    """Write packed documents as one folder of Parquet files for each shard, rows in slot order within a file."""
    parts = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
