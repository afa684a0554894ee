"""SimHash near-dedup with vantage-point trees.

Fingerprints: majority bits of the XXH64 of all word shingles of a text.
Links: distinct fingerprints at ``max_bits`` or fewer differing bits, found
exactly by two vantage-point trees, one over each half of the fingerprint:
two fingerprints within ``max_bits`` agree within ``max_bits // 2`` in a half.

A tree node holds a vantage point and a radius; points within the radius go
inside, the others outside.  By the triangle inequality a pair may be parted
by the sphere only if the outer point lies within ``max_bits // 2`` of it:
such boundary points also visit the inside, and no other branch can hold a
partner.  The upper levels are fitted on a bounded sample of distinct
fingerprints and broadcast; Spark deals the points to the leaves (shards) and
each shard is searched by growing the tree further on its own points.  Half
the bits instead of all keep the boundary thin: about 13% of the points of a
node are sent twice (27% with whole fingerprints), which makes the work grow
as about the power 1.2 of the number of distinct fingerprints.

A sphere is used only if it leaves at most ``GAIN`` of the pairs of a node, so
the copies on a level are bounded and the work of a shard never exceeds that
of comparing it directly.  A leaf that no sphere parts (a dense ball of near
copies) and that the sample shows to be large is dealt in blocks: every pair
of blocks is a task of its own, so no task holds more than two blocks.

A task returns a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm import _text as T
from shopmart.llm._graph import components
from shopmart.llm._store import stored

#: Distinct fingerprints on which the upper tree is fitted (one in ``SAMPLE_SHARE`` between the two bounds), and
#: how many of them make a shard at least.
SAMPLE, MAX_SAMPLE, SAMPLE_SHARE, SAMPLE_LEAF = 1 << 16, 1 << 20, 512, 8
#: Distinct fingerprints that a shard shall hold, and that are compared without a further split.
SHARD, LEAF = 4096, 192
#: Distinct fingerprints of a leaf in one block, about.
BLOCK = 1 << 15
#: Share of the pairs of a node that a sphere may leave at most.
GAIN = 0.85
_LOW = np.uint64(0xFFFFFFFF)
_LOWER = bytes(T.LOWER)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of the shingles (ASCII lower-cased words joined by a space); 0 without words."""
    w = (text or "").encode().translate(_LOWER).split()
    if not w:
        return 0
    joined = b" ".join(w)
    end = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    n = max(len(w) - shingle + 1, 1)
    start, end = start[:n].tolist(), end[-n:].tolist()
    h, votes = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        d = b"".join([h(joined[a:b], seed) for a, b in zip(start[i: i + (1 << 15)], end[i: i + (1 << 15)])])
        votes += np.unpackbits(np.frombuffer(d, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def _split(points: np.ndarray, reach: int):
    """Vantage point and radius that leave the fewest pairs to compare; None if no sphere parts the points well."""
    best = None
    for at in np.linspace(0, len(points) - 1, 7).astype(int):
        n = np.cumsum(np.bincount(np.bitwise_count(points ^ points[at]), minlength=65)) / len(points)
        inside = n[np.minimum(np.arange(65) + reach, 64)]  # with visitors
        pairs = inside ** 2 + (1 - n) ** 2
        radius = int(np.argmin(pairs))
        if best is None or pairs[radius] < best[0]:
            best = pairs[radius], points[at], radius
    return best[1:] if best[0] <= GAIN else None


def _grow(sample: np.ndarray, reach: int, leaf: int, each: float) -> list:
    """Upper tree as a list of nodes: (vantage point, radius, inside, outside), or the number of blocks of a leaf
    (a sampled point stands for ``each`` points)."""
    nodes, todo = [1], [(0, sample)]
    while todo:
        at, points = todo.pop()
        cut = _split(points, reach) if len(points) > leaf else None
        if cut:
            d = np.bitwise_count(points ^ cut[0])
            nodes[at] = (*cut, len(nodes), len(nodes) + 1)
            todo += [(len(nodes), points[d <= cut[1] + reach]), (len(nodes) + 1, points[d > cut[1]])]
            nodes += [1, 1]
        else:
            nodes[at] = max(1, -int(-len(points) * each // BLOCK))
    return nodes


def _in_blocks(fp: np.ndarray, blocks: int):
    """Rows of ``fp`` with the pairs of blocks (smaller block times ``blocks`` plus larger) they take part in, and
    their side there: 0 for the points of the smaller block."""
    mine = (fp * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks
    rows, other = np.repeat(np.arange(len(fp)), blocks), np.tile(np.arange(blocks), len(fp))
    low, high = np.minimum(mine[rows], other), np.maximum(mine[rows], other)
    return rows, low * blocks + high, (mine[rows] > other).astype(np.int32)


def _dealt(batches, trees: list, reach: int):
    """Each fingerprint with every leaf, and pair of blocks of it, that it lives in or visits."""
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        shards, pairs, sides, members = [], [], [], []
        for t, tree in enumerate(trees):
            half, todo = _half(fp, t), [(0, np.arange(len(fp)))]
            while todo:
                at, rows = todo.pop()
                if isinstance(tree[at], int):
                    r, pair, side = _in_blocks(fp[rows], tree[at])
                    shards.append(np.full(len(r), at * len(trees) + t))
                    pairs.append(pair)
                    sides.append(side)
                    members.append(fp[rows[r]])
                elif len(rows):
                    point, radius, inside, outside = tree[at]
                    d = np.bitwise_count(half[rows] ^ point)
                    todo += [(inside, rows[d <= radius + reach]), (outside, rows[d > radius])]
        columns = [np.concatenate(shards), np.concatenate(pairs), np.concatenate(sides), np.concatenate(members).view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "pair", "side", "fp"])


def _half(fp: np.ndarray, t: int) -> np.ndarray:
    return fp & _LOW if t else fp >> np.uint64(32)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of n points."""
    label = np.arange(n)
    while len(a):
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _close(points: np.ndarray, side: np.ndarray, max_bits: int):
    """Spanning links of points compared directly, in blocks of rows; with two sides, of one against the other."""
    label, here = np.arange(len(points)), np.flatnonzero(side == side[0])
    there = np.flatnonzero(side != side[0]) if len(here) < len(points) else here
    block = max(1, (1 << 20) // len(there))
    for i in range(0, len(here), block):
        a, b = np.nonzero(np.bitwise_count(points[here[i: i + block], None] ^ points[None, there]) <= max_bits)
        label = _forest(len(points), np.concatenate([here[i + a], np.arange(len(points))]), np.concatenate([there[b], label]))
    on = label != np.arange(len(points))
    return points[on], points[label[on]]


def _linked(task: pa.Table, max_bits: int) -> pa.Table:
    """Spanning links within a block, or between two, by growing the tree further."""
    t = task.column("shard")[0].as_py() % 2
    fp, first = np.unique(task.column("fp").to_numpy().view(np.uint64), return_index=True)
    side = task.column("side").to_numpy()[first]
    two = (side != side[0]).any()
    a, b, todo = [], [], [(fp, side, False)]
    while todo:
        points, side, whole = todo.pop()
        if len(points) < 2 or two and (side == side[0]).all():
            continue
        # points that agree in this half are split by all bits, with the wider boundary
        key, reach = (points, max_bits) if whole else (_half(points, t), max_bits // 2)
        cut = _split(key, reach) if len(points) > LEAF else None
        if cut:
            d = np.bitwise_count(key ^ cut[0])
            todo += [(points[on], side[on], whole) for on in (d <= cut[1] + reach, d > cut[1])]
        elif len(points) > LEAF and not whole:
            todo.append((points, side, True))
        else:
            x, y = _close(points, side, max_bits)
            a.append(x)
            b.append(y)
    a, b = (np.concatenate([np.zeros(0, np.uint64), *x]).view(np.int64) for x in (a, b))
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def fingerprint_links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links ``a``, ``b`` that join the distinct fingerprints (a stored table of one long column, ``fp``) within ``max_bits`` bits.

    Not all pairs, but enough that any pair within ``max_bits`` is connected.
    """
    spark, n = distinct.sparkSession, distinct.count()
    size = min(max(SAMPLE, n // SAMPLE_SHARE), MAX_SAMPLE)
    share = max(1, (1 << 20) * size // max(n, 1))
    chosen = distinct.filter(F.pmod(F.xxhash64(F.lit(2), "fp"), F.lit(1 << 20)) < share).limit(2 * size)
    sample = np.sort(chosen.toArrow().column("fp").to_numpy().view(np.uint64))
    reach = max_bits // 2
    leaf = max(SAMPLE_LEAF, SHARD * len(sample) // max(n, 1))
    each = n / max(len(sample), 1)
    trees = spark.sparkContext.broadcast([_grow(_half(sample, t), reach, leaf, each) for t in (0, 1)])
    tasks = distinct.mapInArrow(lambda it: _dealt(it, trees.value, reach), "shard long, pair long, side int, fp long")
    return tasks.groupBy("shard", "pair").applyInArrow(lambda s: _linked(s, max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Fingerprint and near-duplicate group of each document.

    Returns ``row`` (the columns in ``keep``, the id among them),
    ``fingerprint`` (long), ``component_id`` (the smallest id among the
    documents reachable by links between fingerprints at ``max_bits`` or fewer
    differing bits) and ``kept``, true for one row of each group: one with the
    smallest id.

    A text of fewer words than ``shingle`` is one shingle of all its words;
    null and wordless texts have fingerprint 0, which links like any other.
    Rows that repeat share their group.  Null ids do not count as smallest; a
    group of null ids only has a null id and keeps one of its rows.
    """
    def prints(text):
        return [pa.array([_signed(fingerprint(x, shingle)) for x in text.to_pylist()], pa.int64())]

    fp = T.map_text(docs, text_col, keep, "fp long", prints).withColumn("rid", F.monotonically_increasing_id())
    fp = stored(fp)
    doc_id = F.col(f"row.`{id_col}`")
    nodes = stored(fp.groupBy("fp").agg(F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), "rid")).alias("first")))
    label = components(fingerprint_links(nodes.select("fp"), max_bits))
    grouped = nodes.join(label, nodes["fp"] == label["node"], "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    least = grouped.groupBy("label").agg(F.min("first").alias("least"))
    by_print = stored(grouped.join(least, "label").select(F.col("fp").alias("of"), "least"))
    out = fp.join(by_print, fp["fp"] == by_print["of"], "left")
    return out.select("row", F.col("fp").alias("fingerprint"), F.col("least.id").alias("component_id"), (F.col("rid") == F.col("least.rid")).alias("kept"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x
