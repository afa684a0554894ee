"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells.

Cells are fitted on a bounded sample of distinct vectors; every vector is then
assigned to the cell of its nearest centre (its home) and also visits each
cell whose border is near: for two vectors u, v with homes g, h the sum of
(c_g - c_h).u and (c_h - c_g).v is at most |u - v| |c_g - c_h|, so one of the
two lies within half of that from the other's cell.  With ``reach`` = 1, the
default, that bound makes the search exact; a smaller ``reach`` visits fewer
cells and may lose links, the more the fewer dimensions the vectors span.

There are two levels.  The cells are many and small, so that a vector is
compared with few others; they are gathered into few large groups, and a
vector is sent once to the group of its home and to each group that holds a
cell it visits, so it is sent few times.  A task compares, for each cell of a
group, its residents with the vectors that visit it.

Exact copies are one vector with a count.  A group's residents and visitors
are dealt to blocks of bounded size and every pair of blocks is a task of its
own, so a group of near copies of any size is split; a task returns link
counts per vector and a spanning forest, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from shopmart.llm._graph import components
from shopmart.llm._store import stored
from shopmart.llm.simhash import _forest

#: Distinct vectors on which cells are fitted; vectors a cell shall hold; most cells; rounds of k-means.
SAMPLE, CELL, MAX_CELLS, ROUNDS = 16384, 128, 2048, 4
#: Vectors a group of cells shall hold.
GROUP = 8192
#: Residents and visitors in a block; products taken, and found pairs joined to a forest, at once.
BLOCK, VISITORS, PAIRS = 8192, 8192, 1 << 20
#: Groups and blocks grow with the table up to so many times, so that a vector of a large table is sent less often.
GROWN = 4
#: Bytes of vectors that leave a task at once, each copy counted.
DEALT = 4 << 20


def _unit(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision, padded with zeros to ``width``."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.zeros((len(lengths), width))
    x[np.arange(width) < lengths[:, None]] = flat
    x /= np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of spherical k-means, from evenly spaced rows of the (hash-ordered) sample."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        home = np.concatenate([np.argmax(x[i: i + 4096] @ centres.T, 1) for i in range(0, len(x), 4096)])
        order = np.argsort(home, kind="stable")
        first = np.flatnonzero(np.diff(home[order], prepend=-1))
        sums = np.add.reduceat(x[order], first, axis=0)
        norm = np.linalg.norm(sums, axis=1)
        ok = norm > 1e-9
        centres[home[order][first][ok]] = sums[ok] / norm[ok, None]
    return centres


def _margins(centres: np.ndarray, least: float, reach: float) -> np.ndarray:
    """How much nearer to its home than to another cell a vector may be and still visit it."""
    return reach * 0.5 * np.sqrt(2 - 2 * least) * np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T)) + 1e-9


def _assigned(batches, centres: np.ndarray, group: np.ndarray, least: float, reach: float):
    """Group and cell of the home of each vector, and the groups it visits (columns node, vector)."""
    margin = _margins(centres, least, reach)
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            s = _unit(part.column(1), centres.shape[1]) @ centres.T
            cell = np.argmax(s, 1)
            near = s[np.arange(len(s)), cell][:, None] - s <= margin[cell]
            there = np.zeros((len(s), group.max() + 1), bool)
            for g in range(there.shape[1]):
                there[:, g] = near[:, group == g].any(1)
            there[np.arange(len(s)), group[cell]] = False
            visits = np.split(np.nonzero(there)[1].astype(np.int32), np.cumsum(there.sum(1))[:-1])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(group[cell], pa.int32()), pa.array(cell, pa.int32()), pa.array(visits, pa.list_(pa.int32()))],
                                             names=["node", "home", "cell", "visits"])


def _dealt(batches, residents: np.ndarray, visitors: np.ndarray):
    """Each vector with the tasks it takes part in: a block of a group's residents (side 0) against each block of
    its residents and of its visitors (side 1; 2 is both)."""
    for batch in batches:
        home = batch.column(1).to_numpy()
        ends, flat = batch.column(3).offsets.to_numpy(), batch.column(3).values.to_numpy()
        spread = (batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
        most = max(1, DEALT * batch.num_rows // max(batch.nbytes, 1))  # a vector may go to very many tasks
        rows, tasks, sides = [], [], []

        def sent():
            part = pa.Table.from_batches([batch]).take(pa.array(rows, pa.int64()))
            part = part.append_column("task", pa.array(tasks, pa.string())).append_column("side", pa.array(sides, pa.int32()))
            return part.combine_chunks().to_batches()

        for r, g in enumerate(home.tolist()):
            mine = int(spread[r]) % residents[g]
            put = [(f"{g} {mine} {mine}", 2)]
            for j in range(residents[g]):
                if j != mine:
                    put += [(f"{g} {mine} {j}", 0), (f"{g} {j} {mine}", 1)]
            put += [(f"{g} {mine} visit {q}", 0) for q in range(visitors[g])]
            for g in flat[ends[r]: ends[r + 1]].tolist():
                q = int(spread[r]) % visitors[g]
                put += [(f"{g} {j} visit {q}", 1) for j in range(residents[g])]
            rows += [r] * len(put)
            tasks += [t for t, _ in put]
            sides += [s for _, s in put]
            if len(rows) >= most:
                yield from sent()
                rows, tasks, sides = [], [], []
        if rows:
            yield from sent()


def _compared(task: pa.Table, least: float, width: int, centres: np.ndarray, reach: float) -> pa.Table:
    """Links of one pair of blocks: a count for each vector, and the vector it hangs on.

    A pair of one cell is met from either end, each counting its own; a pair
    of two cells is met once, or, if each visits the other's cell, counted in
    the smaller cell only.
    """
    side = task.column("side").to_numpy()
    node = task.column("node").to_numpy()
    copies = task.column("copies").to_numpy()
    cell = task.column("cell").to_numpy()
    x = _unit(task.column("vector").combine_chunks(), width)
    margin = _margins(centres, least, reach)
    own = np.einsum("ij,ij->i", x, centres[cell])
    here, there = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    here = here[np.argsort(cell[here], kind="stable")]
    cells, first = np.unique(cell[here], return_index=True)
    away = own[there][:, None] - x[there] @ centres[cells].T
    near = away <= margin[np.ix_(cell[there], cells)]
    near |= cell[there][:, None] == cells[None, :]
    links, label = np.zeros(len(node), np.int64), np.arange(len(node))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def joined():
        p, q = (np.concatenate(e) for e in zip(*found))
        found.clear()
        return _forest(len(node), np.concatenate([p, np.arange(len(node))]), np.concatenate([q, label]))

    for c, (h, stays) in enumerate(zip(cells, np.split(here, first[1:]))):
        comes = there[near[:, c]]
        step = max(1, PAIRS // len(stays))
        for i in range(0, len(comes), step):
            rows = comes[i: i + step]
            p, q = np.nonzero(x[rows] @ x[stays].T >= least)
            p, q = rows[p], stays[q]
            other = cell[p] != h
            # does the resident visit the other's cell, and is that the smaller one?
            back = other & (cell[p] < h)
            at = np.flatnonzero(back)
            if len(at):
                back[at] = own[q[at]] - np.einsum("ij,ij->i", x[q[at]], centres[cell[p[at]]]) <= margin[h, cell[p[at]]]
            on = (p != q) & ~back
            p, q, other = p[on], q[on], other[on]
            if not len(p):
                continue
            np.add.at(links, p, copies[q])
            np.add.at(links, q[other], copies[p[other]])
            found.append((p, q))
            held += len(p)
            if held > PAIRS:
                label, held = joined(), 0
    if found:
        label = joined()
    on = (links > 0) | (label != np.arange(len(node)))
    return pa.table({"node": pa.array(node[on], pa.int64()), "links": pa.array(links[on], pa.int64()), "up": pa.array(node[label[on]], pa.int64())})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, reach: float = 1.0) -> DataFrame:
    """Links at cosine ``least`` or more (double precision), one row per vector.

    Returns ``id_col``, ``n_links`` (other rows linked directly, copies
    included), ``component_id`` (smallest id reachable, itself included) and
    ``kept`` (it is the smallest).

    Vectors that are null, zero, or hold null or non-finite numbers link with
    nothing; vectors of unequal length are compared as if padded with zeros.
    Rows that repeat are rows of their own and link with each other.  A null
    id does not count as smallest and is not kept, unless nothing links it:
    then ``component_id`` is null, and it is kept.
    """
    spark = vectors.sparkSession
    vec = F.col(f"`{vector_col}`")
    wide = vec if isinstance(vectors.schema[vector_col].dataType, ArrayType) and isinstance(vectors.schema[vector_col].dataType.elementType, FloatType) else vec.cast("array<double>")
    usable = F.exists(wide, lambda e: e != 0) & ~F.exists(wide, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.when(F.coalesce(usable, F.lit(False)), wide).alias("vector"))
    rows = rows.withColumn("k1", F.xxhash64("vector")).withColumn("k2", F.xxhash64(F.lit(1), "vector"))
    good = rows.filter("vector IS NOT NULL")
    distinct = good.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    distinct = stored(distinct.withColumn("node", F.monotonically_increasing_id()))
    n, width = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    share = max(1, (1 << 20) * SAMPLE // max(n, 1))
    sample = distinct.filter(F.pmod(F.xxhash64(F.lit(3), "k1"), F.lit(1 << 20)) < share).select("k1", "vector").limit(2 * SAMPLE).toArrow().sort_by("k1")
    k = int(np.clip(n // CELL, 1, min(MAX_CELLS, max(sample.num_rows // 4, 1))))
    centres = fit_cells(_unit(sample.column("vector").combine_chunks(), width), k) if sample.num_rows else np.zeros((1, width))
    grown = int(np.clip(n // (8 * GROUP), 1, GROWN))
    groups = int(np.clip(n // (GROUP * grown), 1, k))
    group = np.unique(np.argmax(centres @ fit_cells(centres, groups).T, 1), return_inverse=True)[1]
    model = spark.sparkContext.broadcast((centres, group))
    cells = stored(distinct.select("node", "vector").mapInArrow(lambda it: _assigned(it, *model.value, least, reach), "node long, home int, cell int, visits array<int>"))
    residents, visitors = np.ones(group.max() + 1, np.int64), np.zeros(group.max() + 1, np.int64)
    # a row for each set of groups visited, at most one a vector, is counted before it is spread over its groups
    for r in cells.groupBy("home").count().collect():  # at most MAX_CELLS rows
        residents[r["home"]] = -(-r["count"] // (BLOCK * grown))
    sets = cells.filter(F.size("visits") > 0).groupBy("visits").count()
    for r in sets.select(F.explode("visits").alias("home"), "count").groupBy("home").agg(F.sum("count").alias("count")).collect():
        visitors[r["home"]] = -(-r["count"] // (VISITORS * grown))
    kind = distinct.schema["vector"].dataType.simpleString()
    dealt = cells.join(distinct.select("node", "copies", "vector"), "node").mapInArrow(
        lambda it: _dealt(it, residents, visitors), f"node long, home int, cell int, visits array<int>, copies long, vector {kind}, task string, side int")
    found = stored(dealt.groupBy("task").applyInArrow(lambda t: _compared(t, least, width, model.value[0], reach), "node long, links long, up long"))
    label = components(found.select("node", "up"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = distinct.select("node", "id", "k1", "k2", "copies").join(label, "node", "left").join(links, "node", "left")
    nodes = nodes.withColumn("label", F.coalesce("label", "node"))
    smallest = nodes.groupBy("label").agg(F.min("id").alias("component_id"))
    nodes = stored(nodes.join(smallest, "label").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    linked = good.select("id", "k1", "k2").join(nodes, ["k1", "k2"])
    alone = rows.filter("vector IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.select("id", "n_links", "component_id").unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.col("n_links") == 0)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))
