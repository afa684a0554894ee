"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm._store import stored


def _star(sym: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them (large: those above the node; small: those below, and itself)."""
    if not large:
        sym = sym.filter("b < a")
    least = stored(sym.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m")))
    hung = sym.join(least, sym["a"] == least["node"])
    out = hung.filter("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node reachable) for each node of ``links`` (two columns, any order).

    Alternating large and small stars: after a logarithmic number of rounds
    every node hangs on its smallest one.  Links stay in tables; the driver
    sees one checksum a round.  Nodes without links are not returned; links
    with a null and links of a node to itself are dropped.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns)
    edges = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(a.isNotNull() & b.isNotNull() & (a != b)).distinct())
    before = None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
        spread = stored(_star(edges.union(edges.select("b", "a")), large=True))
        edges = stored(_star(spread.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), large=False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b").distinct())
