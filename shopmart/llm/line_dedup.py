"""Line dedup: delete later copies of repeated runs of lines.  DataFrame functions only.

Suffix array over line ids by distributed prefix doubling.  Level 1 ranks
every line that occurs more than once; each round joins the rank of the run
at a line with the rank of the run that follows it and ranks the pairs, so
that ranks sort suffixes by their first 2, 4, 8 ... lines.  Ranks come from
the distinct pairs only: they are counted (with a map-side combine), dealt
out by range, sorted, and numbered by position, so a line or run that fills a
third of the corpus is one row there, and the join that hands the rank back
is a plain equi-join that adaptive execution may split.  A suffix that has
become unique leaves the rounds at once.

Suffixes of equal rank at depth ``min_lines`` are the longest-common-prefix
intervals of at least that depth.  All but the first suffix of an interval
mark their lines; marks that touch merge to maximal runs.  Deeper ranks would
not change the marks: a longer common prefix is a chain of intervals of this
depth that overlap, so doubling stops there.

Long lines may count alone: they are ranked once more by themselves, and all
but the first of each are marked too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopmart.llm._store import stored


def _lines(text: Column) -> Column:
    """Lines that hold more than whitespace; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.rlike(x, F.lit(r"\S")))


def _ranked(runs: DataFrame, key: list[str]) -> DataFrame:
    """Replace ``key`` by its rank among the keys that occur more than once; drop the other rows."""
    again = runs.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key)
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranks = again.repartitionByRange(parts, *key).sortWithinPartitions(*key).withColumn("place", F.monotonically_increasing_id())
    return stored(runs.join(ranks, key).select("rid", "id", "pos", F.col("place").alias("rank")))


def _later(runs: DataFrame, n: int) -> DataFrame:
    """Start and end of all but the first of the runs of ``n`` lines of each rank."""
    # stored, so that the join has an exchange of its own, which adaptive execution may split at a hot run
    first = stored(runs.groupBy("rank").agg(F.min(F.struct("id", "rid", "pos")).alias("first")))
    later = runs.join(first, "rank").filter(F.struct("rid", "pos") != F.struct("first.rid", "first.pos"))
    return later.select("rid", "pos", (F.col("pos") + n).alias("end"))


def remove_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """Delete later copies of runs of at least ``min_lines`` lines, and of lines of ``long_words`` words or more.

    Lines are split at line feeds and compared as they are (two 64-bit
    hashes); lines of whitespace only are not counted.  A line goes if it lies
    in ``min_lines`` consecutive lines of its document that also occur, as a
    sequence, earlier: in a document with a smaller id (null first; rows of
    equal id in order of arrival) or before in the same document.  The first
    occurrence of any line thus stays.  With ``long_words``, a line of that
    many words (split at ASCII whitespace) also goes if it occurs earlier,
    whatever its neighbours.

    Returns ``row`` (a struct of all input columns), ``n_lines``,
    ``n_removed``, ``removed`` (maximal runs as start and end line, end
    exclusive) and ``kept``: the text, unchanged if nothing goes, else the
    lines left without lines of whitespace.

    Null texts stay null and, like empty ones, have no lines.  Rows that
    repeat are documents of their own: the first keeps its lines.  Input
    columns of any name do no harm.
    """
    base = stored(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")))
    doc_id, text = F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`").cast("string")
    lines = base.select("rid", doc_id.alias("id"), F.posexplode(_lines(text)).alias("pos", "line"))
    long = [] if long_words is None else [(F.regexp_count("line", F.lit(r"\S+")) >= long_words).alias("long")]
    lines = stored(lines.select("rid", "id", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), *long))
    runs, depth = _ranked(lines, ["h1", "h2"]), 1
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        after = runs.select("rid", (F.col("pos") - step).alias("pos"), F.col("rank").alias("then"))
        runs, depth = _ranked(runs.join(after, ["rid", "pos"]), ["rank", "then"]), depth + step
    later = _later(runs, min_lines)
    if long:
        later = later.unionByName(_later(_ranked(lines.filter("long"), ["h1", "h2"]), 1))
    order = W.partitionBy("rid").orderBy("pos", "end")
    cut = F.col("pos") > F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    runs = later.withColumn("cut", cut.cast("int")).withColumn("run", F.sum("cut").over(order))
    runs = runs.groupBy("rid", "run").agg(F.min("pos").alias("start"), F.max("end").alias("end"))
    runs = runs.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))
    out = base.join(runs, "rid", "left").withColumn("lines", _lines(text))
    removed = F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>"))
    gone = F.aggregate(removed, F.lit(0), lambda n, r: n + r["end"] - r["start"])
    # what lies between the removed runs
    ends = F.concat(F.array(F.lit(0)), F.transform(removed, lambda r: r["end"]))
    starts = F.concat(F.transform(removed, lambda r: r["start"]), F.array(F.size("lines")))
    between = F.zip_with(ends, starts, lambda a, b: F.slice("lines", a + 1, b - a))
    return out.select("row", F.size("lines").cast("long").alias("n_lines"), gone.cast("long").alias("n_removed"), removed.alias("removed"),
                      F.when(F.col("removed").isNull(), text).otherwise(F.concat_ws("\n", F.flatten(between))).alias("kept"))
