"""Mixing sources to target weights by iterative proportional fitting.  DataFrame functions only.

Token weights are summed by cell (source x language x topic); only this small
table takes part in the fitting.  A sweep rakes it to the source, the
language and the topic marginals in turn: each weight is multiplied by target
over sum of its marginal.  A document's probability is the fitted over the
observed weight of its cell, divided by the largest such factor, so that the
expected token weights of the sample have exactly the fitted marginals and no
probability is cut off at 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopmart.llm._store import stored

DIMS = ("source", "lang", "topic")
#: Share of a marginal value in the mix: its share of the tokens to this power (1 keeps it, 0 makes all equal).
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 1.0}
_SPACE = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text, split at ASCII whitespace; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, _SPACE, -1), lambda w: w != "")), F.lit(0)).cast("long")


def form(text: Column) -> Column:
    """A topic by the form of the text: table, markup, upper, notice or prose (also for null)."""
    return (F.when(F.contains(text, F.lit(" | ")), "table").when(F.rlike(text, F.lit(r"[#$%&*]{3}")), "markup")
            .when(F.contains(text, F.lit("!! ")), "upper").when(F.contains(text, F.lit("icense")), "notice").otherwise("prose"))


def _key(value: Column) -> Column:
    """Values of a marginal as text that tells null from any value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def tempered(cells: DataFrame, temper: dict[str, float]) -> DataFrame:
    """Target shares (dim, value, share) from the observed token shares."""
    out = None
    for dim in DIMS:
        t = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("n")).filter("n > 0")
        t = t.select(F.lit(dim).alias("dim"), "value", F.pow(F.col("n").cast("double"), F.lit(float(temper[dim]))).alias("share"))
        out = t if out is None else out.unionByName(t)
    return out


def fit(cells: DataFrame, targets: DataFrame, sweeps: int = 60, tolerance: float = 1e-10) -> DataFrame:
    """Fitted weight ``w`` (shares of 1) of each cell with tokens and positive targets.

    Stops when every marginal is met to ``tolerance``, or after ``sweeps``
    (targets that no weights on these cells can meet).
    """
    w = cells.filter("tokens > 0")
    for dim in DIMS:
        t = targets.filter(F.col("dim") == dim).select(F.col("value").alias(dim), (F.col("share") / F.sum("share").over(W.partitionBy("dim"))).alias(f"t_{dim}"))
        w = w.join(t.filter(f"t_{dim} > 0"), dim)
    w = stored(w.withColumn("w", F.col("tokens").cast("double")))
    error, done = None, 0
    while done < sweeps and (error is None or error > tolerance):
        for _ in range(min(5, sweeps - done)):
            for dim in DIMS:
                w = w.withColumn("w", F.col("w") * F.col(f"t_{dim}") / F.sum("w").over(W.partitionBy(dim)))
            done += 1
        w = stored(w)
        error = 0.0
        for dim in DIMS[:-1]:  # the last one has just been met
            off = w.groupBy(dim, f"t_{dim}").agg(F.sum("w").alias("s")).agg(F.max(F.abs(F.col("s") / F.col(f"t_{dim}") - 1))).first()[0]
            error = max(error, off or 0.0)
    return w


def sized(cells: DataFrame, targets: DataFrame, tokens: float) -> DataFrame:
    """Probability ``p`` of each cell in a mix of ``tokens`` expected tokens.

    Cells that the fit asks more of than they hold are taken whole, and the
    others are raked to what the targets still lack, until no cell is short.
    Where whole cells alone exceed the target of a value, or hold less than
    it, that target cannot be met; the others share the difference.
    """
    free, whole, left = cells.filter("tokens > 0"), None, float(tokens)
    share = targets.filter("share > 0").select("dim", "value", (F.col("share") * F.lit(left) / F.sum("share").over(W.partitionBy("dim"))).alias("share"))
    while True:
        lacking = None
        for dim in DIMS:
            t = share.filter(F.col("dim") == dim).join(free.select(F.col(dim).alias("value")).distinct(), "value", "left_semi")
            if whole is not None:
                had = whole.groupBy(F.col(dim).alias("value")).agg(F.sum("tokens").alias("had"))
                t = t.join(had, "value", "left").withColumn("share", F.col("share") - F.coalesce("had", F.lit(0)))
            t = t.filter("share > 0").select("dim", "value", "share")
            lacking = t if lacking is None else lacking.unionByName(t)
        fitted = fit(free, stored(lacking)).select(*DIMS, "tokens", (F.col("w") * F.lit(left)).alias("w"))
        short = fitted.filter("w >= tokens").select(*DIMS, "tokens")
        if short.isEmpty():
            break
        whole = stored(short if whole is None else whole.unionByName(short))
        free = stored(free.join(whole, list(DIMS), "left_anti"))
        left = max(0.0, float(tokens) - whole.agg(F.sum("tokens")).first()[0])
    p = fitted.select(*DIMS, (F.col("w") / F.col("tokens")).alias("p"))
    return p if whole is None else p.unionByName(whole.select(*DIMS, F.lit(1.0).alias("p")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
        topic: Column | None = None, targets: DataFrame | None = None, temper: dict[str, float] = TEMPER, seed: str = "mix", tokens: float | None = None) -> DataFrame:
    """Probability of each document and whether it is drawn.

    ``topic`` defaults to the form of the text; ``targets`` (dim, value,
    share; dims source, lang, topic; a value as text behind '=', or 'null')
    to the observed shares tempered by ``temper``.  Without ``tokens`` the
    mix meets the targets exactly and is as large as that allows: one small
    cell that the targets raise much makes it small.  With ``tokens``, the
    expected size of the mix, such cells are taken whole (see ``sized``).

    Returns ``row`` (a struct of all input columns), ``n_tokens``, ``topic``,
    ``probability`` and ``kept``.  The draw is a hash of seed, id and text:
    the same on every run, and rows that repeat share it.

    Nulls in source, language or topic are a value of their own.  Texts that
    are null or hold no word carry no weight and are not drawn (probability
    0), nor are cells whose target is 0; an empty table gives an empty mix.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"), n_words(text).alias("n_tokens"),
                       _key(F.col(f"`{source_col}`")).alias("source"), _key(F.col(f"`{lang_col}`")).alias("lang"), _key(form(text) if topic is None else topic).alias("topic"))
    cells = stored(rows.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")))
    targets = targets if targets is not None else tempered(cells, temper)
    if tokens is None:
        factor = fit(cells, targets).select(*DIMS, (F.col("w") / F.col("tokens")).alias("f"))
        most = factor.agg(F.max("f")).first()[0]
        factor = stored(factor.select(*DIMS, (F.col("f") / F.lit(most).cast("double")).alias("p")))
    else:
        factor = stored(sized(cells, targets, tokens))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(f"row.`{id_col}`").cast("string"), "text").cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)
    p = F.when(F.col("n_tokens") > 0, F.coalesce("p", F.lit(0.0))).otherwise(0.0)
    out = rows.join(factor, list(DIMS), "left")
    return out.select("row", "n_tokens", F.when(F.col("topic") != "null", F.substring("topic", 2, 1 << 30)).alias("topic"), p.alias("probability"), (draw < p).alias("kept"))
