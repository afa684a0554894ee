"""Taxonomy operators: term links, category tree, per-object term attributes.

Term tables are dimensions (thousands of rows where the fact tables have
billions); no broadcast hint is forced -- AQE turns the joins into broadcast
joins when the measured side is below ``spark.sql.autoBroadcastJoinThreshold``
and keeps a shuffle join otherwise, so the plan stays correct if a taxonomy
grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collated

CATEGORY_TAXONOMY = "product_cat"
AMP = "amp;"


def term_links(relationships: DataFrame, term_taxonomy: DataFrame, terms: DataFrame,
               taxonomies: list[str] | None = None, collation: str | None = None) -> DataFrame:
    """``object_id, term_taxonomy_id, term_id, taxonomy, name, slug`` of every link.

    The three-table inner join of a term lookup, done once for all
    taxonomies (filtered to ``taxonomies`` at the scan when given, compared
    under ``collation``).
    """
    tt = term_taxonomy.select("term_taxonomy_id", "term_id", "taxonomy")
    if taxonomies is not None:
        tt = tt.where(collated("taxonomy", collation).isin(taxonomies))
    return (relationships.select("object_id", "term_taxonomy_id")
            .join(tt, "term_taxonomy_id")
            .join(terms.select("term_id", "name", "slug"), "term_id"))


def category_tree(term_taxonomy: DataFrame, terms: DataFrame, taxonomy: str = CATEGORY_TAXONOMY,
                  depth: int = 3) -> DataFrame:
    """Every node reachable from a root of ``taxonomy`` (parent 0) in at most
    ``depth`` steps, with the names along its path (``name0`` .. ``name<depth>``).

    ``name0`` is kept as stored; deeper names lose ``amp;``.  Children are
    looked up in all taxonomies, as the shop query does.  Deeper nodes are
    left out.  One join per level; the levels are unioned and de-duplicated.
    """
    names = terms.select("term_id", "name")
    roots = (term_taxonomy.where((F.col("taxonomy") == taxonomy) & (F.col("parent") == 0))
             .select("term_id").join(names, "term_id")
             .select(F.col("term_id"), F.col("name").alias("name0")))
    edges = term_taxonomy.select(F.col("parent").alias("_parent"), F.col("term_id").alias("_child"))
    levels = [roots]
    cur = roots
    for d in range(1, depth + 1):
        nxt = (cur.join(edges, cur.term_id == edges._parent)
                  .join(names.withColumnRenamed("term_id", "_tid"), F.col("_child") == F.col("_tid"), "left")
                  .select(F.col("_child").alias("term_id"),
                          *[F.col(f"name{i}") for i in range(d)],
                          F.replace(F.col("name"), F.lit(AMP), F.lit("")).alias(f"name{d}")))
        levels.append(nxt)
        cur = nxt
    all_cols = ["term_id"] + [f"name{i}" for i in range(depth + 1)]
    out = None
    for lv in levels:
        lv = lv.select(*[F.col(c) if c in lv.columns else F.lit(None).cast("string").alias(c) for c in all_cols])
        out = lv if out is None else out.unionByName(lv)
    return out.distinct()


def first_by(value: Column, order: Column, cond: Column | None = None) -> Column:
    """Value of the row with the lowest ``order`` (among rows meeting ``cond``).

    A fixed choice for the shop's unordered ``LIMIT 1``.
    """
    s = F.struct(order.alias("o"), value.alias("v"))
    return F.min(F.when(cond, s) if cond is not None else s)["v"]


def text_list(value: Column, cond: Column, sep: str = ", ") -> Column:
    """``GROUP_CONCAT(value SEPARATOR sep)`` over rows meeting ``cond``, sorted
    by value (the shop leaves the order open); NULL when there is none."""
    lst = F.array_sort(F.collect_list(F.when(cond, value)))
    return F.when(F.size(lst) > 0, F.array_join(lst, sep))


def has_term(cond: Column) -> Column:
    """``(SELECT 1 ... UNION SELECT 0 LIMIT 1)`` as a boolean: any row meets ``cond``."""
    return F.coalesce(F.max(F.when(cond, F.lit(1))), F.lit(0)) == 1


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))
