import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from shopmart.operators.filters import completed_orders
from shopmart.operators.terms import category_tree
from shopmart.plans.items import product_choice, return_flag
from shopmart.functions import per_unit, lenient_decimal


def test_product_choice_cases(spark):
    rows = [
        (1, "8000", "7400"),     # variation ok
        (2, "0", "7400"),        # variation '0', product ok
        (3, "100", "200"),       # both too small -> placeholder
        (4, "9666", "7400"),     # variation excluded -> placeholder
        (5, "8000", "9666"),     # product excluded -> placeholder
        (6, None, "7400"),       # a key missing -> placeholder
        (7, "abc", "7300"),      # lenient text -> 0, product ok
        (8, "7.3e3", "1"),       # the numeric value counts, not the digits before the dot
        (9, "7296.9", "7400"),   # below the first id: product
        (10, "08000", "1"),
    ]
    df = spark.createDataFrame(rows, "i int, v string, p string")
    got = [r.pid for r in df.orderBy("i").select(product_choice(F.col("v"), F.col("p")).alias("pid")).collect()]
    assert got == [8000, 7400, 7294, 7294, 7294, 7294, 7300, 7300, 7400, 8000]


def test_return_flag_before_on_after_null(spark):
    d = datetime.date
    rows = [(1, d(2020, 1, 5), d(2020, 1, 4)), (2, d(2020, 1, 5), d(2020, 1, 5)),
            (3, d(2020, 1, 5), d(2020, 1, 6)), (4, d(2020, 1, 5), None)]
    df = spark.createDataFrame(rows, "i int, dl date, rt date")
    got = [r.f for r in df.orderBy("i").select(return_flag(F.col("dl"), F.col("rt")).alias("f")).collect()]
    assert got == [True, True, False, False]


def test_per_unit_rounding_and_zero_qty(spark):
    df = spark.createDataFrame([(1, "10.00", "3"), (2, "10.00", "0"), (3, "-0.05", "2"), (4, "1", "abc")],
                               "i int, a string, q string")
    got = [r.u for r in df.orderBy("i").select(per_unit(lenient_decimal("a"), lenient_decimal("q")).alias("u")).collect()]
    assert got == [Decimal("3.33"), None, Decimal("-0.03"), None]


def test_cutoff_instant_ge_vs_gt(spark):
    posts = spark.createDataFrame(
        [(1, "shop_order", "wc-completed", datetime.datetime(2014, 9, 1, 0, 0)),
         (2, "shop_order", "wc-completed", datetime.datetime(2014, 8, 31, 23, 59)),
         (3, "shop_order", "wc-pending", datetime.datetime(2015, 1, 1)),
         (4, "other", "wc-completed", datetime.datetime(2015, 1, 1))],
        "ID long, post_type string, post_status string, post_date timestamp_ntz")
    ge = {r.ID for r in completed_orders(posts, "2014-09-01").collect()}
    gt = {r.ID for r in completed_orders(posts, "2014-09-01", require_type=False, strict_after=True).collect()}
    assert ge == {1} and gt == {4}


def test_category_tree_depths(spark):
    tt = spark.createDataFrame([
        (1, 1, "product_cat", 0),    # root with children
        (2, 2, "product_cat", 0),    # root without children
        (3, 3, "product_cat", 1),    # depth 1
        (4, 4, "product_cat", 3),    # depth 2
        (5, 5, "product_cat", 4),    # depth 3
        (6, 6, "product_cat", 5),    # depth 4 -> absent
        (7, 7, "product_cat", 1),    # depth 1 leaf
        (8, 8, "pa_farbe", 0),       # other taxonomy root -> absent
    ], "term_taxonomy_id long, term_id long, taxonomy string, parent long")
    terms = spark.createDataFrame([(i, f"N{i} &amp; x", f"n{i}") for i in range(1, 9)], "term_id long, name string, slug string")
    got = {tuple(r) for r in category_tree(tt, terms).collect()}
    assert got == {
        (1, "N1 &amp; x", None, None, None),
        (2, "N2 &amp; x", None, None, None),
        (3, "N1 &amp; x", "N3 & x", None, None),
        (7, "N1 &amp; x", "N7 & x", None, None),
        (4, "N1 &amp; x", "N3 & x", "N4 & x", None),
        (5, "N1 &amp; x", "N3 & x", "N4 & x", "N5 & x"),
    }


def test_category_tree_equals_recursive_cte(spark):
    """Cross-check: the three-join flattening equals a depth-limited recursive CTE."""
    from shopmart.sources.fixture_star import raw_from_star
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    raw.term_taxonomy.createOrReplaceTempView("ctt")
    raw.terms.createOrReplaceTempView("cterms")
    rec = spark.sql("""
        WITH RECURSIVE tree(term_id, depth, name0, name1, name2, name3) AS (
          SELECT tt.term_id, 0, t.name, CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING)
          FROM ctt tt JOIN cterms t ON t.term_id = tt.term_id
          WHERE tt.taxonomy = 'product_cat' AND tt.parent = 0
          UNION ALL
          SELECT c.term_id, p.depth + 1, p.name0,
                 CASE WHEN p.depth = 0 THEN replace(ct.name, 'amp;', '') ELSE p.name1 END,
                 CASE WHEN p.depth = 1 THEN replace(ct.name, 'amp;', '') ELSE p.name2 END,
                 CASE WHEN p.depth = 2 THEN replace(ct.name, 'amp;', '') ELSE p.name3 END
          FROM tree p JOIN ctt c ON c.parent = p.term_id LEFT JOIN cterms ct ON ct.term_id = c.term_id
          WHERE p.depth < 3)
        SELECT DISTINCT term_id, name0, name1, name2, name3 FROM tree""")
    ours = category_tree(raw.term_taxonomy, raw.terms)
    a = sorted(map(tuple, ours.collect()), key=str)
    b = sorted(map(tuple, rec.collect()), key=str)
    assert a == b and len(a) > 0
