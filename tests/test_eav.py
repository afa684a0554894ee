import pytest
from pyspark.sql import functions as F

from bench import eav_pivot_per_key
from shopmart.operators.eav import eav_lookup, eav_numbered, eav_pivot

from .conftest import meta_df


def test_pivot_strict_raises_on_duplicate(spark):
    m = meta_df(spark, [(1, "a", "x"), (1, "a", "y"), (2, "b", "z")])
    with pytest.raises(Exception, match="more than once"):
        eav_pivot(m, "post_id", {"a": "A", "b": "B"}).select("B").collect()


def test_pivot_max_mode_keeps_largest(spark):
    m = meta_df(spark, [(1, "a", "x"), (1, "a", "y"), (2, "b", "z")])
    got = {r.post_id: (r.A, r.B) for r in eav_pivot(m, "post_id", {"a": "A", "b": "B"}, on_duplicate="max").collect()}
    assert got == {1: ("y", None), 2: (None, "z")}


def test_pivot_missing_null_empty_zero(spark):
    m = meta_df(spark, [(1, "a", ""), (1, "b", "0"), (2, "a", None), (3, "c", "ignored")])
    got = {r.post_id: (r.A, r.B) for r in eav_pivot(m, "post_id", {"a": "A", "b": "B"}).collect()}
    # entity 3 has none of the keys -> not in the pivot at all
    assert got == {1: ("", "0"), 2: (None, None)}


def test_pivot_row_count_is_distinct_entities_and_matches_per_key_form(spark):
    rows = [(e, k, f"{e}-{k}") for e in range(50) for k in ("a", "b", "c") if (e + len(k)) % 4]
    m = meta_df(spark, rows)
    keys = {"a": "A", "b": "B", "c": "C"}
    p = eav_pivot(m, "post_id", keys)
    q = eav_pivot_per_key(m, "post_id", keys)
    assert p.count() == m.select("post_id").distinct().count()
    assert sorted(map(tuple, p.collect())) == sorted(map(tuple, q.select(p.columns).collect()))


def test_lookup_keeps_every_entity(spark):
    ents = spark.createDataFrame([(1,), (2,), (3,)], "ID long")
    m = meta_df(spark, [(1, "a", "x")])
    got = sorted((r.ID, r.A) for r in eav_lookup(ents, "ID", m, "post_id", {"a": "A"}).collect())
    assert got == [(1, "x"), (2, None), (3, None)]


def test_numbered_pairs_and_like_wildcard(spark):
    m = meta_df(spark, [
        (1, "_delivered_1", "d1"), (1, "_delivered_2", "d2"), (1, "_delivered_3", "d3"),
        (1, "_returned_2", "r2"), (1, "_returned_9", "r9"),
        (2, "Xdelivered-9", "dx"),            # '_' of LIKE matches X and -
        (3, "_returned_1", "orphan"),          # a return without delivery: no row
    ], entity="order_item_id")
    p = eav_numbered(m, "order_item_id", "_delivered_", "_returned_", number_col="n",
                     first_name="d", second_name="r", like_pattern="_delivered_%")
    got = sorted((r.order_item_id, r.n, r.d, r.r) for r in p.collect())
    assert got == [(1, "1", "d1", None), (1, "2", "d2", "r2"), (1, "3", "d3", None), (2, "Xdelivered-9", "dx", None)]


def test_numbered_strict_mode(spark):
    m = meta_df(spark, [(1, "_delivered_1", "a"), (1, "_delivered_1", "b"), (1, "_returned_1", "r"), (2, "_delivered_1", "c")],
                entity="order_item_id")
    got = eav_numbered(m, "order_item_id", "_delivered_", "_returned_", first_name="d", second_name="r")
    # a repeated delivery keeps its rows, each with the return of its number
    assert sorted((r.order_item_id, r.d, r.r) for r in got.collect()) == [(1, "a", "r"), (1, "b", "r"), (2, "c", None)]
    twice = m.unionByName(meta_df(spark, [(1, "_returned_1", "s")], entity="order_item_id"))
    with pytest.raises(Exception, match="more than once"):
        eav_numbered(twice, "order_item_id", "_delivered_", "_returned_", first_name="d", second_name="r").collect()
    latest = eav_numbered(twice, "order_item_id", "_delivered_", "_returned_", first_name="d", second_name="r", on_duplicate="max")
    assert {r.r for r in latest.collect()} == {"s", None}
