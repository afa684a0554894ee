"""Parts of an attribute table that hold none of the keys asked for are not read."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from shopmart.operators.eav import eav_pivot
from shopmart.plans import items as I
from shopmart.plans import orders as O
from shopmart.sources.fixture_star import _may_hold, raw_from_star

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return raw_from_star(spark, SF)


def test_may_hold():
    assert _may_hold("_qty", "_qty") and not _may_hold("_qty", "_qt") and not _may_hold("_qty", "_qty2")
    assert _may_hold("_delivered_%", "_delivered_1") and not _may_hold("_delivered_%", "_deliv")
    assert _may_hold("Xdelivered-9", I.DELIVERED_LIKE) and not _may_hold("_line_tax", I.DELIVERED_LIKE)
    assert _may_hold("_delivered_%", "%") and _may_hold("_returned_%", "_returned_%")


@pytest.mark.parametrize("table, keys", [("order_itemmeta", list(I.ITEM_KEYS)), ("postmeta", list(O.ORDER_KEYS)), ("postmeta", ["_original_stock", "_uvp"]),
                                         ("order_itemmeta", ["_qty", "_delivered_2", "_returned_1"]), ("postmeta", ["no such key"])])
def test_all_rows_of_the_keys(raw, table, keys):
    asked = F.col("meta_key").isin(keys)
    want, got = getattr(raw, table).where(asked), raw.attributes(table, keys).where(asked)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_numbers_are_not_derived_for_item_amounts(raw):
    plan = eav_pivot(raw.attributes("order_itemmeta", I.ITEM_KEYS), "order_item_id", I.ITEM_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "lineitem" in plan


def test_another_table_has_no_parts(raw):
    other = raw.order_itemmeta.where("meta_key = '_qty'")
    assert dataclasses.replace(raw, order_itemmeta=other).attributes("order_itemmeta", ["_delivered_1"]) is other
