"""The daily load over staged snapshots: reverse order, modes, faults."""

import os

import pytest
from pyspark.sql import functions as F

from shopmart.plans import daily
from shopmart.plans.daily import backfill, run_day
from shopmart.sources import tables
from shopmart.sources.fixture_star import raw_from_star
from shopmart.sources.snapshot import read_raw, stage_snapshot
from shopmart.sources.tables import manifest, publish, read_table, stage, versions

SF = "/root/testdata/sf0.001"
KW = dict(cutoff="1996-01-01", excluded_products=(7300, 1000003), excluded_parents=(1000003, 1000007),
          fail_on_violations=False)


@pytest.fixture(scope="module")
def raw_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    raw = raw_from_star(spark, SF)
    stage_snapshot(raw, root, "2017-01-22")
    # the next day: all orders have another payment method
    raw = read_raw(spark, root, "2017-01-22")
    meta = raw.postmeta.withColumn("meta_value", F.when(F.col("meta_key") == "_payment_method", "new").otherwise(F.col("meta_value")))
    stage_snapshot(type(raw)(**{**raw.as_dict(), "postmeta": meta}), root, "2017-01-23")
    return root


def test_stock_only_then_full_backfill_keeping_the_newest(spark, raw_root, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    days = ["2017-01-23", "2017-01-22"]
    kw = dict(KW, order_by="snapshot_date")
    assert backfill(spark, raw_root, out, days[1], days[0], stock_only=True, **kw) == days
    assert manifest(spark, out) == (0, {})
    # the legacy run does not mark the full one as done
    assert backfill(spark, raw_root, out, days[1], days[0], **kw) == days
    assert versions(spark, os.path.join(out, "orders")) == [1, 2]
    orders = read_table(spark, out, "orders")
    assert orders.count() == orders.select("id").distinct().count() > 0
    # the older day came last and changed nothing
    assert {r[0] for r in orders.select("payment_method").distinct().collect()} <= {"new", "NONE"}
    customers = read_table(spark, out, "customers")
    assert customers.where("last_billing_address_id IS NOT NULL").count() > 0
    stock = spark.read.parquet(os.path.join(out, "stock"))
    n_orders, n_stock = orders.count(), stock.count()
    assert stock.select("record_date").distinct().count() == 2
    # a rerun of a finished date: tables keep their row counts, stock is not doubled
    run_day(spark, raw_root, out, "2017-01-23", **kw)
    assert read_table(spark, out, "orders").count() == n_orders
    assert spark.read.parquet(os.path.join(out, "stock")).count() == n_stock
    assert backfill(spark, raw_root, out, days[1], days[0], **kw) == []


def test_publish_is_one_unit(spark, tmp_dir, monkeypatch):
    out = os.path.join(tmp_dir, "out")

    def staged(n):
        return {t: stage(spark.range(n).toDF("id"), f"{out}/{t}", "x") for t in ("a", "b")}

    publish(spark, out, staged(1))
    real, moved = tables._place, []

    def failing(spark, root, path):
        if moved:
            raise OSError("lost")
        moved.append(root)
        return real(spark, root, path)

    monkeypatch.setattr(tables, "_place", failing)
    with pytest.raises(OSError):
        publish(spark, out, staged(2))
    assert [read_table(spark, out, t).count() for t in ("a", "b")] == [1, 1]  # one version moved, none published
    monkeypatch.setattr(tables, "_place", real)
    publish(spark, out, staged(3))
    assert [read_table(spark, out, t).count() for t in ("a", "b")] == [3, 3]


def test_rejects_are_reported_and_stop_the_load(spark, raw_root, tmp_dir):
    out, root = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "raw")
    raw = read_raw(spark, raw_root, "2017-01-22")
    wide = F.when((F.col("meta_key") == "_order_total") & (F.col("post_id") % 10 == 3), "1234567.00").otherwise(F.col("meta_value"))
    stage_snapshot(type(raw)(**{**raw.as_dict(), "postmeta": raw.postmeta.withColumn("meta_value", wide)}), root, "2017-01-22")
    with pytest.raises(RuntimeError, match="violations"):
        run_day(spark, root, out, "2017-01-22", **{**KW, "fail_on_violations": True})
    assert manifest(spark, out) == (0, {}) and not os.path.exists(os.path.join(out, "_run_log"))
    report = run_day(spark, root, out, "2017-01-22", **KW)
    n = report.where("rule = 'range' AND `table` = 'orders'").count()
    assert n > 0 and spark.read.parquet(os.path.join(out, "_rejects/orders")).count() == n
    assert daily.TASK != daily.STOCK_TASK
