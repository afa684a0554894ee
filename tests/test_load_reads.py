"""What the load queries compute: once what is read twice, and only what is read."""

import time

import pytest
from pyspark.sql import functions as F

from shopmart.operators.changes import snapshot_changes
from shopmart.plans import daily, loads, registry
from shopmart.session import FREED, SPLIT, SPLIT_BYTES
from shopmart.sources.fixture_star import raw_from_star

SF = "/root/testdata/sf0.001"


def _tables_in(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [t for t in ("lineitem.parquet", "orders.parquet") if t in plan]


@pytest.mark.parametrize("name, expected", [("upsert_single_key", "id"), ("upsert_compound_key", "order_item_id")])
def test_upserts_read_a_stored_table(spark, name, expected):
    df = registry.queries()[name](spark, SF)
    assert _tables_in(df) == [] and expected in df.columns


def test_sorted_files_are_written_from_a_stored_table(spark, monkeypatch):
    written = []
    real = loads.write_sorted
    monkeypatch.setattr(loads, "write_sorted", lambda df, *a, **k: (written.append(_tables_in(df)), real(df, *a, **k)))
    registry.queries()["orders_sorted_files"](spark, SF).collect()
    assert written == [[]]


def test_the_second_day_is_staged_from_the_first(spark, monkeypatch):
    staged, real = [], loads.stage_snapshot

    def stage(raw, root, day, **how):
        staged.append({t for df in raw.as_dict().values() for t in _tables_in(df)})
        real(raw, root, day, **how)

    monkeypatch.setattr(loads, "stage_snapshot", stage)
    monkeypatch.setattr(loads, "run_day", lambda *a, **k: (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        registry.queries()["run_day"](spark, SF)
    assert staged == [{"lineitem.parquet", "orders.parquet"}, set()]


def test_items_read_each_text_once(spark):
    plan = registry.queries()["order_items"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("regexp_extract(") <= 2 * 9  # the second only where the first gives no number


def test_a_scanned_snapshot_is_not_derived_again(spark):
    assert _tables_in(registry.queries()["scan_snapshot"](spark, SF)) == []


@pytest.mark.parametrize("name", ["refresh_lookups", "snapshot_changes"])
def test_raw_tables_are_not_stored_once_more(spark, monkeypatch, name):
    stored = []
    monkeypatch.setattr(loads, "staged_raw", lambda s, raw: stored.append(name) or raw)
    registry.queries()[name](spark, SF)
    assert stored == []


@pytest.mark.parametrize("name", ["unique_violations", "fk_violations", "changed_key_report", "upsert_many_report"])
def test_data_sets_are_made_from_the_parts_that_they_read(spark, monkeypatch, name):
    raw, tables, real = [], [], loads.stage_tables
    monkeypatch.setattr(loads, "staged_raw", lambda s, r: raw.append(name) or r)
    monkeypatch.setattr(loads, "stage_tables", lambda s, t: tables.append([k for k, df in t.items() if _tables_in(df)]) or real(s, t))
    registry.queries()[name](spark, SF)
    assert raw == [] and tables[0] == ["order_attributes", "order_items"]  # stored once, read several times


def test_items_are_dealt_once(spark):
    """The lines are shuffled by their item, and neither by order and line nor again for the window of the numbered attributes."""
    df = registry.queries()["order_items"](spark, SF)
    assert "RepartitionByExpression [order_item_id" in df._jdf.queryExecution().optimizedPlan().toString()
    moved = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x]
    assert moved and not any("(l_orderkey" in x or "subqty#" in x for x in moved)


def test_address_parts_are_not_shuffled_for_the_orders(spark):
    attrs = loads.stage_tables(spark, {"attrs": loads.O.order_attributes(raw_from_star(spark, SF))})["attrs"]
    plan = loads.O.orders_fact(raw_from_star(spark, SF), attributes=attrs)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join"):]
    assert below.count("sha1(") == 2 and "sha1(" not in plan[:plan.index("Join")]


def test_shuffles_of_stored_tables_are_freed(spark):
    disk = spark._jsc.sc().env().blockManager().diskBlockManager()

    def files():
        return {f.getName() for f in (disk.getAllFiles().apply(i) for i in range(disk.getAllFiles().size())) if f.getName().startswith("shuffle_")}

    before = files()
    made = loads.stage_tables(spark, {"t": spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()})["t"]
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and made.count() == 7
    assert spark.conf.get(FREED, None) is None  # for writes only: this is collected twice
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert df.collect() == df.collect()


def test_two_snapshots_meet_in_one_shuffle(spark):
    old = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, None, 6), (3, "c", 7), (4, "d", 8)], "id long, part string, v long")
    new = spark.createDataFrame([(1, "a", 6), (1, "a", 4), (2, None, 6), (4, "d", 8), (4, "d", 8), (5, "e", 9)], "id long, part string, v long")
    df = snapshot_changes(old, new, ["id", "part"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and sum("Exchange" in x for x in plan.splitlines()) == 1
    assert {r.id: r.change for r in df.collect()} == {1: "changed", 2: "same", 3: "deleted", 4: "changed", 5: "inserted"}


def test_tables_of_two_snapshots_are_compared_one_by_one(spark, monkeypatch):
    tables, real = [], loads.stage_tables
    monkeypatch.setattr(loads, "stage_tables", lambda s, t: tables.extend(t) or real(s, t))
    assert len(registry.queries()["snapshot_changes"](spark, SF).collect()) == 40
    assert len(tables) == 10


def test_a_day_is_read_in_small_splits(spark, monkeypatch):
    """A stored attribute row takes far more memory than it takes of a file."""
    seen = []
    monkeypatch.setattr(daily, "_run_once", lambda spark, *a: seen.append(spark.conf.get(SPLIT)) or seen)
    before = spark.conf.get(SPLIT)
    assert daily.run_day(spark, "/none", "/none", "2017-01-22") is seen
    assert seen == [str(SPLIT_BYTES)] and spark.conf.get(SPLIT) == before
