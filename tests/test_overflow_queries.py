"""Queries that align to the target schema, over orders whose money is beyond numeric(8,2)."""

import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

DAY = datetime.datetime(1999, 5, 1)


@pytest.fixture(scope="module")
def star_dir(spark, tmp_path_factory):
    """Orders of 0.6 million an item: with two items the subtotal does not fit."""
    d = str(tmp_path_factory.mktemp("star"))
    n = range(8)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "R")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(i, f"Customer#{i}", 0, 1.0, "BUILDING") for i in n]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(i, f"Supplier#{i}", 0, 1.0) for i in n]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(100 + i, f"red part {i}", "Brand#1", "SMALL", i, 10.0 + i) for i in n]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", [(i, i, "F", 100.0 + i, DAY, "1-URGENT") for i in n]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
                     [(i, 100 + i, i, line, 2.0, 600000.0 if i % 2 else 600.0, 0.1, 0.05, "N", "O", DAY) for i in n for line in (1, 2)]),
        "events": ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string", [(i, DAY, i, "click", 1.0, "{}") for i in n]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).toPandas().to_parquet(f"{d}/{name}.parquet", coerce_timestamps="us")
    return d


@pytest.fixture(scope="module")
def raw(spark, star_dir):
    from shopmart.plans.loads import staged_raw
    from shopmart.sources.fixture_star import raw_from_star
    return staged_raw(spark, raw_from_star(spark, star_dir))


@pytest.mark.parametrize("name", ["align_to_schema", "changed_key_report", "fk_violations", "schema_evolution_orders",
                                  "unique_violations", "upsert_changed_buckets", "upsert_many_report"])
def test_all_rows_with_money_out_of_range(spark, star_dir, raw, name, monkeypatch):
    from oracle_check import compare, duck
    from shopmart.plans import loads, oracle, registry
    monkeypatch.setattr(registry, "raw_from_star", lambda _spark, _dir: raw)
    monkeypatch.setattr(loads, "staged_raw", lambda _spark, staged: staged)
    df = registry.queries()[name](spark, star_dir)
    rows = [tuple(r) for r in df.collect()]
    rel = duck(star_dir).execute(oracle.oracle_sql()[name])
    assert compare(name, df.columns, rows, [c[0] for c in rel.description], rel.fetchall())
    if name == "align_to_schema":
        assert [r.subtotal for r in df.orderBy("id").collect()].count(None) == 4


def test_a_key_out_of_range_still_fails(spark):
    from shopmart.operators.load import TableSpec, align
    spec = TableSpec("t", spark.createDataFrame([], "id int, parent int, money decimal(8,2)").schema, key=["id"], foreign_keys=[(["parent"], "p", ["id"])])
    money = spark.createDataFrame([(1, 2, 1e7)], "id long, parent long, money double")
    assert [tuple(r) for r in align(money, spec, on_overflow="null_values").collect()] == [(1, 2, None)]
    for row in [(3_000_000_000, 2, 1.0), (1, 3_000_000_000, 1.0)]:
        with pytest.raises(Exception, match="out of range"):
            align(spark.createDataFrame([row], money.schema), spec, on_overflow="null_values").collect()
