"""Every registered query against its DuckDB oracle on the smallest test data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


def _names():
    from shopmart.plans import oracle, registry
    return [n for n in registry.queries() if n in oracle.oracle_sql()]


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as make
    return make(SF)


@pytest.fixture(scope="module")
def raw(spark):
    """The projection, staged once for all queries."""
    from shopmart.plans.loads import staged_raw
    from shopmart.sources.fixture_star import raw_from_star
    return staged_raw(spark, raw_from_star(spark, SF))


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, raw, name, monkeypatch):
    from oracle_check import compare
    from shopmart.plans import oracle, registry
    monkeypatch.setattr(registry, "raw_from_star", lambda _spark, _dir: raw)
    df = registry.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(oracle.oracle_sql()[name])
    d_cols = [d[0] for d in rel.description]
    assert compare(name, df.columns, s_rows, d_cols, rel.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "billing_address_id" in df.columns
