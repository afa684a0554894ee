import dataclasses

import pytest
from pyspark.sql import functions as F

from shopmart.plans import loads
from shopmart.sources.fixture_star import RAW_TABLES, Raw


@pytest.fixture()
def raw(spark):
    def table(name):
        return spark.createDataFrame([(1, "a", None), (2, None, "b"), (2, None, "b")], f"{name}_id long, x string, y string")
    return Raw(**{t: table(t) for t in RAW_TABLES})


def test_rows_and_ids(spark, raw):
    assert sorted(map(tuple, loads.scan_snapshot(spark, raw).collect())) == sorted((t, 3, "5") for t in RAW_TABLES)
    none = Raw(**{t: df.limit(0) for t, df in raw.as_dict().items()})
    assert sorted(map(tuple, loads.scan_snapshot(spark, none).collect())) == sorted((t, 0, None) for t in RAW_TABLES)


@pytest.mark.parametrize("change", [
    lambda df: df.withColumn("y", F.lit(None).cast("string")),
    lambda df: df.select("terms_id", F.col("y").alias("x"), F.col("x").alias("y")),
    lambda df: df.withColumn("x", F.coalesce("x", F.lit(""))),
])
def test_a_changed_value_beside_the_id_fails(spark, raw, monkeypatch, change):
    read = loads.read_raw
    monkeypatch.setattr(loads, "read_raw", lambda *a: (lambda r: dataclasses.replace(r, terms=change(r.terms)))(read(*a)))
    with pytest.raises(Exception, match="snapshot of terms is not what was staged"):
        loads.scan_snapshot(spark, raw).collect()


def test_sums_beyond_64_bits_are_exact(spark):
    ids = [2**63 - 1, 2**63 - 1, -5, -2**63, None, 7, 2**62]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert int(df.agg(loads._exact_sum(F.col("id"))).first()[0]) == sum(i for i in ids if i is not None)
    assert df.limit(0).agg(loads._exact_sum(F.col("id"))).first()[0] is None
