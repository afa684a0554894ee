"""A worker hands parsed rows on in batches, however many statements it is given at once."""

import os

from shopmart.sources import sqldump


def test_parsed_rows_are_handed_on(spark, tmp_dir, monkeypatch):
    p = os.path.join(tmp_dir, "dump.sql")
    with open(p, "w") as f:
        for s in range(50):
            f.write("INSERT INTO `t` VALUES " + ",".join(f"({s * 10 + i},'v')" for i in range(10)) + ";\n")
    sizes = []
    real = spark.createDataFrame([], "a int").__class__.mapInPandas

    def spied(df, parse, schema, *a, **k):
        def run(batches):
            for out in parse(batches):
                yield out.assign(a=str(len(out)))
        return real(df, run, schema, *a, **k)

    monkeypatch.setattr(spark.createDataFrame([], "a int").__class__, "mapInPandas", spied)
    monkeypatch.setattr(sqldump, "ROWS_A_BATCH", 30)
    rows, errors = sqldump.load_sql_dump(spark, p, "t", ["a", "b"])
    sizes = [int(r.a) for r in rows.collect()]
    assert len(sizes) == 500 and max(sizes) <= 40 and errors.count() == 0
