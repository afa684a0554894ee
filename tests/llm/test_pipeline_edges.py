"""Each stage on odd rows: nulls, empty and long texts, repeated rows, columns with clashing names, no rows."""

import importlib
import os
import shutil

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, kept boolean, rid long, topic int"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Labels and benchmark of the smallest tables beside odd rows of their own."""
    root = str(tmp_path_factory.mktemp("odd"))
    for t in ("labels", "benchmark"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        nulls = spark.createDataFrame([(None,) * len(df.columns)], df.schema)
        df.unionByName(nulls).unionByName(df.limit(3)).write.parquet(os.path.join(root, f"{t}.parquet"))
    shutil.copy(f"{SF}/documents.parquet", os.path.join(root, "documents.parquet"))
    return root


def rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    odd = [(None, None, None, None, None), (None, None, None, None, None), (9001, "", "en", "s", 0), (9002, " \n\t\n ", "en", None, 5),
           (9003, "x y z\n" * 20000, None, "s", 1), (None, "the same row here\nand a second line", "en", "s", 1), (9004, "ü", "de", "s", 1)]
    odd += [odd[5]] * 3 + [(9004, "ü", "de", "s", 1)]
    return [(*r, "clash", -1.0, False, 7, 3) for r in [*map(tuple, docs[:120]), *odd]]


def test_stages_on_odd_rows(spark, sf_dir):
    pipeline = importlib.import_module("corpus_pipeline")
    data = rows(spark)
    for name, stage in pipeline.STAGES:
        docs = spark.createDataFrame(data, SCHEMA).repartition(3)
        out = stage(spark, docs, sf_dir)
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
            assert {r["row"] for r in out.collect()} == {"clash"} and {r["rid"] for r in out.collect()} == {7}, name
        got = out.select("doc_id", "text").collect()
        assert 0 < len(got) <= len(data), name
        if name == "line dedup":
            assert len(got) == len(data)
        if name == "SimHash near-dedup":  # all wordless texts are one group, all equal rows another
            assert sum(not (r.text or "").split() for r in got) == 1
            assert len({r.text for r in got if r.text}) == len([r for r in got if r.text])


def test_stages_on_no_rows(spark, sf_dir):
    pipeline = importlib.import_module("corpus_pipeline")
    for name, stage in pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), sf_dir).count() == 0, name
