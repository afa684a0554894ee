"""The pipeline, stage by stage, against brute-force versions on the smallest tables."""

import importlib
from collections import Counter

import pytest

from shopmart.llm._store import stored
from shopmart.llm.queries import queries
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_line_dedup import brute_long as brute_lines
from tests.llm.test_simhash import brute_components, brute_print

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in pipeline.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF))
    return pipeline, {k: sorted(v.collect(), key=lambda r: r.doc_id) for k, v in out.items()}, out


def test_quality(spark, stages):
    _, rows, _ = stages
    judged = {r.doc_id: r.predicted for r in queries()["op7_quality_classifier"](spark, SF).collect()}
    assert rows["quality classifier"] == [r for r in rows["documents"] if judged[r.doc_id] == 1]
    assert 0 < len(rows["quality classifier"]) < len(rows["documents"])


def test_line_dedup(stages):
    _, rows, _ = stages
    before, after = rows["quality classifier"], rows["line dedup"]
    want = [w[1] for w in brute_lines([r.text for r in before], 2, 20)]
    assert [tuple(r) for r in after] == [(r.doc_id, t, r.lang, r.source, len(t)) for r, t in zip(before, want)]


def test_near_dedup(stages):
    _, rows, _ = stages
    before, after = rows["line dedup"], rows["SimHash near-dedup"]
    groups = brute_components([brute_print(r.text) for r in before], [r.doc_id for r in before])
    assert after == [r for r, g in zip(before, groups) if g == r.doc_id]
    assert len(after) < len(before)


def test_decontamination(spark, stages):
    _, rows, _ = stages
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = []
    for r in rows["SimHash near-dedup"]:
        n, hit, _, spans = brute_hits(r.text, items, 13)
        if not (hit and 20 * hit >= n):
            raw = r.text.encode()
            text = b"".join(raw[a:b] for a, b in zip([0, *spans[1::2]], [*spans[::2], len(raw)])).decode()
            want.append((r.doc_id, text, r.lang, r.source, len(text)))
    assert [tuple(r) for r in rows["benchmark decontamination"]] == want


def test_mixing(stages):
    _, rows, frames = stages
    before = {r.doc_id: r for r in rows["benchmark decontamination"]}
    assert all(before[r.doc_id] == tuple(r)[:5] for r in rows["mixing"])
    assert 0 < len(rows["mixing"]) < len(before)
    assert frames["mixing"].columns == [*COLUMNS, "topic", "probability"]


def test_run_is_all_stages(spark, stages):
    pipeline, rows, _ = stages
    got = pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows["mixing"])
    assert [n for n, _ in pipeline.STAGES] == list(rows)[1:]
