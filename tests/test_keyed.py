"""Keyed tables, snapshot differences, optimistic commits, checks by changes, dump statements in order."""

import random

import pytest
from pyspark.sql import functions as F

from shopmart.operators.changes import change_counts, changed_rows, snapshot_changes
from shopmart.operators.load import TableSpec, check_changes, check_keys, upsert
from shopmart.sources import keyed
from shopmart.sources.commits import Conflict, newest, put_new
from shopmart.sources.sqldump import in_order, statement_mode
from shopmart.sources.tables import manifest, publish, read_current, read_table, stage, write_version

SCHEMA = "id long, part long, name string, v int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def some(rng, n, none=0.05):
    return [(rng.randrange(200), None if rng.random() < none else rng.randrange(3), rng.choice(["a", "", None, "x"]), rng.randrange(9)) for _ in range(n)]


def test_upsert_of_changed_buckets_is_the_plain_upsert(spark, tmp_dir):
    rng = random.Random(1)
    base = list({r[:2]: r for r in some(rng, 300, 0)}.values()) + [(1, None, "n", 1), (1, None, "n", 1)]
    target = frame(spark, base)
    before = keyed.create(target, f"{tmp_dir}/t", ["id", "part"], 16)
    source = frame(spark, [(3, 1, "new", 7), (3, 1, "newer", 8), (900, 0, "", 5), (1, None, "again", 2)])
    after = keyed.upsert_changed(source, f"{tmp_dir}/t", ["id", "part", "v"])
    assert rows_of(after.read(spark)) == rows_of(upsert(target, source, ["id", "part"], ["id", "part", "v"]))
    assert rows_of(before.read(spark)) == rows_of(target)  # the old version is still there
    assert rows_of(keyed.version(spark, f"{tmp_dir}/t", 1).read(spark)) == rows_of(target)
    kept, new = keyed.rewritten(before, after)
    assert len(new) <= 3 and len(kept) >= 12
    # the buckets carried over are not read for a load
    files = before.read(spark, new).inputFiles()
    assert files and all(any(f"_bucket={b}/" in f for b in new) for f in files)
    # an empty source changes nothing
    none = keyed.upsert_changed(source.limit(0), f"{tmp_dir}/t")
    assert keyed.rewritten(after, none) == (sorted(int(b) for b in after.parts), [])


def test_interleaved_loads_of_a_keyed_table(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/t"
    keyed.create(frame(spark, [(i, 0, "old", 0) for i in range(100)]), root, ["id", "part"], 8)
    real, other = keyed._written, []

    def between(rows, *a):
        made = real(rows, *a)
        if not other:  # a second load reads the same version and commits first
            other.append(True)
            keyed.upsert_changed(frame(spark, [(i, 0, "second", 2) for i in range(0, 100, 2)]), root)
        return made

    monkeypatch.setattr(keyed, "_written", between)
    keyed.upsert_changed(frame(spark, [(i, 0, "first", 1) for i in range(0, 100, 5)]), root)
    got = {r.id: r.name for r in keyed.version(spark, root).read(spark).collect()}
    assert got == {i: "first" if i % 5 == 0 else "second" if i % 2 == 0 else "old" for i in range(100)}
    assert keyed.version(spark, root).number == 3


def test_loads_into_other_buckets_both_stand(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/t"
    rows = frame(spark, [(i, 0, "old", 0) for i in range(100)])
    keyed.create(rows, root, ["id", "part"], 8)
    bucket = {r.id: r.b for r in rows.select("id", keyed.bucket_of(["id", "part"], 8).alias("b")).collect()}
    a, b = [next(i for i, x in bucket.items() if x == n) for n in (1, 2)]
    real, calls = keyed._written, []

    def between(made, *args):
        calls.append(1)
        out = real(made, *args)
        if len(calls) == 1:
            keyed.upsert_changed(frame(spark, [(b, 0, "second", 2)]), root)
        return out

    monkeypatch.setattr(keyed, "_written", between)
    keyed.upsert_changed(frame(spark, [(a, 0, "first", 1)]), root)
    got = {r.id: r.name for r in keyed.version(spark, root).read(spark).collect()}
    assert (got[a], got[b]) == ("first", "second") and len(calls) == 2  # nothing was done again


def test_manifests_are_never_replaced(spark, tmp_dir):
    assert put_new(spark, f"{tmp_dir}/m/000001.json", "{}") and not put_new(spark, f"{tmp_dir}/m/000001.json", '{"x": 1}')
    assert newest(spark, f"{tmp_dir}/m") == (1, {}) and newest(spark, f"{tmp_dir}/none") == (0, {})


def test_publish_against_a_second_writer(spark, tmp_dir):
    out = f"{tmp_dir}/out"

    def staged(n, tag, *names):
        return {t: stage(spark.range(n).toDF("id"), f"{out}/{t}", tag) for t in names}

    publish(spark, out, staged(1, "x", "a", "b"))
    base = manifest(spark, out)
    publish(spark, out, staged(2, "y", "a"), base)
    publish(spark, out, staged(3, "z", "b"), base)  # another table: both stand
    assert [read_table(spark, out, t).count() for t in ("a", "b")] == [2, 3]
    with pytest.raises(Conflict):
        publish(spark, out, staged(4, "w", "a", "b"), base)
    assert [read_table(spark, out, t).count() for t in ("a", "b")] == [2, 3]
    assert read_table(spark, out, "a", at=base).count() == 1


def test_a_table_on_its_own(spark, tmp_dir):
    assert read_current(spark, f"{tmp_dir}/t") is None
    write_version(spark.range(3), f"{tmp_dir}/t")
    write_version(read_current(spark, f"{tmp_dir}/t").where("id > 0"), f"{tmp_dir}/t")
    assert read_current(spark, f"{tmp_dir}/t").count() == 2


def test_stored_versions_read_as_one(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    one = frame(spark, [(i, 0, "a", 1) for i in range(40)]).drop("v")
    keyed.create(one, root, ["id"], 4, schema_version=1)
    keyed.evolve_stored(spark, root, frame(spark, []).schema, 2)
    assert {r.v for r in keyed.version(spark, root).read(spark).collect()} == {None}
    keyed.upsert_changed(frame(spark, [(0, 0, "b", 5)]), root)
    now = keyed.version(spark, root)
    assert sorted(p["schema_version"] for p in now.parts.values()) == [1, 1, 1, 2]
    assert {(r.id, r.name, r.v) for r in now.read(spark).where("id < 2").collect()} == {(0, "b", 5), (1, "a", None)}
    with pytest.raises(ValueError):
        keyed.evolve_stored(spark, root, one.schema, 3)


def test_snapshot_changes_against_brute_force(spark):
    rng = random.Random(2)
    old = some(rng, 250)
    new = [r if rng.random() < 0.8 else (*r[:3], r[3] + 1) for r in old if rng.random() < 0.9] + some(rng, 30)
    want = {}
    for side, rows in enumerate((old, new)):
        for r in rows:
            want.setdefault(r[:2], ([], []))[side].append(r)
    kind = {k: "inserted" if not a else "deleted" if not b else "same" if sorted(a, key=str) == sorted(b, key=str) else "changed" for k, (a, b) in want.items()}
    o, n = frame(spark, old).repartition(3), frame(spark, new).repartition(5)
    got = snapshot_changes(o, n, ["id", "part"])
    assert {(r.id, r.part): r.change for r in got.collect()} == kind and got.count() == len(kind)
    assert {r.change: r.n for r in change_counts(got).collect()} == {c: list(kind.values()).count(c) for c in ("inserted", "changed", "deleted", "same")}
    assert rows_of(changed_rows(o, n, ["id", "part"])) == sorted((r for r in new if kind[r[:2]] in ("inserted", "changed")), key=str)
    assert {r.n for r in change_counts(snapshot_changes(o.limit(0), n.limit(0), ["id"])).collect()} == {0}


def test_checks_by_changes(spark):
    rng = random.Random(3)
    parent = spark.createDataFrame([(i,) for i in range(60)], "id long")
    child = spark.createDataFrame([(i, None if i % 17 == 0 else rng.randrange(60)) for i in range(500)], "id long, parent_id long")
    specs = [TableSpec("parent", parent.schema, key=["id"]), TableSpec("child", child.schema, key=["id"], foreign_keys=[(["parent_id"], "parent", ["id"])])]
    clean = check_keys({"parent": parent, "child": child}, specs)
    assert clean.count() == 0
    # the load: rows with parents that are not there, a repeated key, and parents taken away
    new = spark.createDataFrame([(1000, 7), (1001, 999), (1002, 5), (1002, 6), (3, 8), (None, 4), (1003, 12)], child.schema)
    gone = parent.where("id % 10 = 2")
    after = {"parent": parent.where("id % 10 <> 2"), "child": child.unionByName(new)}
    full = check_keys(after, specs)
    assert full.count() > 10
    some = check_changes(after, specs, {"child": new}, {"parent": gone})
    assert rows_of(some) == rows_of(full)
    assert "BloomFilter" in check_changes.__doc__ or "Bloom" in check_changes.__doc__
    # without changes nothing is reported
    assert check_changes(after, specs, {"child": new.limit(0)}).count() == 0


def replay(rows):
    """(mode, key, value) one after the other."""
    table, twice = {}, []
    for mode, key, value in rows:
        if key is None:
            table[len(table), None] = (key, value)
        elif (key in table) and mode == "insert":
            twice.append((key, value))
        elif key not in table or mode == "replace":
            table[key] = (key, value)
    return sorted(table.values(), key=str), sorted(twice, key=str)


def test_statements_in_order(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["insert", "ignore", "replace"]), None if rng.random() < 0.02 else rng.randrange(60), i) for i in range(500)]
    df = spark.createDataFrame([(k, v, m, (v // 50, v)) for m, k, v in rows], "id long, v long, _mode string, _at struct<file:long,n:long>").repartition(6)
    out, twice = in_order(df, ["id"])
    assert (rows_of(out), rows_of(twice)) == replay(rows)
    assert [statement_mode(s) for s in ("INSERT INTO t", "-- x\nreplace into t", "INSERT LOW_PRIORITY IGNORE INTO t", "/* a */ INSERT  IGNORE t")] == ["insert", "replace", "ignore", "ignore"]


def test_lookup_rows_do_not_meet_under_null(spark):
    """Rows that look up nothing have join keys of their own."""
    from shopmart.plans import products as P
    from shopmart.sources.fixture_star import raw_from_star
    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = P.variation_attributes(raw)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(_slug" in plan and "hashpartitioning(CASE" not in plan
    rows = raw.postmeta.where(F.col("meta_key") == P.CONDITION_KEY)
    assert rows.count() > 0
    got = P.variation_attributes(raw)
    assert got.where("item_condition IS NOT NULL").count() == rows.where("meta_value IS NOT NULL").select("post_id").distinct().count()
