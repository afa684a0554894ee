import datetime
import os

import pytest
from pyspark.sql import functions as F

from shopmart.operators.backfill import pending_dates
from shopmart.operators.load import (TableSpec, align, align_overflow, check_keys, dedupe_last, evolve,
                                     split_overflow, upsert, upsert_one)
from shopmart.operators.snapshot import append_snapshot
from shopmart.sources.csv_io import read_csv_checked, write_csv
from shopmart.sources.sqldump import load_sql_dump, parse_values

T = "id long, name string, note string, extra string"


def _key(r):
    return [(v is None, str(v)) for v in r]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def test_upsert_cases(spark):
    target = spark.createDataFrame([(1, "a", "n1", "keep"), (2, "b", "n2", "keep2")], T)
    source = spark.createDataFrame([(2, "B", ""), (3, "c", "n3")], "id long, name string, note string")
    got = _rows(upsert(target, source, "id", ["id", "name", "note"]))
    # changed key updated ('' -> NULL), unchanged key kept, new key inserted, unlisted column kept
    assert got == [(1, "a", "n1", "keep"), (2, "B", None, "keep2"), (3, "c", "n3", None)]


def test_upsert_twice_is_once_and_keys_unique(spark):
    target = spark.createDataFrame([(1, "a", "n1", "x")], T)
    source = spark.createDataFrame([(1, "z", "q"), (4, "d", "n4")], "id long, name string, note string")
    once = upsert(target, source, "id", ["id", "name", "note"])
    twice = upsert(once, source, "id", ["id", "name", "note"])
    assert _rows(once) == _rows(twice)
    assert twice.groupBy("id").count().where("count > 1").count() == 0


def test_upsert_last_row_wins_by_order(spark):
    target = spark.createDataFrame([], T)
    src = spark.createDataFrame([(1, "old", "n", 1), (1, "new", "n", 2)], "id long, name string, note string, v int")
    got = _rows(upsert(target, src, "id", ["id", "name", "note"], order_by="v"))
    assert got == [(1, "new", "n", None)]


def test_reverse_backfill_both_modes(spark):
    # day 2 loaded first, then the older day 1 (newest-first backfill)
    day2 = spark.createDataFrame([(1, "v2", "n", datetime.date(2017, 1, 2))], "id long, name string, note string, snap date")
    day1 = spark.createDataFrame([(1, "v1", "n", datetime.date(2017, 1, 1))], "id long, name string, note string, snap date")
    empty = spark.createDataFrame([], T + ", snap date")
    after2 = upsert(empty, day2, "id", ["id", "name", "note", "snap"])
    blind = upsert(after2, day1, "id", ["id", "name", "note", "snap"])
    assert _rows(blind.select("name")) == [("v1",)]            # last run wins (shop behaviour)
    newest = upsert(after2, day1, "id", ["id", "name", "note", "snap"], order_by="snap")
    assert _rows(newest.select("name")) == [("v2",)]           # newest snapshot wins
    forward = upsert(upsert(empty, day1, "id", ["id", "name", "note"], order_by="snap"), day2, "id", ["id", "name", "note"], order_by="snap")
    assert _rows(forward.select("name", "snap")) == [("v2", datetime.date(2017, 1, 2))]  # the order column moves along


def test_keep_newest_nulls_and_ties(spark):
    t = spark.createDataFrame([(1, "t", None), (2, "t", 5), (3, "t", 5), (4, "t", 5)], "id long, v string, o int")
    s = spark.createDataFrame([(1, "s", None), (2, "s", None), (3, "s", 5), (4, "s", 4), (5, "s", None)], "id long, v string, o int")
    got = _rows(upsert(t, s, "id", ["id", "v", "o"], order_by="o").select("id", "v"))
    assert got == [(1, "s"), (2, "t"), (3, "s"), (4, "t"), (5, "s")]


def test_upsert_scans_source_and_target_once(spark, tmp_dir):
    spark.range(100).selectExpr("id", "cast(id as string) v", "id % 7 o").write.parquet(os.path.join(tmp_dir, "target"))
    spark.range(50, 150).selectExpr("if(id % 9 = 0, null, id) id", "'s' v", "id % 5 o").write.parquet(os.path.join(tmp_dir, "source"))
    t, s = (spark.read.parquet(os.path.join(tmp_dir, n)) for n in ("target", "source"))
    out = upsert(t, s, "id", ["id", "v", "o"], order_by="o")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/source]") == 1 and plan.count("/target]") == 1, plan
    assert out.count() == 100 + sum(1 for i in range(50, 150) if i % 9 == 0 or i >= 100)


def test_upsert_compound_and_null_keys(spark):
    target = spark.createDataFrame([(1, 1, "a")], "a long, b long, v string")
    src = spark.createDataFrame([(1, 1, "A"), (1, None, "n1"), (1, None, "n2"), (2, 1, "c")], "a long, b long, v string")
    got = _rows(upsert(target, src, ["a", "b"], ["a", "b", "v"]))
    assert got == sorted([(1, 1, "A"), (1, None, "n1"), (1, None, "n2"), (2, 1, "c")], key=_key)


def test_upsert_empty_source_and_target(spark):
    t = spark.createDataFrame([(1, "a", "n", "x")], T)
    empty_src = spark.createDataFrame([], "id long, name string, note string")
    assert _rows(upsert(t, empty_src, "id", ["id", "name", "note"])) == [(1, "a", "n", "x")]
    with pytest.raises(ValueError):
        upsert_one(t, empty_src, "id", None)


def test_dedupe_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y"), (1, "a"), (1, "b")], "k long, v string")
    assert len(dedupe_last(df, "k").collect()) == 3


def test_check_keys(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None), (12, 2)], "cid long, pid long")
    specs = [TableSpec("p", parent.schema, key=["id"]),
             TableSpec("c", child.schema, key=["cid"], foreign_keys=[(["pid"], "p", ["id"])])]
    v = check_keys({"p": parent, "c": child}, specs)
    rules = sorted((r.table, r.rule) for r in v.collect())
    assert rules == [("c", "c(pid) -> p(id)"), ("c", "unique(cid)")]


def test_check_keys_needs_the_parent(spark):
    child = spark.createDataFrame([(10, 1)], "cid long, pid long")
    with pytest.raises(ValueError, match="parent table p"):
        check_keys({"c": child}, [TableSpec("c", child.schema, foreign_keys=[(["pid"], "p", ["id"])])])


def test_align_overflow(spark):
    spec = TableSpec("t", spark.createDataFrame([], "id int, money decimal(8,2)").schema)
    df = spark.createDataFrame([(1, 5.0), (3_000_000_000, 1.0), (2, 1e7), (None, None)], "id long, money double")
    with pytest.raises(Exception, match="out of range"):
        align(df, spec).collect()
    assert sorted(map(tuple, align_overflow(df, spec).collect())) == [("id", 1), ("money", 1)]
    fits, rejects = split_overflow(df, spec)
    assert align(fits, spec).count() == 2
    assert sorted(tuple(r._overflow) for r in rejects.collect()) == [("id",), ("money",)]
    assert align(df, spec, on_overflow="null").where("id IS NULL").count() == 2


def test_csv_without_line_breaks_is_split(spark, tmp_dir):
    p = os.path.join(tmp_dir, "wide")
    df = spark.range(20000).selectExpr("cast(id as int) id", "repeat('x', 50) a").coalesce(1)
    write_csv(df, p)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        back = read_csv_checked(spark, p, df.schema)
        assert back.rdd.getNumPartitions() > 5 and back.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_evolve_adds_null_columns(spark):
    from shopmart.plans import schemas
    v1 = spark.createDataFrame([], schemas.VERSIONS["products"][0])
    v4 = evolve(v1, schemas.VERSIONS["products"], 1, 4)
    assert v4.columns == schemas.VERSIONS["products"][3].fieldNames()
    with pytest.raises(ValueError, match="does not exist"):
        evolve(v1, schemas.VERSIONS["campaign_trackings"], 1, 4)


def test_append_snapshot_rerun_does_not_double(spark, tmp_dir):
    df = spark.createDataFrame([(1, 5, 0), (2, 7, 3)], "product_id long, stock long, purchased_stock long")
    p = os.path.join(tmp_dir, "stock")
    append_snapshot(df, p, "2017-01-22")
    append_snapshot(df, p, "2017-01-23")
    append_snapshot(df, p, "2017-01-23")
    back = spark.read.parquet(p)
    assert back.count() == 4
    assert back.groupBy("record_date").count().count() == 2


def test_pending_dates_newest_first(spark):
    log = spark.createDataFrame([("t", datetime.date(2017, 1, 2), datetime.datetime(2017, 1, 3))],
                                "task string, run_date date, finished_at timestamp_ntz")
    got = [r.run_date for r in pending_dates(spark, "2017-01-01", "2017-01-04", log, "t").collect()]
    assert got == [datetime.date(2017, 1, 4), datetime.date(2017, 1, 3), datetime.date(2017, 1, 1)]


def test_csv_round_trip_special_text(spark, tmp_dir):
    rows = [(1, 'a,b', 'say "hi"'), (2, "line\nbreak", "ümlaut"), (3, None, "")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    p = os.path.join(tmp_dir, "csv")
    write_csv(df, p)
    back = sorted((tuple(r) for r in read_csv_checked(spark, p, df.schema, multi_line=True).collect()), key=_key)
    assert back == [(1, "a,b", 'say "hi"'), (2, "line\nbreak", "ümlaut"), (3, None, None)]


def test_csv_wrong_header_and_repeated_name(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x")], "id int, a string")
    p = os.path.join(tmp_dir, "csv2")
    write_csv(df, p)
    wrong = spark.createDataFrame([], "id int, b string").schema
    with pytest.raises(Exception):
        read_csv_checked(spark, p, wrong).collect()
    with pytest.raises(ValueError):
        write_csv(spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "a"), p + "x")


def test_sql_dump_reader(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dump.sql")
    with open(p, "w") as f:
        f.write("DROP TABLE IF EXISTS `t`;\n")
        f.write("INSERT INTO `t` VALUES (1,'a;b','it\\'s'),(2,NULL,'x\\ny');\n")
        f.write("INSERT INTO `other` VALUES (9,'z','z');\n")
        f.write("INSERT INTO `t` VALUES (3,'broken);\n")
        f.write("\n")
    rows, errors = load_sql_dump(spark, p, "t", ["id", "a", "b"])
    assert sorted((tuple(r) for r in rows.collect()), key=_key) == [("1", "a;b", "it's"), ("2", None, "x\ny")]
    assert errors.count() == 1
    with pytest.raises(Exception):
        load_sql_dump(spark, p, "t", ["id", "a", "b"], strict=True)[0].collect()


def test_sql_dump_insert_forms(spark, tmp_dir):
    p = os.path.join(tmp_dir, "forms.sql")
    long = "x" * 3000
    with open(p, "w") as f:
        f.write("-- Dumping data for table `t`\n--\n/*!40000 ALTER TABLE `t` DISABLE KEYS */;\n")
        f.write("-- a comment with INSERT\n/*!40101 SET NAMES utf8 */ INSERT INTO t VALUES (1,'a',_binary 'b');\n")
        f.write("INSERT IGNORE INTO `shop`.`t` (`b`,`id`) VALUES (x'636166C3A9',2),(0x61,3);\n")
        f.write("replace into t VALUES (4,'it''s',NULL);\n")
        f.write("INSERT INTO t (id, wrong) VALUES (5,'x');\n")
        f.write("INSERT INTO t SET id=6;\n")
        f.write(f"INSERT INTO t VALUES (7,'{long});\n")
        f.write("INSERT INTO t VALUES (99999999999,'too wide','');\n")
        f.write("INSERT INTO t2 VALUES (8);\n")
    rows, errors = load_sql_dump(spark, p, "t", ["id", "a", "b"], schema=spark.createDataFrame([], "id int, a string, b string").schema)
    assert _rows(rows) == [(1, "a", "b"), (2, None, "café"), (3, None, "a"), (4, "it's", None)]
    bad = sorted(r.statement for r in errors.collect())
    assert len(bad) == 4 and any(long in b for b in bad) and any("99999999999" in b for b in bad)


def test_parse_values_width_check():
    assert parse_values("(1,'a')", 2) == [["1", "a"]]
    with pytest.raises(ValueError):
        parse_values("(1,'a')", 3)
