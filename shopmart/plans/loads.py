"""Load steps over the data sets: upserts between two snapshot states, key
checks, alignment, schema evolution, snapshot appends, CSV and dump round
trips, backfill dates.  Writes go under the session's checkpoint folder."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.text import empty_to_null
from ..operators.backfill import pending_dates
from ..operators.changes import change_counts, changed_rows, snapshot_changes
from ..operators.load import align, align_overflow, check_changes, check_keys, evolve, upsert, upsert_many, upsert_one
from ..operators.snapshot import append_snapshot
from ..session import checkpoint_dir, freed_shuffles
from ..sources.csv_io import read_csv_checked, write_csv
from ..sources.fixture_star import Raw
from ..sources import keyed
from ..sources.snapshot import read_raw, read_sorted_ranges, stage_snapshot, write_sorted
from ..sources.sqldump import load_sql_dump, write_sql_dump, write_statements
from ..sources.tables import read_table
from . import items as I
from . import orders as O
from . import products as P
from . import schemas
from .daily import KEYS, run_day

# Scenario dates for the two-state upserts: the target is the reporting
# table as loaded from an older state (orders up to OLD_UNTIL, with the
# payment method not yet known), the source the newer extract (orders since
# NEW_FROM).  Keys overlap between NEW_FROM and OLD_UNTIL.
OLD_UNTIL = "2000-01-01"
NEW_FROM = "1998-01-01"
UPSERT_COLUMNS = ["id", "payment_method", "order_total", "order_tax"]


def scratch(spark: SparkSession, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def staged_raw(spark: SparkSession, raw: Raw) -> Raw:
    """The raw tables written once as a dated parquet snapshot under the
    checkpoint folder and read back: queries that build several data sets
    then scan parquet instead of re-deriving the raw tables in every branch."""
    root = scratch(spark, "raw")
    stage_snapshot(raw, root, "2017-01-22", files_per_table=spark.sparkContext.defaultParallelism)
    return read_raw(spark, root, "2017-01-22")


def stage_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write each table once under the checkpoint folder and read it back, so
    checks that look at a table several times (counts, unique keys, every
    foreign key it is child or parent of) scan parquet, not its whole plan."""
    out = {}
    for name, df in tables.items():
        path = scratch(spark, f"table-{name}")
        with freed_shuffles(spark):
            df.write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def upsert_single_key(raw: Raw, cutoff: str, facts: DataFrame | None = None) -> DataFrame:
    facts = O.orders_fact(raw, cutoff) if facts is None else facts
    target = facts.where(F.col("order_date") < F.lit(OLD_UNTIL).cast("timestamp_ntz")) \
                  .withColumn("payment_method", F.lit("unknown"))
    source = facts.where(F.col("order_date") >= F.lit(NEW_FROM).cast("timestamp_ntz"))
    return upsert(target, source, "id", UPSERT_COLUMNS)


def upsert_compound_key(raw: Raw, cutoff: str, excluded, items: DataFrame | None = None) -> DataFrame:
    items = I.order_items(raw, cutoff, excluded=excluded) if items is None else items
    target = items.where((F.col("delivered_on") < F.lit(OLD_UNTIL).cast("date")) | F.col("delivered_on").isNull()) \
                  .withColumn("is_retoure", F.lit(None).cast("boolean"))
    source = items.where(F.col("delivered_on") >= F.lit(NEW_FROM).cast("date"))
    return upsert(target, source, ["order_item_id", "subqty_id"],
                  ["order_item_id", "subqty_id", "delivered_on", "returned_on", "is_retoure", "product_id"])


def upsert_keep_newest(spark: SparkSession, raw: Raw, cutoff: str) -> DataFrame:
    """Orders of a target loaded on two days (22nd and 24th) meet a source of the
    23rd: only the rows that are older change."""
    facts = stage_tables(spark, {"orders": O.orders_fact(raw, cutoff).select("id", "customer_id", "payment_method", "order_total", "order_date")})["orders"]
    day = F.when(F.col("id") % 3 == 0, "2017-01-24").when(F.col("id") % 3 == 1, "2017-01-22").cast("date")
    target = facts.where(F.col("id") % 5 != 0).select("id", "customer_id", F.lit("target").alias("payment_method"), "order_total", day.alias("snapshot_date"))
    source = facts.where((F.col("id") % 2 == 0) | (F.col("id") % 5 == 0)).select("id", "customer_id", "payment_method", "order_total", F.lit("2017-01-23").cast("date").alias("snapshot_date"))
    return upsert(target, source, "id", ["id", "payment_method", "snapshot_date"], order_by="snapshot_date")


def upsert_one_table(raw: Raw) -> DataFrame:
    """Campaign trackings as one checked upsert: a third updated, a third inserted, a third untouched."""
    rows = P.campaign_trackings(raw)
    target = rows.where(F.col("id") % 3 != 0).withColumn("utm_medium", F.lit("old"))
    return upsert_one(target, rows.where(F.col("id") % 3 != 1), ["id"], P.CAMPAIGN_COLUMNS)


def overflow_counts(raw: Raw, cutoff: str) -> DataFrame:
    """Orders some of whose ids and amounts are beyond the target's types."""
    facts = O.orders_fact(raw, cutoff)
    far = F.when(F.col("id") % 7 == 0, F.col("id") + (1 << 31)).otherwise(F.col("id"))
    rich = F.when(F.col("id") % 5 == 0, (F.col("order_total") * 100).cast("decimal(12,2)")).otherwise(F.col("order_total").cast("decimal(12,2)"))
    return align_overflow(facts.withColumns({"id": far, "order_total": rich}), schemas.SPECS_LATEST["orders"])


def products(spark: SparkSession, raw: Raw, hosts) -> DataFrame:
    """Products over the stored lookups, as the daily load builds them."""
    lookups = P.refresh(raw, lambda name, df: stage_tables(spark, {name: df})[name])
    return P.products(raw, old_host=hosts[0], new_host=hosts[1], lookups=lookups)


def refresh_counts(spark: SparkSession, raw: Raw) -> DataFrame:
    """The stored lookups of the products load and their rows."""
    stored = P.refresh(raw, lambda name, df: stage_tables(spark, {name: df})[name])
    out = None
    for name, df in stored.items():
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("lookup"), "n")
        out = c if out is None else out.unionByName(c)
    return out


def data_sets(spark: SparkSession, raw: Raw, cutoff: str, excluded, stock_excluded, hosts) -> dict[str, DataFrame]:
    """All reporting tables of one snapshot, aligned to the latest schema.

    What several of them read (the pivot of the order attributes, the order
    items) is stored once; the attribute tables are read by their parts, so
    the raw tables are not all stored first.  Money beyond its column is NULL
    there, so every row takes part in the key checks; a key beyond its column
    fails the job."""
    shared = stage_tables(spark, {"order_attributes": O.order_attributes(raw), "order_items": raw.order_items})
    attrs, raw = shared["order_attributes"], replace(raw, order_items=shared["order_items"])

    def aligned(name: str, df: DataFrame, strict: bool = True) -> DataFrame:
        return align(df, schemas.SPECS_LATEST[name], strict, on_overflow="null_values")

    return {
        "orders": aligned("orders", O.orders_fact(raw, cutoff, attributes=attrs)),
        "addresses": aligned("addresses", O.addresses(raw, cutoff, attributes=attrs)),
        "customers": aligned("customers", O.customers(raw, cutoff, attributes=attrs)),
        "orders_products": aligned("orders_products", I.order_items(raw, cutoff, excluded=excluded)),
        "products": aligned("products", P.products(raw, old_host=hosts[0], new_host=hosts[1])),
        "campaign_trackings": aligned("campaign_trackings", P.campaign_trackings(raw)),
        "stock": aligned("stock", P.stock(raw, excluded_parents=stock_excluded), strict=False),
    }


def key_violations(spark: SparkSession, raw: Raw, cutoff: str, excluded, stock_excluded, hosts) -> DataFrame:
    tables = stage_tables(spark, data_sets(spark, raw, cutoff, excluded, stock_excluded, hosts))
    return check_keys(tables, schemas.SPECS_LATEST.values())


def upsert_many_report(spark: SparkSession, raw: Raw, cutoff: str, excluded, stock_excluded, hosts) -> DataFrame:
    """A load into filled tables as one unit: of every table a third of the keys
    is only in the target, a third only in the source and a third in both
    (rows with a NULL key are in both); then the post step (last billing
    address) once, then the deferred key checks.  One report row per table
    (rows after the load, violations)."""
    every = stage_tables(spark, data_sets(spark, raw, cutoff, excluded, stock_excluded, hosts))
    keys = {"orders": ["id"], "addresses": ["id"], "customers": ["id"],
            "orders_products": ["order_item_id", "subqty_id"], "campaign_trackings": ["id"], "products": ["id"]}
    plan = {}
    for n, k in keys.items():
        third = F.coalesce(F.col(k[0]) % 3, F.lit(2))
        plan[n] = (every[n].where(third != 0), every[n].where(third != 1), k, every[n].columns)

    def post(t):
        t = dict(t)
        orders = t["orders"].withColumnRenamed("billig_address_id", "billing_address_id")
        t["customers"] = O.last_billing_address(t["customers"], orders)
        return t

    tables, _ = upsert_many(plan, post=post)
    tables = stage_tables(spark, tables) | {"stock": every["stock"]}
    report = check_keys(tables, schemas.SPECS_LATEST.values())
    counts = None
    for n, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
        counts = c if counts is None else counts.unionByName(c)
    v = report.groupBy("table").agg(F.count(F.lit(1)).alias("violations"))
    return counts.join(v, "table", "left").select("table", "rows",
                                                  F.coalesce("violations", F.lit(0)).alias("violations"))


def schema_evolution(raw: Raw) -> DataFrame:
    """Products written under schema version 1, read under version 4."""
    v1 = align(P.products(raw), schemas.spec("products", 1))
    return evolve(v1, schemas.VERSIONS["products"], 1, 4)


def schema_evolution_orders(raw: Raw, cutoff: str) -> DataFrame:
    """Orders written under schema version 3 (no campaign columns), read under version 4."""
    v3 = align(O.orders_fact(raw, cutoff), schemas.spec("orders", 3), on_overflow="null")
    return evolve(v3, schemas.VERSIONS["orders"], 3, 4)


def schema_evolution_customers(raw: Raw, cutoff: str) -> DataFrame:
    """Customers written under schema version 2, read under version 3."""
    v2 = align(O.customers(raw, cutoff), schemas.spec("customers", 2))
    return evolve(v2, schemas.VERSIONS["customers"], 2, 3)


def stock_snapshots(spark: SparkSession, raw: Raw, stock_excluded) -> DataFrame:
    """Stock appended for two run dates, the second run twice (a rerun must
    not double it), read back."""
    path = scratch(spark, "stock")
    s = P.stock(raw, excluded_parents=stock_excluded)
    append_snapshot(s, path, "2017-01-22")
    append_snapshot(s, path, "2017-01-23")
    append_snapshot(s, path, "2017-01-23")
    return spark.read.parquet(path).select("product_id", "stock", "purchased_stock", "record_timestamp",
                                           F.col("record_date"))


def csv_round_trip(spark: SparkSession, raw: Raw, cutoff: str) -> DataFrame:
    """Addresses staged as CSV and read back with a checked header."""
    path = scratch(spark, "addresses-csv")
    df = O.addresses(raw, cutoff)
    write_csv(df, path, header=True)
    return read_csv_checked(spark, path, df.schema, header=True)


def _dump(spark: SparkSession, raw: Raw) -> list[str]:
    """Campaign trackings as a SQL dump in all the forms of INSERT, every 50th row in a statement that is cut short."""
    rows, folders = P.campaign_trackings(raw), [scratch(spark, "dump") for _ in range(5)]
    kind = F.when(F.col("id") % 50 == 7, 4).otherwise(F.col("id") % 4)
    cols = P.CAMPAIGN_COLUMNS
    write_sql_dump(rows.where(kind == 0), folders[0], "campaign_tracking")
    write_sql_dump(rows.where(kind == 1), folders[1], "campaign_tracking", lead="-- Dumping data for table\n/*!40000 ALTER TABLE `campaign_tracking` DISABLE KEYS */\n")
    write_sql_dump(rows.where(kind == 2).select(*cols[::-1]), folders[2], "campaign_tracking", verb="INSERT IGNORE INTO", name_columns=True)
    write_sql_dump(rows.where(kind == 3).drop("utm_term"), folders[3], "campaign_tracking", verb="REPLACE INTO", name_columns=True)
    write_statements(rows.where(kind == 4).select(F.concat(F.lit("INSERT INTO `campaign_tracking` VALUES ("), F.col("id").cast("string"), F.lit(",'cut"))), folders[4])
    return folders


def sql_dump_rows(spark: SparkSession, raw: Raw) -> DataFrame:
    """Rows read back from the dump (those in readable statements)."""
    rows, _errors = load_sql_dump(spark, _dump(spark, raw), "campaign_tracking", P.CAMPAIGN_COLUMNS, schema=raw.campaign_tracking.schema)
    return rows


def _dump_twice(spark: SparkSession, raw: Raw) -> list[str]:
    """Campaign trackings as a dump whose later statements meet keys that are there, in all forms.

    By id modulo 8: 1 INSERT IGNORE, 2 REPLACE without a column, 3 a plain
    INSERT, 4 REPLACE and then INSERT IGNORE in the same file, 5 the key twice
    in one REPLACE statement, 6 IGNORE of a new key (the id plus 10^9) and of
    the old one, 7 and 0 nothing.
    """
    rows, folders = P.campaign_trackings(raw), [scratch(spark, "dump") for _ in range(6)]
    kind = F.col("id") % 8
    write_sql_dump(rows, folders[0], "campaign_tracking")
    write_sql_dump(rows.where(kind == 1).withColumn("utm_medium", F.lit("ignored")), folders[1], "campaign_tracking", verb="INSERT IGNORE INTO")
    write_sql_dump(rows.where(kind == 2).withColumn("utm_medium", F.lit("replaced")).drop("utm_campaign"), folders[2], "campaign_tracking", verb="REPLACE INTO", name_columns=True)
    write_sql_dump(rows.where(kind == 3).withColumn("utm_medium", F.lit("twice")), folders[3], "campaign_tracking")

    def said(verb: str, *values):
        return F.concat(F.lit(f"{verb} `campaign_tracking` (id, utm_medium) VALUES "), F.concat_ws(",", *[F.concat(F.lit("("), i.cast("string"), F.lit(f",'{m}')")) for i, m in values]))

    i = F.col("id")
    end = F.lit(";\n")
    both = F.concat(said("REPLACE INTO", (i, "first")), end, said("REPLACE INTO", (i, "second")), end, said("INSERT IGNORE INTO", (i, "third")))
    write_statements(rows.where(kind == 4).select(both), folders[4])
    pair = F.when(kind == 5, said("REPLACE INTO", (i, "one"), (i, "two"))).otherwise(said("INSERT IGNORE INTO", (i + 10**9, "new"), (i, "old")))
    write_statements(rows.where(kind.isin(5, 6)).select(pair), folders[5])
    return folders


def sql_dump_in_order(spark: SparkSession, raw: Raw) -> DataFrame:
    """The table after all statements of a dump with repeated keys have run in order."""
    rows, _ = load_sql_dump(spark, _dump_twice(spark, raw), "campaign_tracking", P.CAMPAIGN_COLUMNS, schema=raw.campaign_tracking.schema, keys=["id"])
    return rows


def sql_dump_duplicates(spark: SparkSession, raw: Raw) -> DataFrame:
    """Rows of plain INSERTs of that dump whose key was there."""
    _, errors = load_sql_dump(spark, _dump_twice(spark, raw), "campaign_tracking", P.CAMPAIGN_COLUMNS, schema=raw.campaign_tracking.schema, keys=["id"])
    return errors.select(F.get_json_object("statement", "$.id").cast("bigint").alias("id"), F.get_json_object("statement", "$.utm_medium").alias("utm_medium"), "error")


# Days of the keyed-table scenario: the table as of DAY_ONE (orders of its last
# days not yet paid), then the changes up to the newest snapshot.
DAY_ONE, UNPAID_FROM = "1998-07-30", "1998-07-27"
BUCKETS = 64


def _day_one(facts: DataFrame) -> DataFrame:
    old = facts.where((F.col("order_date") < F.lit(DAY_ONE).cast("timestamp_ntz")) | F.col("order_date").isNull())
    late = F.col("order_date") >= F.lit(UNPAID_FROM).cast("timestamp_ntz")
    return old.withColumn("payment_method", F.when(late, "unpaid").otherwise(F.col("payment_method")))


def upsert_changed_buckets(spark: SparkSession, raw: Raw, cutoff: str) -> DataFrame:
    """Orders in a keyed table: only rows that differ from the day before are loaded,
    and only their buckets are rewritten.  One row a bucket: rows and sums after
    the load, its files, and whether it was rewritten or carried over."""
    facts = stage_tables(spark, {"orders": align(O.orders_fact(raw, cutoff), schemas.SPECS_LATEST["orders"], on_overflow="null_values")})["orders"]
    root, old = scratch(spark, "keyed-orders"), _day_one(facts)
    before = keyed.create(old, root, ["id"], BUCKETS)
    after = keyed.upsert_changed(changed_rows(old, facts, ["id"]), root)
    kept, new = keyed.rewritten(before, after)
    flags = spark.createDataFrame([(b, b in set(new), after.parts[str(b)]["files"]) for b in kept + new], "bucket int, rewritten boolean, files int")
    table = after.read(spark).withColumn("bucket", keyed.bucket_of(["id"], BUCKETS))
    sums = table.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("id_sum"), F.sum("order_total").alias("total"),
                                       F.count(F.when(F.col("payment_method") == "unpaid", 1)).alias("unpaid"))
    return sums.join(flags, "bucket")


def snapshot_change_counts(spark: SparkSession, raw: Raw) -> DataFrame:
    """Two snapshots of all raw tables, and how many keys of each were inserted, changed, deleted or stayed.

    The first lacks the rows whose id is 3 modulo 7, the second those whose id
    is 5 modulo 11; the last column of the second is another where the id is 1 modulo 5.
    """
    keys = {"posts": ["ID"], "postmeta": ["post_id", "meta_key"], "users": ["ID"], "usermeta": ["user_id", "meta_key"], "order_items": ["order_item_id"],
            "order_itemmeta": ["order_item_id", "meta_key"], "terms": ["term_id"], "term_taxonomy": ["term_taxonomy_id"],
            "term_relationships": ["object_id", "term_taxonomy_id"], "campaign_tracking": ["id"]}
    days = {"2017-01-22": {}, "2017-01-23": {}}
    for name, df in raw.as_dict().items():
        i, last = F.col(keys[name][0]), df.columns[-1]
        other = F.when(i % 5 == 1, F.lit(None)).otherwise(F.col(last)).cast(df.schema[last].dataType)
        days["2017-01-22"][name] = df.where(F.coalesce(i % 7, F.lit(0)) != 3)
        second = df.where(F.coalesce(i % 11, F.lit(0)) != 5)
        days["2017-01-23"][name] = second if last in keys[name] else second.withColumn(last, other)
    root = scratch(spark, "raw")
    for day, tables in days.items():
        stage_snapshot(Raw(**tables), root, day)
    old, new = (read_raw(spark, root, day).as_dict() for day in days)
    out = None
    for name, k in keys.items():
        # stored table by table: the shuffle of one is freed before that of the next
        c = stage_tables(spark, {name: change_counts(snapshot_changes(old[name], new[name], k))})[name].select(F.lit(name).alias("table"), "change", "n")
        out = c if out is None else out.unionByName(c)
    return out


def stored_versions(spark: SparkSession, raw: Raw, hosts) -> DataFrame:
    """Products in a keyed table written under schema versions 1, 3 and 4, read as 4.

    A third of the buckets is loaded under each version; columns that a
    version lacks are NULL in the buckets written under it.
    """
    every = stage_tables(spark, {"products": align(P.products(raw, old_host=hosts[0], new_host=hosts[1]), schemas.spec("products", 4))})["products"]
    third = F.floor(keyed.bucket_of(["id"], BUCKETS) * 3 / BUCKETS)
    root, versions = scratch(spark, "keyed-products"), schemas.VERSIONS["products"]
    keyed.create(align(every.where(third == 0), schemas.spec("products", 1)), root, ["id"], BUCKETS, schema_version=1)
    for part, v in ((1, 3), (2, 4)):
        keyed.evolve_stored(spark, root, versions[v - 1], v)
        keyed.upsert_changed(align(every.where(third == part), schemas.spec("products", v)), root)
    now = keyed.version(spark, root)
    written = spark.createDataFrame([(int(b), p["schema_version"]) for b, p in now.parts.items()], "bucket int, written_under int")
    return now.read(spark).withColumn("bucket", keyed.bucket_of(["id"], BUCKETS)).join(written, "bucket").drop("bucket")


def changed_key_report(spark: SparkSession, raw: Raw, cutoff: str, excluded, stock_excluded, hosts) -> DataFrame:
    """Check of a load by its changes alone: the load brings the orders, items and stock rows whose
    order or product id is 0 modulo 3 and takes away the addresses and products whose id is 0 modulo 5."""
    every = stage_tables(spark, data_sets(spark, raw, cutoff, excluded, stock_excluded, hosts))
    gone = {n: every[n].where(F.col("id") % 5 == 0) for n in ("addresses", "products")}
    after = every | {n: every[n].where(F.col("id") % 5 != 0) for n in gone}
    column = {"orders": "id", "orders_products": "order_id", "stock": "product_id", "customers": "id"}
    changed = {n: after[n].where(F.col(c) % 3 == 0) for n, c in column.items()}
    return check_changes(after, schemas.SPECS_LATEST.values(), changed, gone).groupBy("table", "rule").agg(F.count(F.lit(1)).alias("violations"))


def sizes_collated(raw: Raw) -> DataFrame:
    """Sizes by slugs that are written in capitals (odd ids) or with accents (ids 0 modulo 3)."""
    capital = F.when(F.col("post_id") % 2 == 1, F.upper("meta_value")).otherwise(F.col("meta_value"))
    accent = F.when(F.col("post_id") % 3 == 0, F.translate(capital, "aeiouAEIOU", "áéíóúÁÉÍÓÚ")).otherwise(capital)
    size = F.col("meta_key").isin(P.SIZE_KEYS)
    meta = raw.postmeta.withColumn("meta_value", F.when(size, accent).otherwise(F.col("meta_value")))
    return P.variation_sizes(Raw(**{**raw.as_dict(), "postmeta": meta}), collation="UNICODE_CI_AI")


def sorted_files(spark: SparkSession, raw: Raw, cutoff: str) -> DataFrame:
    """Orders written in total order: rows, first and last id over all files, files whose range meets
    that of the file before, and rows that are smaller than the one before."""
    path = scratch(spark, "orders-sorted")
    facts = stage_tables(spark, {"orders": O.orders_fact(raw, cutoff)})["orders"]  # the ranges are sampled first
    write_sorted(facts, path, ["id"], files=8)
    ranges = read_sorted_ranges(spark, path, "id")
    meets = F.col("first") <= F.lag("last").over(W.orderBy("file_number"))  # one row a file
    return ranges.withColumn("meets", F.coalesce(meets.cast("int"), F.lit(0))).agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first_id"), F.max("last").alias("last_id"), F.sum("meets").alias("files_meeting"), F.sum("falls").alias("rows_falling"))


def daily_tables(spark: SparkSession, raw: Raw, cutoff: str, excluded, stock_excluded, hosts) -> DataFrame:
    """The daily load over two snapshots: rows, rejected rows and stock days of each table.

    On the second day all payments are another and the totals of orders whose
    id ends in 3 do not fit their column.
    """
    root, out = scratch(spark, "raw"), scratch(spark, "reporting")
    key = F.col("meta_key")
    value = F.when(key == "_payment_method", "new").when((key == "_order_total") & (F.col("post_id") % 10 == 3), "1234567.00").otherwise(F.col("meta_value"))
    stage_snapshot(raw, root, "2017-01-22")
    first = read_raw(spark, root, "2017-01-22")  # stored: the raw tables are derived once
    stage_snapshot(Raw(**{**first.as_dict(), "postmeta": first.postmeta.withColumn("meta_value", value)}), root, "2017-01-23")
    for day in ("2017-01-22", "2017-01-23"):
        run_day(spark, root, out, day, cutoff=cutoff, excluded_products=excluded, excluded_parents=stock_excluded, old_host=hosts[0], new_host=hosts[1], fail_on_violations=False)
    made = None
    for name in KEYS:
        df = read_table(spark, out, name)
        new = F.count(F.when(F.col("payment_method") == "new", 1)) if name == "orders" else F.lit(0).cast("bigint")
        rejects = spark.read.parquet(f"{out}/_rejects/{name}").agg(F.count(F.lit(1)).alias("rejects"))
        c = df.agg(F.count(F.lit(1)).alias("rows"), new.alias("new_payments")).join(F.broadcast(rejects)).select(F.lit(name).alias("table"), "rows", "new_payments", "rejects")
        made = c if made is None else made.unionByName(c)
    stock = spark.read.parquet(f"{out}/stock").agg(F.count(F.lit(1)).alias("rows"))
    return made.unionByName(stock.select(F.lit("stock").alias("table"), "rows", F.lit(0).cast("bigint").alias("new_payments"), F.lit(0).cast("bigint").alias("rejects")))


def sql_dump_errors(spark: SparkSession, raw: Raw) -> DataFrame:
    """Statements of the dump that cannot be read, whole."""
    _rows, errors = load_sql_dump(spark, _dump(spark, raw), "campaign_tracking", P.CAMPAIGN_COLUMNS, schema=raw.campaign_tracking.schema)
    return errors.select("statement")


def _exact_sum(x: Column) -> Column:
    """Sum of 64-bit numbers as decimal(38,0), from sums of 22, 22 and 20 bits, which no table is
    long enough to take beyond 64 bits."""
    low, middle, high = (F.sum(p).cast("decimal(20,0)") for p in (x.bitwiseAND(0x3FFFFF), F.shiftright(x, 22).bitwiseAND(0x3FFFFF), F.shiftright(x, 44)))
    return (high * F.lit(1 << 44).cast("decimal(14,0)") + middle * F.lit(1 << 22).cast("decimal(7,0)") + low).cast("decimal(38,0)")


def _contents(df: DataFrame) -> list[Column]:
    """Aggregates: rows, sum of the first column, and sum of a hash of name, value and nullness of every column."""
    first, every = df.columns[0], [e for c in df.columns for e in (F.lit(c), F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    whole = isinstance(df.schema[first].dataType, IntegralType)
    ids = _exact_sum(F.col(f"`{first}`").cast("bigint")) if whole else F.sum(F.col(f"`{first}`").cast("decimal(38,0)"))
    return [F.count(F.lit(1)).alias("n"), ids.alias("id_sum"), F.coalesce(_exact_sum(F.xxhash64(*every)), F.lit(0).cast("decimal(38,0)")).alias("hash_sum")]


def scan_snapshot(spark: SparkSession, raw: Raw) -> DataFrame:
    """All raw tables staged as a dated snapshot and read back for that date: rows and
    sum of ids.  A table fails the job if what is read differs from what was staged
    in the number of its rows or the sum of their hashes over all columns; those of what
    is staged are taken while it is written."""
    root = scratch(spark, "raw")
    staged = {name: Observation() for name in raw.as_dict()}
    stage_snapshot(Raw(**{n: df.observe(staged[n], *_contents(df)) for n, df in raw.as_dict().items()}), root, "2017-01-22")
    out = None
    for name, df in read_raw(spark, root, "2017-01-22").as_dict().items():
        c, was = df.agg(*_contents(df)), staged[name].get
        same = (F.col("n") == was["n"]) & (F.col("hash_sum") == F.lit(was["hash_sum"]))
        n = F.when(same, F.col("n")).otherwise(F.raise_error(F.lit(f"snapshot of {name} is not what was staged")))
        c = c.select(F.lit(name).alias("table"), n.alias("n"), F.col("id_sum").cast("string").alias("id_sum"))
        out = c if out is None else out.unionByName(c)
    return out


def order_day_runs(raw: Raw, cutoff: str) -> DataFrame:
    """Run log derived from the data: a finished ``orders`` run for every day
    with a completed order."""
    days = O.completed_orders(raw.posts, cutoff).select(F.to_date("post_date").alias("run_date")).distinct()
    return days.select(F.lit("orders").alias("task"), "run_date",
                       F.col("run_date").cast("timestamp_ntz").alias("finished_at"))


def pending_order_days(spark: SparkSession, raw: Raw, cutoff: str) -> DataFrame:
    """Days between the first and last completed order without a run, newest first."""
    log = order_day_runs(raw, cutoff)
    lo, hi = log.agg(F.min("run_date").cast("string"), F.max("run_date").cast("string")).first()
    if lo is None:
        return log.select("run_date").limit(0)
    return pending_dates(spark, lo, hi, log, "orders")


def empty_to_null_addresses(raw: Raw, cutoff: str) -> DataFrame:
    return empty_to_null(O.addresses(raw, cutoff))
