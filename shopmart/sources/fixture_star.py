"""Project the star-schema test tables into the shop's raw tables.

The test data (``region nation customer supplier part orders lineitem events``)
is a star schema; the shop keeps entity / attribute / value tables.  Every
registered query first builds the raw shop tables from the star tables with
the rules below (plain DataFrame work, partitioned like the inputs), then runs
the operator on them.  ``plans/oracle.py`` repeats the same rules as DuckDB
CTEs, so the oracle sees identical raw input.

Rules (ids are offsets so the id cuts of the shop queries take effect):

* orders: post ``10000000 + o_orderkey``, ``wc-completed`` when the status is
  F or O else ``wc-pending``, ``post_date = o_orderdate``; about 30 attribute
  rows each (customer, dates, payment, totals, campaign, billing and shipping
  address parts) with deliberate gaps, empty values and 4-decimal tax text.
* variations: post ``7200 + p_partkey`` under parent ``1000000 + p_partkey div 4``;
  parents are ``draft`` when ``(p_partkey div 4) % 10 = 9``; attachments
  ``31000000 + p_partkey div 4`` carry the old image host.
* items: one per ``(l_orderkey, l_linenumber)``, id ``l_orderkey * 8 + l_linenumber``,
  money per group, numbered ``_delivered_<n>`` / ``_returned_<n>`` per line.
* terms: category tree region -> nation -> supplier -> sub-supplier (even
  suppliers) -> depth-4 node (suppliers divisible by 4); attribute terms for
  color, brand, order season, season, sex and sizes with ids from an md5 of
  ``taxonomy/slug``.
* campaign trackings: all events.
* traps: guest orders (``_customer_user`` ``'0'``, a third), attribute rows
  holding NULL, parents without any term link, repeated and odd
  ``_delivered_`` keys, ids with leading zeros or an exponent, amounts like
  ``abc``, ``12abc``, ``1e2`` and ``1d``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the projection (must equal plans/oracle.py).
ORDER_OFFSET = 10_000_000
VARIATION_OFFSET = 7_200
PARENT_OFFSET = 1_000_000
ATTACHMENT_OFFSET = 31_000_000
SUB_CATEGORY_OFFSET = 10_000_000
DEEP_CATEGORY_OFFSET = 40_000_000
ATTRIBUTE_TERM_OFFSET = 100_000_000_000
PRODUCT_BASE_DATE = "2015-01-01"
USER_BASE_DATE = "2010-01-01"
ODD_NUMBERS = ["abc", "12abc", "1e2", "1d"]
OLD_IMAGE_HOST = "old-shop.example"
NEW_IMAGE_HOST = "shop.example"

# Rows whose attributes one task derives.
ORDERS_A_TASK, LINES_A_TASK = 50_000, 200_000

# Fixed values of the shop (attribute keys, taxonomies, slugs).
SEASON_SLUGS = ["fruehling", "sommer", "herbst", "winter"]

RAW_TABLES = [
    "posts", "postmeta", "users", "usermeta", "order_items", "order_itemmeta",
    "terms", "term_taxonomy", "term_relationships", "campaign_tracking",
]

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _may_hold(held: str, key: str) -> bool:
    """Can a row of a part that holds ``held`` (a key, or with ``%`` at its end all that begin so) match ``key`` by LIKE?"""
    start = held.removesuffix("%")
    for i, c in enumerate(key):
        if c == "%":
            return True
        if i >= len(start):
            return start != held
        if c not in ("_", start[i]):
            return False
    return len(key) >= len(start)


@dataclass
class Raw:
    """The raw shop tables of one snapshot."""

    posts: DataFrame
    postmeta: DataFrame
    users: DataFrame
    usermeta: DataFrame
    order_items: DataFrame
    order_itemmeta: DataFrame
    terms: DataFrame
    term_taxonomy: DataFrame
    term_relationships: DataFrame
    campaign_tracking: DataFrame
    # attribute table -> (table, [(its keys, rows)]): the parts whose union the table is; a key
    # ending in % stands for all keys that begin so
    parts: dict[str, tuple[DataFrame, list[tuple[list[str], DataFrame]]]] = field(default_factory=dict, repr=False, compare=False)

    def attributes(self, table: str, keys: Iterable[str]) -> DataFrame:
        """Every row of an attribute table whose key is LIKE one of ``keys``, and maybe others:
        parts that hold no such key are not read."""
        whole, parts = getattr(self, table), self.parts.get(table)
        if parts is None or parts[0] is not whole:  # no parts, or those of another table
            return whole
        keys = list(keys)
        out = None
        for held, df in parts[1]:
            if any(_may_hold(h, k) for k in keys for h in held):
                out = df if out is None else out.unionByName(df)
        return whole if out is None else out

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in RAW_TABLES}


def read_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in STAR_TABLES}


def _days_after(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int")).cast("timestamp_ntz")


def _plus_days(ts: Column, days: Column | int) -> Column:
    d = F.lit(days) if isinstance(days, int) else days
    return F.timestamp_add("DAY", d, ts)


def _ts_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _epoch_text(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp")).cast("string")


def _dec_text(c: Column, t: str = "decimal(12,2)") -> Column:
    return c.cast(t).cast("string")


def _kv(pairs: list[tuple[str | Column, Column]]) -> Column:
    """Array of (meta_key, meta_value) structs; NULL values mean "absent"."""
    return F.array(*[
        F.struct((F.lit(k) if isinstance(k, str) else k).alias("meta_key"),
                 v.cast("string").alias("meta_value"))
        for k, v in pairs
    ])


def _odd_number(n: Column) -> Column:
    """Text that is a number only in part, or not as plain digits."""
    return F.element_at(F.array(*[F.lit(t) for t in ODD_NUMBERS]), (n % len(ODD_NUMBERS) + 1).cast("int"))


def _explode_meta(df: DataFrame, id_col: str, id_name: str, pairs) -> DataFrame:
    return (df.select(F.col(id_col).cast("bigint").alias(id_name), F.inline(_kv(pairs)))
              .where(F.col("meta_value").isNotNull()))


def _dealt(df: DataFrame, key: str, table: DataFrame, rows: int) -> DataFrame:
    """``df`` hash-partitioned by ``key``, a partition for each ``rows`` rows of ``table``: what is
    exploded and sorted by the entity in one task stays some hundred megabytes at any size."""
    return df.repartition(-(-table.count() // rows) or 1, key)


def _attr_term_id(taxonomy: Column, slug: Column) -> Column:
    h = F.conv(F.substring(F.md5(F.concat(taxonomy, F.lit("/"), slug)), 1, 10), 16, 10).cast("bigint")
    return F.lit(ATTRIBUTE_TERM_OFFSET) + h


def build_raw(star: dict[str, DataFrame]) -> Raw:
    region, nation, customer = star["region"], star["nation"], star["customer"]
    supplier, part, orders = star["supplier"], star["part"], star["orders"]
    lineitem, events = star["lineitem"], star["events"]

    okey = F.col("o_orderkey")
    oid = (F.lit(ORDER_OFFSET) + okey).alias("ID")

    # ---- posts -------------------------------------------------------------
    order_posts = orders.select(
        oid,
        F.lit("shop_order").alias("post_type"),
        F.when(F.col("o_orderstatus").isin("F", "O"), "wc-completed").otherwise("wc-pending").alias("post_status"),
        F.col("o_orderdate").alias("post_date"),
        F.col("o_orderdate").alias("post_modified"),
        F.concat(F.lit("Order "), okey.cast("string")).alias("post_title"),
        F.lit(0).cast("bigint").alias("post_parent"),
        F.lit(None).cast("string").alias("guid"),
    )
    k = F.floor(F.col("p_partkey") / 4).cast("bigint")
    part_k = part.withColumn("k", k)
    variation_posts = part_k.select(
        (F.lit(VARIATION_OFFSET) + F.col("p_partkey")).alias("ID"),
        F.lit("product_variation").alias("post_type"),
        F.lit("publish").alias("post_status"),
        _days_after(PRODUCT_BASE_DATE, F.col("p_partkey") % 1000).alias("post_date"),
        _days_after(PRODUCT_BASE_DATE, F.col("p_partkey") % 1000).alias("post_modified"),
        F.col("p_name").alias("post_title"),
        (F.lit(PARENT_OFFSET) + F.col("k")).alias("post_parent"),
        F.lit(None).cast("string").alias("guid"),
    )
    parents = part_k.groupBy("k").agg(
        F.min("p_name").alias("title"),
        F.max("p_retailprice").alias("retail"),
    )
    parent_date = _days_after(PRODUCT_BASE_DATE, F.col("k") % 1000)
    parent_posts = parents.select(
        (F.lit(PARENT_OFFSET) + F.col("k")).alias("ID"),
        F.lit("product").alias("post_type"),
        F.when(F.col("k") % 10 == 9, "draft").otherwise("publish").alias("post_status"),
        parent_date.alias("post_date"),
        _plus_days(parent_date, (F.col("k") % 30).cast("int")).alias("post_modified"),
        F.col("title").alias("post_title"),
        F.lit(0).cast("bigint").alias("post_parent"),
        F.lit(None).cast("string").alias("guid"),
    )
    attachment_posts = parents.select(
        (F.lit(ATTACHMENT_OFFSET) + F.col("k")).alias("ID"),
        F.lit("attachment").alias("post_type"),
        F.lit("inherit").alias("post_status"),
        parent_date.alias("post_date"),
        parent_date.alias("post_modified"),
        F.concat(F.lit("img "), F.col("k").cast("string")).alias("post_title"),
        (F.lit(PARENT_OFFSET) + F.col("k")).alias("post_parent"),
        F.concat(F.lit(f"https://{OLD_IMAGE_HOST}/uploads/p"), F.col("k").cast("string"), F.lit(".jpg")).alias("guid"),
    )
    posts = order_posts.unionByName(variation_posts).unionByName(parent_posts).unionByName(attachment_posts)

    # ---- postmeta ----------------------------------------------------------
    cust = customer.join(F.broadcast(nation.select("n_nationkey", "n_name")),
                         F.col("c_nationkey") == F.col("n_nationkey"))
    oc = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    total = F.col("o_totalprice").cast("decimal(12,2)")
    disc = ((okey % 50) * F.lit(1.5).cast("decimal(2,1)")).cast("decimal(12,2)")
    ckey = F.col("c_custkey")
    first_name = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    last_name = F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))
    city = F.concat(F.col("n_name"), F.lit(" City"))
    address_common = [
        ("address_1", F.concat(F.lit("Street "), ckey.cast("string"))),
        ("address_2", F.when(ckey % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("Apt "), (ckey % 10).cast("string")))),
        ("company", F.lit("")),
        ("first_name", first_name),
        ("last_name", last_name),
        ("postcode", F.lpad((ckey % 100000).cast("string"), 5, "0")),
    ]
    state = F.when(ckey % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    billing = address_common + [("city", city), ("state", state), ("country", F.col("n_name"))]
    shipping = address_common + [
        ("city", F.when(okey % 4 == 0, F.concat(F.col("n_name"), F.lit(" Harbor "), (okey % 3).cast("string")))
                  .otherwise(city)),
        ("state", state), ("country", F.col("n_name")),
    ]
    order_pairs = [
        ("_customer_user", F.when(okey % 3 == 1, F.lit("0")).otherwise(F.col("o_custkey").cast("string"))),
        ("_completed_date", _ts_text(_plus_days(F.col("o_orderdate"), 3))),
        ("_payment_method", F.when(okey % 11 == 0, F.lit(None))
                             .when(okey % 7 == 0, F.lit("")).otherwise(F.col("o_orderpriority"))),
        ("_order_total", _dec_text(total)),
        ("_order_tax", (total * F.lit(0.19).cast("decimal(2,2)")).cast("string")),
        ("_cart_discount", F.when(okey % 5 == 0, F.lit(None)).otherwise(disc.cast("string"))),
        ("_cart_discount_tax", F.when(okey % 5 == 0, F.lit(None))
                                .otherwise((disc * F.lit(0.19).cast("decimal(2,2)")).cast("string"))),
        ("_last_contact_campaign_id", F.when(okey % 3 == 0, F.lit(None)).otherwise((okey % 500).cast("string"))),
        ("_first_contact_campaign_id", F.when(okey % 2 == 1, F.lit(None)).otherwise(((okey * 7) % 1000).cast("string"))),
        ("_last_contact_campaign_recorded_at", F.when(okey % 3 == 0, F.lit(None))
                                                .otherwise(_ts_text(_plus_days(F.col("o_orderdate"), -1)))),
        ("_first_contact_campaign_recorded_at", F.when(okey % 2 == 1, F.lit(None))
                                                 .otherwise(_ts_text(_plus_days(F.col("o_orderdate"), -2)))),
        ("customer_origin", F.when(okey % 4 == 3, F.lit(None)).otherwise(F.lower(F.col("c_mktsegment")))),
    ]
    order_pairs += [(f"_billing_{n}", v) for n, v in billing]
    order_pairs += [(f"_shipping_{n}", v) for n, v in shipping]
    order_meta = _explode_meta(_dealt(oc.withColumn("pid", F.lit(ORDER_OFFSET) + okey), "pid", orders, ORDERS_A_TASK), "pid", "post_id", order_pairs)

    pk = F.col("p_partkey")
    psize = F.col("p_size")
    variation_pairs = [
        ("_stock", psize.cast("string")),
        ("_original_stock", F.when(pk % 2 == 0, (psize + 10).cast("string"))),
        ("attribute_pa_zustand", F.when(pk % 3 == 0, F.lit("new")).when(pk % 3 == 1, F.lit("used"))),
        ("attribute_pa_groesse", F.when((pk % 2 == 0) & (pk % 7 == 0), F.lit("gr-none"))
                                  .when(pk % 2 == 0, F.concat(F.lit("gr-"), psize.cast("string")))),
        ("attribute_pa_kgr", F.when(pk % 2 == 1, F.concat(F.lit("kgr-"), (psize % 10).cast("string")))),
        ("attribute_pa_kopfumfang", F.when(pk % 5 == 0, F.concat(F.lit("ku-"), (psize % 6).cast("string")))),
    ]
    variation_meta = _explode_meta(part.withColumn("pid", F.lit(VARIATION_OFFSET) + pk),
                                   "pid", "post_id", variation_pairs)
    retail = F.col("retail").cast("decimal(12,2)")
    kk = F.col("k")
    parent_pairs = [
        ("_thumbnail_id", F.when(kk % 8 == 0, F.lit(None)).otherwise((F.lit(ATTACHMENT_OFFSET) + kk).cast("string"))),
        ("_uvp", retail.cast("string")),
        ("_cogs", F.when(kk % 6 == 0, F.lit(None)).when(kk % 5 == 1, _odd_number(kk))
                   .otherwise((retail * F.lit(0.4).cast("decimal(1,1)")).cast("string"))),
    ]
    parent_meta = _explode_meta(parents.withColumn("pid", F.lit(PARENT_OFFSET) + kk), "pid", "post_id", parent_pairs)
    # attribute rows that are there and hold NULL
    null_meta = part.where(pk % 14 == 1).select(
        (F.lit(VARIATION_OFFSET) + pk).alias("post_id"), F.lit("_original_stock").alias("meta_key"), F.lit(None).cast("string").alias("meta_value"))
    postmeta = order_meta.unionByName(variation_meta).unionByName(parent_meta).unionByName(null_meta)
    post_parts = [([k for k, _ in order_pairs], order_meta), ([k for k, _ in variation_pairs], variation_meta),
                  ([k for k, _ in parent_pairs], parent_meta), (["_original_stock"], null_meta)]

    # ---- users -------------------------------------------------------------
    users = customer.select(
        ckey.alias("ID"),
        F.concat(F.lower(F.regexp_replace(F.col("c_name"), "#", ".")), F.lit("@mail.example")).alias("user_email"),
        _days_after(USER_BASE_DATE, ckey % 3000).alias("user_registered"),
    )
    usermeta = _explode_meta(customer, "c_custkey", "user_id", [
        ("billing_first_name", first_name),
        ("billing_last_name", last_name),
        ("billing_phone", F.when(ckey % 6 == 0, F.lit(None)).otherwise(F.concat(F.lit("+49 30 "), ckey.cast("string")))),
    ])

    # ---- order items -------------------------------------------------------
    # dealt once by the item: what follows, up to the attributes, needs no other shuffle of the lines
    lines = _dealt(lineitem.withColumn("order_item_id", F.col("l_orderkey") * 8 + F.col("l_linenumber")), "order_item_id", lineitem, LINES_A_TASK)
    line = ["order_item_id", "l_orderkey", "l_linenumber"]
    groups = lines.groupBy(*line).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("decimal(12,2)").alias("sub"),
        F.max(F.col("l_discount").cast("decimal(4,2)")).alias("disc"),
        F.max(F.col("l_tax").cast("decimal(4,2)")).alias("tax"),
        F.sum("l_quantity").cast("bigint").alias("qty"),
        F.min("l_partkey").alias("min_partkey"),
    ).withColumn("line_total", (F.col("sub") * (F.lit(1) - F.col("disc"))).cast("decimal(12,2)"))
    order_items = groups.join(part.select("p_partkey", "p_name"), F.col("min_partkey") == F.col("p_partkey")).select(
        "order_item_id",
        (F.lit(ORDER_OFFSET) + F.col("l_orderkey")).alias("order_id"),
        F.col("p_name").alias("order_item_name"),
    )
    lk = F.col("l_orderkey")
    item_pairs = [
        ("_line_subtotal", F.col("sub").cast("string")),
        ("_line_total", F.col("line_total").cast("string")),
        ("_line_subtotal_tax", (F.col("sub") * F.col("tax")).cast("string")),
        ("_line_tax", (F.col("line_total") * F.col("tax")).cast("string")),
        ("_qty", F.when(lk % 41 == 3, _odd_number(lk))
                  .otherwise(F.concat(F.col("qty").cast("string"), F.when(lk % 2 == 0, F.lit(".00")).otherwise(F.lit(""))))),
        ("_product_id", (F.lit(PARENT_OFFSET) + F.floor(F.col("min_partkey") / 4)).cast("bigint").cast("string")),
        ("_variation_id", F.when(lk % 13 == 0, F.lit("0")).when(lk % 29 == 2, F.lit("7.3e3"))
                           .when(lk % 13 == 1, F.concat(F.lit("0"), (F.lit(VARIATION_OFFSET) + F.col("min_partkey")).cast("string")))
                           .otherwise((F.lit(VARIATION_OFFSET) + F.col("min_partkey")).cast("string"))),
    ]
    item_meta = _explode_meta(groups, "order_item_id", "order_item_id", item_pairs)
    w = Window.partitionBy(*line).orderBy(
        "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    numbered = lines.select(
        "order_item_id", "l_shipdate", "l_returnflag", "l_linenumber",
        F.row_number().over(w).cast("string").alias("n"))
    # the first delivery once more, a day later, and a key that only LIKE takes for one
    n, order = F.col("n"), F.floor(F.col("order_item_id") / 8)
    delivered = F.concat(F.lit("_delivered_"), n)
    numbered_meta = _explode_meta(numbered, "order_item_id", "order_item_id", [
        (delivered, _epoch_text(F.col("l_shipdate"))),
        (F.concat(F.lit("_returned_"), n),
         F.when(F.col("l_returnflag") == "R",
                _epoch_text(_plus_days(F.col("l_shipdate"), (F.col("l_linenumber") - 4).cast("int"))))),
        (delivered, F.when((n == "1") & (order % 17 == 0), _epoch_text(_plus_days(F.col("l_shipdate"), 1)))),
        ("Xdelivered-9", F.when((n == "1") & (order % 19 == 0), _epoch_text(F.col("l_shipdate")))),
    ])
    order_itemmeta = item_meta.unionByName(numbered_meta)
    item_parts = [([k for k, _ in item_pairs], item_meta), (["_delivered_%", "_returned_%", "Xdelivered-9"], numbered_meta)]

    # ---- terms -------------------------------------------------------------
    cat_nodes = (
        region.select((F.lit(1) + F.col("r_regionkey")).cast("bigint").alias("term_id"),
                      F.col("r_name").alias("name"), F.lit(0).cast("bigint").alias("parent"))
        .unionByName(nation.select((F.lit(100) + F.col("n_nationkey")).cast("bigint").alias("term_id"),
                                   F.concat(F.col("n_name"), F.lit(" &amp; Friends")).alias("name"),
                                   (F.lit(1) + F.col("n_regionkey")).cast("bigint").alias("parent")))
        .unionByName(supplier.select((F.lit(1000) + F.col("s_suppkey")).alias("term_id"),
                                     F.concat(F.col("s_name"), F.lit(" &amp; Sons")).alias("name"),
                                     (F.lit(100) + F.col("s_nationkey")).cast("bigint").alias("parent")))
        .unionByName(supplier.where(F.col("s_suppkey") % 2 == 0).select(
            (F.lit(SUB_CATEGORY_OFFSET) + F.col("s_suppkey")).alias("term_id"),
            F.concat(F.lit("Sub "), F.col("s_name")).alias("name"),
            (F.lit(1000) + F.col("s_suppkey")).alias("parent")))
        .unionByName(supplier.where(F.col("s_suppkey") % 4 == 0).select(
            (F.lit(DEEP_CATEGORY_OFFSET) + F.col("s_suppkey")).alias("term_id"),
            F.concat(F.lit("Deep "), F.col("s_name")).alias("name"),
            (F.lit(SUB_CATEGORY_OFFSET) + F.col("s_suppkey")).alias("parent")))
        .withColumn("taxonomy", F.lit("product_cat"))
        .withColumn("slug", F.lower(F.col("name")))
    )

    # attribute terms of a parent, one row per (k, taxonomy, name, slug)
    first_word = F.split_part(F.col("p_name"), F.lit(" "), F.lit(1))
    season_name = F.element_at(F.array(*[F.lit(s.capitalize()) for s in SEASON_SLUGS]),
                               (psize % 4 + 1).cast("int"))
    sex_name = (F.when(F.col("p_type").isin("ECONOMY", "SMALL"), F.lit("Maedchen"))
                .when(F.col("p_type").isin("STANDARD", "MEDIUM"), F.lit("Jungen"))
                .otherwise(F.lit("Unisex")))
    parent_id = F.lit(PARENT_OFFSET) + F.col("k")
    linked = part_k.where(F.col("k") % 12 != 7)
    attr_rows = linked.select(F.col("k"), F.inline(F.array(
        F.struct(F.lit("pa_farbe").alias("taxonomy"), first_word.alias("name")),
        F.struct(F.lit("pa_marke").alias("taxonomy"),
                 F.when(parent_id % 9 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("name")),
        F.struct(F.lit("pa_order_saison").alias("taxonomy"),
                 F.concat(F.lit("Season "), (psize % 3).cast("string")).alias("name")),
        F.struct(F.lit("pa_jahreszeit").alias("taxonomy"), season_name.alias("name")),
        F.struct(F.lit("pa_geschlecht").alias("taxonomy"), sex_name.alias("name")),
    ))).where(F.col("name").isNotNull()).withColumn("slug", F.lower(F.col("name"))).distinct()

    size_terms = part.select(F.inline(F.array(
        F.struct(F.lit("pa_groesse").alias("taxonomy"),
                 F.concat(F.lit("Gr "), psize.cast("string")).alias("name"),
                 F.concat(F.lit("gr-"), psize.cast("string")).alias("slug")),
        F.struct(F.lit("pa_kgr").alias("taxonomy"),
                 F.concat(F.lit("KGr "), (psize % 10).cast("string")).alias("name"),
                 F.concat(F.lit("kgr-"), (psize % 10).cast("string")).alias("slug")),
        F.struct(F.lit("pa_kopfumfang").alias("taxonomy"),
                 F.concat(F.lit("KU "), (psize % 6).cast("string")).alias("name"),
                 F.concat(F.lit("ku-"), (psize % 6).cast("string")).alias("slug")),
    ))).distinct()
    attr_terms = (attr_rows.select("taxonomy", "name", "slug").unionByName(size_terms).distinct()
                  .withColumn("term_id", _attr_term_id(F.col("taxonomy"), F.col("slug")))
                  .withColumn("parent", F.lit(0).cast("bigint")))

    all_terms = cat_nodes.select("term_id", "name", "slug", "taxonomy", "parent").unionByName(
        attr_terms.select("term_id", "name", "slug", "taxonomy", "parent"))
    terms = all_terms.select("term_id", "name", "slug")
    term_taxonomy = all_terms.select(F.col("term_id").alias("term_taxonomy_id"), "term_id", "taxonomy", "parent")

    # parent -> category links from the suppliers of its parts' line items
    supp = lineitem.groupBy(F.floor(F.col("l_partkey") / 4).cast("bigint").alias("k")).agg(
        F.min("l_suppkey").alias("s_min"), F.max("l_suppkey").alias("s_max"))
    s_min, s_max = F.col("s_min"), F.col("s_max")
    cat_links = supp.select(F.col("k"), F.explode(F.array(
        F.when((kk % 2 == 0) & (s_min % 2 == 0), F.lit(SUB_CATEGORY_OFFSET) + s_min)
         .otherwise(F.lit(1000) + s_min),
        F.when((kk % 3 == 0) & (s_max != s_min), F.lit(1000) + s_max),
        F.when((kk % 10 == 5) & (s_min % 4 == 0), F.lit(DEEP_CATEGORY_OFFSET) + s_min),
    )).alias("term_taxonomy_id")).where(F.col("term_taxonomy_id").isNotNull() & (kk % 12 != 7))
    attr_links = attr_rows.select("k", _attr_term_id(F.col("taxonomy"), F.col("slug")).alias("term_taxonomy_id"))
    term_relationships = cat_links.unionByName(attr_links).select(
        (F.lit(PARENT_OFFSET) + F.col("k")).alias("object_id"),
        F.col("term_taxonomy_id").cast("bigint").alias("term_taxonomy_id"))

    campaign_tracking = events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("utm_medium"),
        F.col("user_id").cast("string").alias("utm_source"),
        F.col("props").alias("utm_campaign"),
        F.lit(None).cast("string").alias("utm_term"),
        F.lit(None).cast("string").alias("utm_content"),
    )

    return Raw(posts=posts, postmeta=postmeta, users=users, usermeta=usermeta,
               order_items=order_items, order_itemmeta=order_itemmeta, terms=terms,
               term_taxonomy=term_taxonomy, term_relationships=term_relationships,
               campaign_tracking=campaign_tracking,
               parts={"postmeta": (postmeta, post_parts), "order_itemmeta": (order_itemmeta, item_parts)})


def raw_from_star(spark: SparkSession, sf_dir: str) -> Raw:
    """Raw shop tables of the test snapshot at ``sf_dir`` (lazy)."""
    return build_raw(read_star(spark, sf_dir))
