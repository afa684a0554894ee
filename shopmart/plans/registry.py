"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query builds the raw shop tables from the star tables at ``sf_dir``
(``sources/fixture_star``) and runs one operator or data set over all of
them.  Parameters that the shop hard-codes but that do not fit the test data
(the order cutoff, excluded ids) are passed explicitly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_number, lenient_decimal, lenient_long, value_or_default
from ..operators.eav import eav_keys_like, eav_lookup, eav_pivot, select_keys
from ..operators.filters import completed_orders, order_filter
from ..operators.load import align
from ..operators.terms import AMP, category_tree, term_links
from ..sources.fixture_star import NEW_IMAGE_HOST, OLD_IMAGE_HOST, Raw, raw_from_star
from . import items as I
from . import loads as L
from . import orders as O
from . import products as P
from . import schemas

CUTOFF = "1996-01-01"
ITEM_EXCLUDED = (7300, 1000003)
STOCK_EXCLUDED_PARENTS = (1000003, 1000007)
HOSTS = (OLD_IMAGE_HOST, NEW_IMAGE_HOST)   # image host rewrite of the test data

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Callable[..., DataFrame]] = {}
_NEEDS_SPARK: set[str] = set()


def register(name: str, needs_spark: bool = False):
    """Register ``fn(raw)`` (or ``fn(spark, raw)`` when it writes) under ``name``."""
    def deco(fn):
        _QUERIES[name] = fn
        if needs_spark:
            _NEEDS_SPARK.add(name)
        return fn
    return deco


@register("orders_fact")
def q_orders_fact(raw: Raw) -> DataFrame:
    return O.orders_fact(raw, CUTOFF)


@register("addresses")
def q_addresses(raw: Raw) -> DataFrame:
    return O.addresses(raw, CUTOFF)


@register("customers")
def q_customers(raw: Raw) -> DataFrame:
    return O.customers(raw, CUTOFF)


@register("order_items")
def q_order_items(raw: Raw) -> DataFrame:
    return I.order_items(raw, CUTOFF, excluded=ITEM_EXCLUDED)


@register("delivered_returned_pairs")
def q_pairs(raw: Raw) -> DataFrame:
    return I.delivered_returned_pairs(raw.attributes("order_itemmeta", I.NUMBERED_KEYS))


@register("unit_price")
def q_unit_price(raw: Raw) -> DataFrame:
    return I.item_amounts(raw.attributes("order_itemmeta", I.ITEM_KEYS)).select(
        "order_item_id", "price_net", "price_tax", "payment_net", "payment_tax")


@register("unit_discount")
def q_unit_discount(raw: Raw) -> DataFrame:
    return I.item_amounts(raw.attributes("order_itemmeta", I.ITEM_KEYS)).select("order_item_id", "discount_net", "discount_tax")


@register("product_choice")
def q_product_choice(raw: Raw) -> DataFrame:
    pv = eav_pivot(raw.attributes("order_itemmeta", I.ITEM_KEYS), "order_item_id", I.ITEM_KEYS)
    return pv.select("order_item_id", I.product_choice(F.col("variation_ref"), F.col("product_ref"),
                                                        excluded=ITEM_EXCLUDED).alias("product_id"))


@register("category_tree")
def q_category_tree(raw: Raw) -> DataFrame:
    return category_tree(raw.term_taxonomy, raw.terms)


@register("products", needs_spark=True)
def q_products(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.products(spark, raw, HOSTS)


@register("last_order_by_product")
def q_last_order(raw: Raw) -> DataFrame:
    return P.last_order_by_product(raw)


@register("term_list")
def q_term_list(raw: Raw) -> DataFrame:
    return P.parent_terms(raw).select("object_id", "color", "brand", "order_season")


@register("season_flags")
def q_season_flags(raw: Raw) -> DataFrame:
    return P.parent_terms(raw).select("object_id", *[f"season_{s}" for s in P.SEASONS])


@register("sex_of_product")
def q_sex(raw: Raw) -> DataFrame:
    return P.parent_terms(raw).select("object_id", "sex")


@register("product_category_path")
def q_category_path(raw: Raw) -> DataFrame:
    return P.parent_terms(raw).select("object_id", "category", "primary_category", "super_category")


@register("size_by_slug")
def q_size_by_slug(raw: Raw) -> DataFrame:
    return P.variation_sizes(raw)


@register("thumbnail_url")
def q_thumbnail_url(raw: Raw) -> DataFrame:
    pm = eav_pivot(raw.attributes("postmeta", ["_thumbnail_id"]), "post_id", {"_thumbnail_id": "thumbnail_ref"})
    return P.thumbnails(raw, pm, OLD_IMAGE_HOST, NEW_IMAGE_HOST).select("post_id", "thumbnail_url")


@register("size_by_slug_collated")
def q_size_collated(raw: Raw) -> DataFrame:
    return L.sizes_collated(raw)


@register("product_variations")
def q_product_variations(raw: Raw) -> DataFrame:
    return P.products(raw).select(F.col("id").alias("product_id"), "parent_id", "name")


@register("stock")
def q_stock(raw: Raw) -> DataFrame:
    return P.stock(raw, excluded_parents=STOCK_EXCLUDED_PARENTS)


@register("campaign_trackings")
def q_campaign_trackings(raw: Raw) -> DataFrame:
    return P.campaign_trackings(raw)


@register("upsert_single_key", needs_spark=True)
def q_upsert_single(spark: SparkSession, raw: Raw) -> DataFrame:
    facts = L.stage_tables(spark, {"orders": O.orders_fact(raw, CUTOFF)})["orders"]
    return L.upsert_single_key(raw, CUTOFF, facts)


@register("upsert_compound_key", needs_spark=True)
def q_upsert_compound(spark: SparkSession, raw: Raw) -> DataFrame:
    items = L.stage_tables(spark, {"items": I.order_items(raw, CUTOFF, excluded=ITEM_EXCLUDED)})["items"]
    return L.upsert_compound_key(raw, CUTOFF, ITEM_EXCLUDED, items)


@register("upsert_keep_newest", needs_spark=True)
def q_upsert_newest(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.upsert_keep_newest(spark, raw, CUTOFF)


@register("upsert_one")
def q_upsert_one(raw: Raw) -> DataFrame:
    return L.upsert_one_table(raw)


@register("align_overflow")
def q_overflow(raw: Raw) -> DataFrame:
    return L.overflow_counts(raw, CUTOFF)


@register("refresh_lookups", needs_spark=True)
def q_refresh(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.refresh_counts(spark, raw)


@register("upsert_many_report", needs_spark=True)
def q_upsert_many(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.upsert_many_report(spark, raw, CUTOFF, ITEM_EXCLUDED,
                                STOCK_EXCLUDED_PARENTS, HOSTS)


@register("fk_violations", needs_spark=True)
def q_fk(spark: SparkSession, raw: Raw) -> DataFrame:
    v = L.key_violations(spark, raw, CUTOFF, ITEM_EXCLUDED, STOCK_EXCLUDED_PARENTS, HOSTS)
    return v.where(~F.col("rule").startswith("unique")).groupBy("table", "rule").agg(
        F.count(F.lit(1)).alias("violations"))


@register("unique_violations", needs_spark=True)
def q_unique(spark: SparkSession, raw: Raw) -> DataFrame:
    v = L.key_violations(spark, raw, CUTOFF, ITEM_EXCLUDED, STOCK_EXCLUDED_PARENTS, HOSTS)
    return v.where(F.col("rule").startswith("unique")).select("table", "rule", "key_text", "detail")


@register("align_to_schema")
def q_align(raw: Raw) -> DataFrame:
    return align(O.orders_fact(raw, CUTOFF), schemas.SPECS_LATEST["orders"], on_overflow="null")


@register("schema_evolution")
def q_schema_evolution(raw: Raw) -> DataFrame:
    return L.schema_evolution(raw)


@register("schema_evolution_orders")
def q_evolve_orders(raw: Raw) -> DataFrame:
    return L.schema_evolution_orders(raw, CUTOFF)


@register("schema_evolution_customers")
def q_evolve_customers(raw: Raw) -> DataFrame:
    return L.schema_evolution_customers(raw, CUTOFF)


@register("empty_to_null")
def q_empty_to_null(raw: Raw) -> DataFrame:
    return L.empty_to_null_addresses(raw, CUTOFF)


@register("stock_snapshots", needs_spark=True)
def q_stock_snapshots(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.stock_snapshots(spark, raw, STOCK_EXCLUDED_PARENTS)


@register("csv_round_trip", needs_spark=True)
def q_csv(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.csv_round_trip(spark, raw, CUTOFF)


@register("sql_dump_rows", needs_spark=True)
def q_dump(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.sql_dump_rows(spark, raw)


@register("sql_dump_errors", needs_spark=True)
def q_dump_errors(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.sql_dump_errors(spark, raw)


@register("sql_dump_in_order", needs_spark=True)
def q_dump_in_order(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.sql_dump_in_order(spark, raw)


@register("sql_dump_duplicates", needs_spark=True)
def q_dump_duplicates(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.sql_dump_duplicates(spark, raw)


@register("upsert_changed_buckets", needs_spark=True)
def q_changed_buckets(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.upsert_changed_buckets(spark, raw, CUTOFF)


@register("snapshot_changes", needs_spark=True)
def q_snapshot_changes(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.snapshot_change_counts(spark, raw)


@register("stored_versions", needs_spark=True)
def q_stored_versions(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.stored_versions(spark, raw, HOSTS)


@register("changed_key_report", needs_spark=True)
def q_changed_keys(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.changed_key_report(spark, raw, CUTOFF, ITEM_EXCLUDED, STOCK_EXCLUDED_PARENTS, HOSTS)


@register("run_day", needs_spark=True)
def q_run_day(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.daily_tables(spark, raw, CUTOFF, ITEM_EXCLUDED, STOCK_EXCLUDED_PARENTS, HOSTS)


@register("orders_sorted_files", needs_spark=True)
def q_sorted_files(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.sorted_files(spark, raw, CUTOFF)


@register("delivered_returned_zone")
def q_pairs_zone(raw: Raw) -> DataFrame:
    return I.delivered_returned_pairs(raw.attributes("order_itemmeta", I.NUMBERED_KEYS), zone="Europe/Berlin")


@register("scan_snapshot", needs_spark=True)
def q_scan_snapshot(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.scan_snapshot(spark, raw)


@register("pending_dates", needs_spark=True)
def q_pending_dates(spark: SparkSession, raw: Raw) -> DataFrame:
    return L.pending_order_days(spark, raw, CUTOFF)


# ---- single operators -----------------------------------------------------------

@register("orders_completed")
def q_orders_completed(raw: Raw) -> DataFrame:
    return completed_orders(raw.posts, CUTOFF)


@register("orders_cutoff_variants")
def q_cutoff_variants(raw: Raw) -> DataFrame:
    flags = [
        order_filter(CUTOFF).alias("in_orders"),
        order_filter(CUTOFF, require_type=False).alias("in_customers"),
        order_filter(CUTOFF, require_type=False, strict_after=True).alias("in_items"),
        order_filter(None, require_type=False).alias("in_last_order"),
    ]
    return raw.posts.select("ID", *flags).where("in_orders OR in_customers OR in_items OR in_last_order")


@register("delivered_keys_like")
def q_delivered_like(raw: Raw) -> DataFrame:
    return eav_keys_like(raw.attributes("order_itemmeta", [I.DELIVERED_LIKE]), I.DELIVERED_LIKE).select("order_item_id", "meta_key", "meta_value")


@register("key_in_list")
def q_key_in_list(raw: Raw) -> DataFrame:
    return select_keys(raw.attributes("postmeta", O.ORDER_KEYS), list(O.ORDER_KEYS)).groupBy("meta_key").agg(F.count(F.lit(1)).alias("n"))


@register("exclude_ids")
def q_exclude_ids(raw: Raw) -> DataFrame:
    return raw.posts.where((F.col("post_type") == "product") & ~F.col("ID").isin(list(STOCK_EXCLUDED_PARENTS))) \
                    .select("ID", "post_status")


@register("orders_net_amounts")
def q_net_amounts(raw: Raw) -> DataFrame:
    return O.orders_fact(raw, CUTOFF).select("id", "order_total", "order_tax", "order_net",
                                              "subtotal", "subtotal_tax", "subtotal_net")


@register("return_flag")
def q_return_flag(raw: Raw) -> DataFrame:
    return I.delivered_returned_pairs(raw.attributes("order_itemmeta", I.NUMBERED_KEYS)).select("order_item_id", "subqty_id", "is_retoure")


@register("eav_lookup_left")
def q_eav_lookup(raw: Raw) -> DataFrame:
    orders = raw.posts.where(F.col("post_type") == "shop_order").select("ID")
    return eav_lookup(orders, "ID", raw.attributes("postmeta", ["_payment_method"]), "post_id", {"_payment_method": "payment_method"})


@register("eav_pivot_orders")
def q_pivot_orders(raw: Raw) -> DataFrame:
    return eav_pivot(raw.attributes("postmeta", O.ORDER_KEYS), "post_id", O.ORDER_KEYS)


@register("eav_pivot_items")
def q_pivot_items(raw: Raw) -> DataFrame:
    return eav_pivot(raw.attributes("order_itemmeta", I.ITEM_KEYS), "order_item_id", I.ITEM_KEYS)


@register("order_subtotals")
def q_order_subtotals(raw: Raw) -> DataFrame:
    return O.order_subtotals(raw.order_items, raw.attributes("order_itemmeta", O.ITEM_SUBTOTAL_KEYS))


@register("products_last_order")
def q_products_last_order(raw: Raw) -> DataFrame:
    return P.products(raw).select("id", "last_order_at")


@register("customer_first_last_order")
def q_first_last(raw: Raw) -> DataFrame:
    return O.customer_first_last_order(raw, CUTOFF)


@register("term_lookup")
def q_term_lookup(raw: Raw) -> DataFrame:
    return term_links(raw.term_relationships, raw.term_taxonomy, raw.terms).select(
        "object_id", "taxonomy", "term_taxonomy_id", "name", "slug")


@register("last_billing_address")
def q_last_billing(raw: Raw) -> DataFrame:
    users = raw.users.select(F.col("ID").alias("id"))
    return O.last_billing_address(users, O.orders_fact(raw, CUTOFF))


@register("address_key_two_ways")
def q_address_key_two_ways(raw: Raw) -> DataFrame:
    return O.address_key_two_ways(raw, CUTOFF)


@register("address_key")
def q_address_key(raw: Raw) -> DataFrame:
    return O.addresses(raw, CUTOFF).select("type", "id")


@register("orders_sorted")
def q_orders_sorted(raw: Raw) -> DataFrame:
    return O.orders_fact(raw, CUTOFF).select("id", "customer_id", "order_date").orderBy("id")


@register("first_category")
def q_first_category(raw: Raw) -> DataFrame:
    return P.parent_terms(raw).select("object_id", "category")


@register("value_or_default")
def q_value_or_default(raw: Raw) -> DataFrame:
    orders = raw.posts.where(F.col("post_type") == "shop_order").select("ID")
    j = eav_lookup(orders, "ID", raw.attributes("postmeta", ["_payment_method"]), "post_id", {"_payment_method": "pm"})
    return j.select("ID", value_or_default("pm", "NONE").alias("payment_method"))


@register("lenient_numbers")
def q_lenient_numbers(raw: Raw) -> DataFrame:
    v = F.col("meta_value")
    return raw.postmeta.select("post_id", "meta_key", lenient_decimal(v, 12, 2).alias("as_decimal"),
                               lenient_long(v).alias("as_long"), is_number(v).alias("is_number"))


@register("order_taxes")
def q_order_taxes(raw: Raw) -> DataFrame:
    return O.orders_fact(raw, CUTOFF).select("id", "order_tax", "discount_tax")


@register("text_cleanup")
def q_text_cleanup(raw: Raw) -> DataFrame:
    return raw.terms.select("term_id", F.replace(F.col("name"), F.lit(AMP), F.lit("")).alias("clean_name"))


def queries() -> dict[str, QueryFn]:
    def bind(name, fn):
        if name in _NEEDS_SPARK:
            return lambda spark, sf_dir: fn(spark, raw_from_star(spark, sf_dir))
        return lambda spark, sf_dir: fn(raw_from_star(spark, sf_dir))
    return {n: bind(n, fn) for n, fn in _QUERIES.items()}
