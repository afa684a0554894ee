"""Order items: one row per item and delivered number."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lenient_decimal, lenient_long, money, per_unit
from ..operators.eav import eav_numbered, eav_pivot
from ..operators.filters import DEFAULT_CUTOFF, completed_orders
from ..sources.fixture_star import Raw

# Fixed values of the shop: product ids that are never a real product, the
# first real product id and the placeholder product.
EXCLUDED_PRODUCT_IDS = (9666, 9921, 9922, 13925, 13927, 14170, 18551, 18660, 32942)
FIRST_PRODUCT_ID = 7297
PLACEHOLDER_PRODUCT_ID = 7294
DELIVERED_PREFIX = "_delivered_"
RETURNED_PREFIX = "_returned_"
DELIVERED_LIKE = "_delivered_%"   # LIKE: the leading '_' matches any one character
NUMBERED_KEYS = [DELIVERED_LIKE, f"{RETURNED_PREFIX}%"]

ITEM_KEYS = {
    "_line_subtotal": "line_subtotal",
    "_line_subtotal_tax": "line_subtotal_tax",
    "_line_total": "line_total",
    "_line_tax": "line_tax",
    "_qty": "qty",
    "_product_id": "product_ref",
    "_variation_id": "variation_ref",
}


def epoch_text_to_date(c: Column | str, zone: str | None = None) -> Column:
    """``CAST(FROM_UNIXTIME(text) AS DATE)`` in ``zone`` (its summer time included), by default
    the session zone (UTC)."""
    at = F.timestamp_seconds(lenient_long(c))
    return F.to_date(at if zone is None else F.convert_timezone(F.lit("UTC"), F.lit(zone), at.cast("timestamp_ntz")))


def delivered_returned_pairs(itemmeta: DataFrame, on_duplicate: str = "error", zone: str | None = None) -> DataFrame:
    """``order_item_id, subqty_id, delivered_on, returned_on, is_retoure``.

    ``subqty_id`` is the key text after removing ``_delivered_``; the return
    must sit under ``_returned_<that text>``.  ``is_retoure`` is true only when
    both dates exist and delivered >= returned.  A repeated delivered key gives
    a row each; a repeated returned key fails the job (``'max'``: the latest).
    ``zone`` is the time zone whose calendar the dates follow (default UTC).
    """
    p = eav_numbered(itemmeta, "order_item_id", DELIVERED_PREFIX, RETURNED_PREFIX,
                     number_col="subqty", first_name="delivered", second_name="returned",
                     like_pattern=DELIVERED_LIKE, on_duplicate=on_duplicate)
    d, r = epoch_text_to_date("delivered", zone), epoch_text_to_date("returned", zone)
    return p.select(
        "order_item_id",
        F.col("subqty").try_cast("bigint").alias("subqty_id"),
        d.alias("delivered_on"),
        r.alias("returned_on"),
    ).withColumn("is_retoure", return_flag(F.col("delivered_on"), F.col("returned_on")))


def return_flag(delivered: Column, returned: Column) -> Column:
    """``IF(delivered >= returned, TRUE, FALSE)``: a NULL comparison is false."""
    return F.when(delivered >= returned, F.lit(True)).otherwise(F.lit(False))


def product_choice(variation: Column, product: Column, *,
                   excluded: Iterable[int] = EXCLUDED_PRODUCT_IDS,
                   first_id: int = FIRST_PRODUCT_ID,
                   placeholder: int = PLACEHOLDER_PRODUCT_ID) -> Column:
    """Variation id if it is a real product, else the product id, else the placeholder.

    Both ids must be present, one of them >= ``first_id`` and neither in
    ``excluded``; otherwise the placeholder.  Text ids compare by the value of
    their numeric prefix (``'7.3e3'`` is 7300); the chosen one loses its fraction.
    """
    return _chosen(lenient_decimal(variation, 38, 10), lenient_decimal(product, 38, 10), excluded, first_id, placeholder)


def _chosen(v: Column, p: Column, excluded: Iterable[int], first_id: int, placeholder: int) -> Column:
    """``product_choice`` of ids that are numbers."""
    ex = [F.lit(i).cast("decimal(38,10)") for i in excluded]
    ok = (v.isNotNull() & p.isNotNull() & ((v >= first_id) | (p >= first_id))
          & ~v.isin(ex) & ~p.isin(ex))
    chosen = F.when(v >= first_id, v).when(p >= first_id, p).otherwise(F.lit(first_id).cast("decimal(38,10)"))
    return F.when(ok, chosen.try_cast("bigint")).otherwise(F.lit(placeholder).cast("bigint"))


def item_amounts(itemmeta: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """Per-unit price, tax and discounts of every item (``order_item_id`` keyed)."""
    a = eav_pivot(itemmeta, "order_item_id", ITEM_KEYS, on_duplicate=on_duplicate)
    # each text is read once, below the columns that use it
    numbers = ["qty", "line_subtotal", "line_subtotal_tax", "line_total", "line_tax"]
    a = a.select("order_item_id", "product_ref", "variation_ref", *[lenient_decimal(n).alias(n) for n in numbers])
    qty, sub, sub_tax, tot, tot_tax = (F.col(n) for n in numbers)
    price_net = per_unit(sub, qty)
    price_tax = per_unit(sub_tax, qty)
    # discount = (discounted total - undiscounted subtotal) / qty, so <= 0
    discount_net = per_unit(tot - sub, qty)
    discount_tax = per_unit(tot_tax - sub_tax, qty)
    return a.select(
        "order_item_id", "product_ref", "variation_ref",
        price_net.alias("price_net"), price_tax.alias("price_tax"),
        discount_net.alias("discount_net"), discount_tax.alias("discount_tax"),
    ).select(
        "*",
        money(F.col("price_net") + F.col("discount_net")).alias("payment_net"),
        money(F.col("price_tax") + F.col("discount_tax")).alias("payment_tax"),
    )


def order_items(raw: Raw, cutoff: str = DEFAULT_CUTOFF, *,
                excluded: Iterable[int] = EXCLUDED_PRODUCT_IDS, on_duplicate: str = "error") -> DataFrame:
    """Items of completed orders after ``cutoff`` (strictly later, no type test),
    one row per delivered number."""
    orders = completed_orders(raw.posts, cutoff, require_type=False, strict_after=True)
    items = raw.order_items.join(orders, raw.order_items.order_id == orders.ID, "left_semi")
    pairs = delivered_returned_pairs(raw.attributes("order_itemmeta", NUMBERED_KEYS), on_duplicate)
    amounts = item_amounts(raw.attributes("order_itemmeta", ITEM_KEYS), on_duplicate)
    for ref in ("variation_ref", "product_ref"):
        amounts = amounts.withColumn(ref, lenient_decimal(ref, 38, 10))
    j = items.join(pairs, "order_item_id").join(amounts, "order_item_id", "left")
    return j.select(
        "order_item_id", "order_id", "subqty_id", "delivered_on", "returned_on", "is_retoure",
        _chosen(F.col("variation_ref"), F.col("product_ref"), excluded, FIRST_PRODUCT_ID, PLACEHOLDER_PRODUCT_ID).alias("product_id"),
        F.col("order_item_name").alias("product_name"),
        "price_net", "price_tax", "discount_net", "discount_tax", "payment_net", "payment_tax",
    )
