"""Orders, addresses and customers data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (address_key, lenient_decimal, lenient_long, lenient_round,
                         lenient_timestamp, money, value_or_default)
from ..functions.keys import KEY_TYPE, hex_prefix_to_unsigned
from ..operators.eav import eav_pivot
from ..operators.filters import DEFAULT_CUTOFF, ORDER_TYPE, completed_orders
from ..sources.fixture_star import Raw

# Order attribute keys of the shop.
ORDER_KEYS = {
    "_customer_user": "customer_user",
    "_completed_date": "completed_date",
    "_payment_method": "payment_method",
    "_order_total": "order_total",
    "_order_tax": "order_tax",
    "_cart_discount": "cart_discount",
    "_cart_discount_tax": "cart_discount_tax",
    "_last_contact_campaign_id": "last_contact_campaign_id",
    "_first_contact_campaign_id": "first_contact_campaign_id",
    "_last_contact_campaign_recorded_at": "last_contact_campaign_recorded_at",
    "_first_contact_campaign_recorded_at": "first_contact_campaign_recorded_at",
}
# Address parts in key order (the order and case are part of
# the key), with the output column names.
ADDRESS_PARTS = [
    ("address_1", "address1"), ("address_2", "address2"), ("company", "company"),
    ("first_name", "firstname"), ("last_name", "lastname"), ("postcode", "zipcode"),
    ("city", "city"), ("state", "state"), ("country", "country"),
]
ADDRESS_TYPES = ["billing", "shipping"]
ITEM_SUBTOTAL_KEYS = {"_line_subtotal": "subtotal", "_line_subtotal_tax": "subtotal_tax"}


def address_meta_keys() -> dict[str, str]:
    return {f"_{t}_{p}": f"{t}_{p}" for t in ADDRESS_TYPES for p, _ in ADDRESS_PARTS}


ORIGIN_KEYS = {"customer_origin": "origin"}


def order_attributes(raw: Raw, on_duplicate: str = "error") -> DataFrame:
    """One pivot of all order, address and origin attributes, keyed by ``post_id``.

    Orders, addresses and customers read it; stage it in the shared folder
    when several of them are built in one job.
    """
    keys = {**ORDER_KEYS, **address_meta_keys(), **ORIGIN_KEYS}
    return eav_pivot(raw.attributes("postmeta", keys), "post_id", keys, on_duplicate=on_duplicate)


def address_key_of(t: str) -> F.Column:
    return address_key([F.col("customer_user")] + [F.col(f"{t}_{p}") for p, _ in ADDRESS_PARTS], t)


def order_subtotals(order_items: DataFrame, order_itemmeta: DataFrame) -> DataFrame:
    """``order_id``, subtotal and subtotal tax: item amounts summed per order.

    Each amount is read as decimal(10,4), summed, then cast to decimal(10,2);
    NULL when the order has no such amount.
    """
    m = order_itemmeta.where(F.col("meta_key").isin(list(ITEM_SUBTOTAL_KEYS)))
    j = m.join(order_items.select("order_item_id", "order_id"), "order_item_id")
    aggs = [money(F.sum(F.when(F.col("meta_key") == k, lenient_decimal("meta_value", 10, 4)))).alias(n)
            for k, n in ITEM_SUBTOTAL_KEYS.items()]
    return j.groupBy("order_id").agg(*aggs)


def orders_fact(raw: Raw, cutoff: str = DEFAULT_CUTOFF, on_duplicate: str = "error",
                attributes: DataFrame | None = None) -> DataFrame:
    """Completed orders since ``cutoff`` with money, address keys and campaigns."""
    orders = completed_orders(raw.posts, cutoff)
    attrs = attributes if attributes is not None else order_attributes(raw, on_duplicate)
    # the keys are taken below the join, so that the address parts are not shuffled
    attrs = attrs.select("post_id", *ORDER_KEYS.values(), *[address_key_of(t).alias(f"{t}_address_id") for t in ADDRESS_TYPES])
    subs = order_subtotals(raw.order_items, raw.attributes("order_itemmeta", ITEM_SUBTOTAL_KEYS))
    j = (orders.join(attrs, orders.ID == attrs.post_id, "left")
               .join(subs, orders.ID == subs.order_id, "left"))
    j = j.withColumns({"order_total": lenient_decimal("order_total", 10, 2), "order_tax": lenient_round("order_tax", 2)})
    total, tax = F.col("order_total"), F.col("order_tax")
    return j.select(
        F.col("ID").alias("id"),
        lenient_long("customer_user").alias("customer_id"),
        F.col("post_date").alias("order_date"),
        lenient_timestamp("completed_date").alias("order_completed_date"),
        value_or_default("payment_method", "NONE").alias("payment_method"),
        total.alias("order_total"),
        tax.alias("order_tax"),
        money(total - tax).alias("order_net"),
        lenient_decimal("cart_discount", 10, 2).alias("discount_net"),
        lenient_round("cart_discount_tax", 2).alias("discount_tax"),
        F.col("subtotal"),
        F.col("subtotal_tax"),
        money(F.col("subtotal") - F.col("subtotal_tax")).alias("subtotal_net"),
        "billing_address_id", "shipping_address_id",
        lenient_long("last_contact_campaign_id").alias("last_contact_campaign_id"),
        lenient_long("first_contact_campaign_id").alias("first_contact_campaign_id"),
        lenient_timestamp("last_contact_campaign_recorded_at").alias("last_contact_campaign_recorded_at"),
        lenient_timestamp("first_contact_campaign_recorded_at").alias("first_contact_campaign_recorded_at"),
    )


def addresses(raw: Raw, cutoff: str = DEFAULT_CUTOFF, on_duplicate: str = "error",
              attributes: DataFrame | None = None) -> DataFrame:
    """Distinct billing and shipping addresses of completed orders.

    Rows whose key is NULL (no address attribute at all) are left out, so
    every address key of ``orders_fact`` is present here.
    """
    orders = completed_orders(raw.posts, cutoff)
    attrs = attributes if attributes is not None else order_attributes(raw, on_duplicate)
    j = orders.join(attrs, orders.ID == attrs.post_id, "left")
    # both address rows of an order from one pass over the join
    both = F.array(*[
        F.struct(F.lit(t).alias("type"),
                 lenient_long("customer_user").alias("customer_id"),
                 *[F.col(f"{t}_{p}").alias(n) for p, n in ADDRESS_PARTS],
                 address_key_of(t).alias("id"))
        for t in ADDRESS_TYPES])
    # UNION = distinct over all columns: one hash aggregate, partial before the shuffle
    return j.select(F.inline(both)).where(F.col("id").isNotNull()).distinct()


USER_KEYS = {"billing_first_name": "firstname", "billing_last_name": "lastname", "billing_phone": "phone"}


def customer_first_last_order(raw: Raw, cutoff: str = DEFAULT_CUTOFF, users: DataFrame | None = None) -> DataFrame:
    """First and last completed order of each customer in ONE aggregate.

    ``customer_user`` (text, as stored), first/last order id and date.
    ``users`` (post_id, customer_user) replaces the scan of that attribute.
    """
    completed = raw.posts.where(
        (F.col("post_status") == "wc-completed") & (F.col("post_date") >= F.lit(cutoff).cast("timestamp_ntz"))
    ).select("ID", "post_date")
    if users is None:
        users = raw.attributes("postmeta", ["_customer_user"]).where(F.col("meta_key") == "_customer_user").select(
            "post_id", F.col("meta_value").alias("customer_user"))
    j = users.join(completed, users.post_id == completed.ID)
    return j.groupBy("customer_user").agg(
        F.min("post_id").alias("first_order_id"),
        F.min_by("post_date", "post_id").alias("first_order_date"),
        F.max("post_id").alias("last_order_id"),
        F.max_by("post_date", "post_id").alias("last_order_date"),
    )


def last_billing_address(customers: DataFrame, orders: DataFrame, *,
                         customer_key: str = "id", address_col: str = "billing_address_id") -> DataFrame:
    """Set ``last_billing_address_id`` = billing address of the customer's highest order id.

    One aggregate over orders (``max_by`` keeps the address of the max id,
    NULL included) and a left join: customers without orders get NULL.
    """
    last = orders.groupBy(F.col("customer_id").alias("_cid")).agg(
        F.max_by(F.col(address_col), F.col("id")).alias("_last_addr"))
    out = customers.join(last, customers[customer_key] == last["_cid"], "left")
    cols = [c for c in customers.columns if c != "last_billing_address_id"]
    return out.select(*[customers[c] for c in cols],
                      F.col("_last_addr").cast(KEY_TYPE).alias("last_billing_address_id"))


def customers(raw: Raw, cutoff: str = DEFAULT_CUTOFF, on_duplicate: str = "error",
              attributes: DataFrame | None = None, last_address: bool = True) -> DataFrame:
    """Users with at least one completed order since ``cutoff``.

    One pass over the orders' attributes: a single aggregate by customer keeps
    the first order (id, date, origin), the last order and the billing address
    of the highest order id, which is the state after the load's post step.
    ``last_address=False`` leaves the address out, for a load that runs that
    step itself.
    """
    completed = raw.posts.where(
        (F.col("post_status") == "wc-completed") & (F.col("post_date") >= F.lit(cutoff).cast("timestamp_ntz"))
    ).select("ID", "post_date", F.col("post_type").alias("_type"))
    attrs = attributes if attributes is not None else order_attributes(raw, on_duplicate)
    own = attrs.where(F.col("customer_user").isNotNull()).select(
        "post_id", "customer_user", "origin", address_key_of("billing").alias("_address"))
    j = own.join(completed, own.post_id == completed.ID)
    is_order = F.col("_type") == ORDER_TYPE
    fl = j.groupBy("customer_user").agg(
        F.min("post_id").alias("first_order_id"), F.min_by("post_date", "post_id").alias("first_order_date"),
        F.min_by("origin", "post_id").alias("origin"),
        F.max("post_id").alias("last_order_id"), F.max_by("post_date", "post_id").alias("last_order_date"),
        F.max(F.when(is_order, F.struct("post_id", "_address"))).alias("_last"))
    users = raw.users.join(fl, raw.users.ID == lenient_long(fl.customer_user))
    # ids stored as different text ('5', '05') are rows of their own; the last address is the user's
    users = users.withColumn("_last", F.max("_last").over(Window.partitionBy("ID")))
    um = eav_pivot(raw.usermeta, "user_id", USER_KEYS, on_duplicate=on_duplicate)
    out = users.join(um, users.ID == um.user_id, "left")
    address = [F.col("_last._address").cast(KEY_TYPE).alias("last_billing_address_id")] if last_address else []
    return out.select(
        F.col("ID").alias("id"), "firstname", "lastname", "phone",
        F.col("user_email").alias("email"),
        F.col("user_registered").alias("registered_date"),
        "first_order_id", "first_order_date", "last_order_id", "last_order_date", "origin", *address,
    )


def address_key_two_ways(raw: Raw, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Billing and shipping keys of each completed order computed from the
    pivoted columns (``concat_ws``) and from the attribute rows (text list in
    key order), side by side.  Both give NULL for an order with no address
    attribute; otherwise they agree unless a key is duplicated."""
    orders = completed_orders(raw.posts, cutoff)
    by_cols = orders_fact(raw, cutoff).select("id", "billing_address_id", "shipping_address_id")
    out = by_cols
    for t in ADDRESS_TYPES:
        keys = ["_customer_user"] + [f"_{t}_{p}" for p, _ in ADDRESS_PARTS]
        pos = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("meta_key"))
        rows = (raw.attributes("postmeta", keys).where(F.col("meta_key").isin(keys))
                .join(orders, F.col("post_id") == orders.ID, "left_semi")
                .groupBy("post_id")
                .agg(F.array_sort(F.collect_list(F.struct(pos.alias("p"), F.col("meta_value").alias("v")))).alias("l")))
        text = F.concat(F.array_join(F.transform("l", lambda x: x["v"]), ","), F.lit(f",{t}"))
        k = rows.select(F.col("post_id").alias(f"_{t}_pid"), hex_prefix_to_unsigned(F.sha1(text)).alias(f"{t}_key_by_rows"))
        out = out.join(k, out.id == k[f"_{t}_pid"], "left").drop(f"_{t}_pid")
    return out
