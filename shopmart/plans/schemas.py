"""Target schemas of the reporting tables, by schema version (1-4), with
keys and foreign keys.  Versions only add columns (and, in 4, a table)."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DecimalType, IntegerType, StringType, StructField, StructType,
                               TimestampNTZType)

from ..operators.load import TableSpec

S, I, TS, B = StringType(), IntegerType(), TimestampNTZType(), BooleanType()
MONEY = DecimalType(8, 2)
KEY = DecimalType(20, 0)


def _f(name, t):
    return StructField(name, t, True)


ADDRESSES_V1 = StructType([_f("type", S), _f("customer_id", I), _f("address1", S), _f("address2", S),
                           _f("company", S), _f("firstname", S), _f("lastname", S), _f("zipcode", S),
                           _f("city", S), _f("state", S), _f("country", S), _f("id", KEY)])
ORDERS_V1 = StructType([_f("id", I), _f("customer_id", I), _f("order_date", TS), _f("order_completed_date", TS),
                        _f("payment_method", S)] +
                       [_f(n, MONEY) for n in ["order_total", "order_tax", "order_net", "discount_net",
                                               "discount_tax", "subtotal", "subtotal_tax", "subtotal_net"]] +
                       [_f("billig_address_id", KEY), _f("shipping_address_id", KEY)])
ORDERS_V4_ADD = [_f("last_contact_campaign_id", I), _f("first_contact_campaign_id", I),
                 _f("last_contact_campaign_recorded_at", TS), _f("first_contact_campaign_recorded_at", TS)]
CUSTOMERS_V1 = StructType([_f("id", I), _f("firstname", S), _f("lastname", S), _f("phone", S), _f("email", S),
                           _f("registered_date", TS), _f("first_order_id", I), _f("first_order_date", TS),
                           _f("origin", S), _f("last_billing_address_id", KEY)])
CUSTOMERS_V3_ADD = [_f("last_order_id", I), _f("last_order_date", TS)]
PRODUCTS_V1 = StructType([_f("id", I), _f("name", S), _f("parent_id", I), _f("thumbnail_id", I),
                          _f("primary_category", S), _f("super_category", S), _f("uvp", MONEY),
                          _f("cost_of_goods", MONEY), _f("color", S), _f("brand", S), _f("order_season", S),
                          _f("season_fruehling", B), _f("season_sommer", B), _f("season_herbst", B),
                          _f("season_winter", B), _f("size", S), _f("size_shopfilter", S),
                          _f("item_condition", S), _f("created_at", TS), _f("updated_at", TS)])
PRODUCTS_V2_ADD = [_f("thumbnail_url", S), _f("sex", S), _f("category", S)]
PRODUCTS_V3_ADD = [_f("last_order_at", TS)]
ORDERS_PRODUCTS_V1 = StructType([_f("order_item_id", I), _f("order_id", I), _f("subqty_id", I),
                                 _f("delivered_on", TS), _f("returned_on", TS), _f("is_retoure", B),
                                 _f("product_id", I), _f("product_name", S)] +
                                [_f(n, MONEY) for n in ["price_net", "price_tax", "discount_net",
                                                        "discount_tax", "payment_net", "payment_tax"]])
STOCK_V1 = StructType([_f("product_id", I), _f("stock", I), _f("purchased_stock", I), _f("record_timestamp", TS)])
CAMPAIGN_TRACKINGS_V4 = StructType([_f("id", I)] + [_f(n, S) for n in
                                   ["utm_medium", "utm_source", "utm_campaign", "utm_term", "utm_content"]])


def _add(st: StructType, fields) -> StructType:
    return StructType(list(st.fields) + list(fields))


# table -> schema at versions 1..4 (None: table not there yet)
VERSIONS: dict[str, list[StructType | None]] = {
    "addresses": [ADDRESSES_V1] * 4,
    "orders": [ORDERS_V1, ORDERS_V1, ORDERS_V1, _add(ORDERS_V1, ORDERS_V4_ADD)],
    "customers": [CUSTOMERS_V1, CUSTOMERS_V1, _add(CUSTOMERS_V1, CUSTOMERS_V3_ADD), _add(CUSTOMERS_V1, CUSTOMERS_V3_ADD)],
    "products": [PRODUCTS_V1, _add(PRODUCTS_V1, PRODUCTS_V2_ADD),
                 _add(_add(PRODUCTS_V1, PRODUCTS_V2_ADD), PRODUCTS_V3_ADD),
                 _add(_add(PRODUCTS_V1, PRODUCTS_V2_ADD), PRODUCTS_V3_ADD)],
    "orders_products": [ORDERS_PRODUCTS_V1] * 4,
    "stock": [STOCK_V1] * 4,
    "campaign_trackings": [None, None, None, CAMPAIGN_TRACKINGS_V4],
}
LATEST = 4


def spec(name: str, version: int = LATEST) -> TableSpec:
    schema = VERSIONS[name][version - 1]
    if schema is None:
        raise ValueError(f"table {name} does not exist at schema version {version}")
    return SPECS_LATEST[name].__class__(
        name=name, schema=schema, key=SPECS_LATEST[name].key, unique=SPECS_LATEST[name].unique,
        foreign_keys=[fk for fk in SPECS_LATEST[name].foreign_keys
                      if all(c in schema.fieldNames() for c in fk[0])],
        renames=SPECS_LATEST[name].renames)


SPECS_LATEST: dict[str, TableSpec] = {
    "addresses": TableSpec("addresses", VERSIONS["addresses"][3], key=["id"],
                           foreign_keys=[(["customer_id"], "customers", ["id"])]),
    "orders": TableSpec("orders", VERSIONS["orders"][3], key=["id"],
                        foreign_keys=[(["billig_address_id"], "addresses", ["id"]),
                                      (["shipping_address_id"], "addresses", ["id"]),
                                      (["last_contact_campaign_id"], "campaign_trackings", ["id"]),
                                      (["first_contact_campaign_id"], "campaign_trackings", ["id"])],
                        renames={"billing_address_id": "billig_address_id"}),
    "customers": TableSpec("customers", VERSIONS["customers"][3], key=["id"],
                           foreign_keys=[(["first_order_id"], "orders", ["id"]),
                                         (["last_billing_address_id"], "addresses", ["id"])]),
    "products": TableSpec("products", VERSIONS["products"][3], key=["id"]),
    "orders_products": TableSpec("orders_products", VERSIONS["orders_products"][3],
                                 unique=[["order_item_id", "subqty_id"]],
                                 foreign_keys=[(["product_id"], "products", ["id"]),
                                               (["order_id"], "orders", ["id"])]),
    "stock": TableSpec("stock", VERSIONS["stock"][3], foreign_keys=[(["product_id"], "products", ["id"])]),
    "campaign_trackings": TableSpec("campaign_trackings", VERSIONS["campaign_trackings"][3], key=["id"]),
}
