"""DuckDB text of the star -> shop projection (same rules as
``sources/fixture_star.py``) and SQL helpers for the lenient casts.

Each oracle query is ``WITH <raw CTEs> <query>``; DuckDB inlines only the
CTEs a query references.
"""

from __future__ import annotations

# Fixed patterns (same as functions/lenient.py).
NUMERIC_PREFIX = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)"
INTEGER_PREFIX = r"^\s*([+-]?\d+)"


def ldec(x: str, p: int = 10, s: int = 2) -> str:
    pre = f"regexp_extract({x}, '{NUMERIC_PREFIX}', 1)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {pre} = '' THEN CAST(0 AS DECIMAL({p},{s})) "
            f"ELSE TRY_CAST({pre} AS DECIMAL({p},{s})) END)")


def llong(x: str) -> str:
    pre = f"regexp_extract({x}, '{INTEGER_PREFIX}', 1)"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {pre} = '' THEN CAST(0 AS BIGINT) "
            f"ELSE TRY_CAST({pre} AS BIGINT) END)")


def lround(x: str, d: int = 2) -> str:
    return f"TRY_CAST(round({ldec(x, 38, 10)}, {d}) AS DECIMAL(10,{d}))"


def lts(x: str) -> str:
    return f"TRY_CAST({x} AS TIMESTAMP)"


def key_of(text: str) -> str:
    return f"CAST(('0x' || substr(sha1({text}), 1, 16))::UBIGINT AS DECIMAL(20,0))"


def kv(pairs: list[tuple[str, str]]) -> str:
    items = ", ".join(f"{{'meta_key': {k}, 'meta_value': CAST({v} AS VARCHAR)}}" for k, v in pairs)
    return f"[{items}]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_ADDR_COMMON = [
    ("address_1", "'Street ' || c_custkey"),
    ("address_2", "CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'Apt ' || (c_custkey % 10) END"),
    ("company", "''"),
    ("first_name", "split_part(c_name, '#', 1)"),
    ("last_name", "split_part(c_name, '#', 2)"),
    ("postcode", "lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')"),
]
_STATE = "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END"
_BILLING = _ADDR_COMMON + [("city", "n_name || ' City'"), ("state", _STATE), ("country", "n_name")]
_SHIPPING = _ADDR_COMMON + [
    ("city", "CASE WHEN o_orderkey % 4 = 0 THEN n_name || ' Harbor ' || (o_orderkey % 3) ELSE n_name || ' City' END"),
    ("state", _STATE), ("country", "n_name"),
]
_DISC = "CAST((o_orderkey % 50) * CAST(1.5 AS DECIMAL(2,1)) AS DECIMAL(12,2))"
_TOTAL = "CAST(o_totalprice AS DECIMAL(12,2))"
_TS = "'%Y-%m-%d %H:%M:%S'"


def _odd(n: str) -> str:
    return f"['abc', '12abc', '1e2', '1d'][{n} % 4 + 1]"


_ORDER_PAIRS = [
    ("'_customer_user'", "CASE WHEN o_orderkey % 3 = 1 THEN '0' ELSE CAST(o_custkey AS VARCHAR) END"),
    ("'_completed_date'", f"strftime(o_orderdate + INTERVAL 3 DAY, {_TS})"),
    ("'_payment_method'", "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END"),
    ("'_order_total'", _TOTAL),
    ("'_order_tax'", f"{_TOTAL} * CAST(0.19 AS DECIMAL(2,2))"),
    ("'_cart_discount'", f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST({_DISC} AS VARCHAR) END"),
    ("'_cart_discount_tax'", f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST({_DISC} * CAST(0.19 AS DECIMAL(2,2)) AS VARCHAR) END"),
    ("'_last_contact_campaign_id'", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 500 AS VARCHAR) END"),
    ("'_first_contact_campaign_id'", "CASE WHEN o_orderkey % 2 = 1 THEN NULL ELSE CAST((o_orderkey * 7) % 1000 AS VARCHAR) END"),
    ("'_last_contact_campaign_recorded_at'", f"CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate - INTERVAL 1 DAY, {_TS}) END"),
    ("'_first_contact_campaign_recorded_at'", f"CASE WHEN o_orderkey % 2 = 1 THEN NULL ELSE strftime(o_orderdate - INTERVAL 2 DAY, {_TS}) END"),
    ("'customer_origin'", "CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE lower(c_mktsegment) END"),
] + [(_q(f"_billing_{n}"), v) for n, v in _BILLING] + [(_q(f"_shipping_{n}"), v) for n, v in _SHIPPING]

_VARIATION_PAIRS = [
    ("'_stock'", "p_size"),
    ("'_original_stock'", "CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size + 10 AS VARCHAR) END"),
    ("'attribute_pa_zustand'", "CASE WHEN p_partkey % 3 = 0 THEN 'new' WHEN p_partkey % 3 = 1 THEN 'used' END"),
    ("'attribute_pa_groesse'", "CASE WHEN p_partkey % 2 = 0 AND p_partkey % 7 = 0 THEN 'gr-none' "
                              "WHEN p_partkey % 2 = 0 THEN 'gr-' || p_size END"),
    ("'attribute_pa_kgr'", "CASE WHEN p_partkey % 2 = 1 THEN 'kgr-' || (p_size % 10) END"),
    ("'attribute_pa_kopfumfang'", "CASE WHEN p_partkey % 5 = 0 THEN 'ku-' || (p_size % 6) END"),
]
_RETAIL = "CAST(retail AS DECIMAL(12,2))"
_PARENT_PAIRS = [
    ("'_thumbnail_id'", "CASE WHEN k % 8 = 0 THEN NULL ELSE CAST(31000000 + k AS VARCHAR) END"),
    ("'_uvp'", _RETAIL),
    ("'_cogs'", f"CASE WHEN k % 6 = 0 THEN NULL WHEN k % 5 = 1 THEN {_odd('k')} ELSE CAST({_RETAIL} * CAST(0.4 AS DECIMAL(1,1)) AS VARCHAR) END"),
]
_ITEM_PAIRS = [
    ("'_line_subtotal'", "sub"),
    ("'_line_total'", "line_total"),
    ("'_line_subtotal_tax'", "sub * tax"),
    ("'_line_tax'", "line_total * tax"),
    ("'_qty'", f"CASE WHEN l_orderkey % 41 = 3 THEN {_odd('l_orderkey')} ELSE CAST(qty AS VARCHAR) || CASE WHEN l_orderkey % 2 = 0 THEN '.00' ELSE '' END END"),
    ("'_product_id'", "1000000 + min_partkey // 4"),
    ("'_variation_id'", "CASE WHEN l_orderkey % 13 = 0 THEN '0' WHEN l_orderkey % 29 = 2 THEN '7.3e3' "
                        "WHEN l_orderkey % 13 = 1 THEN '0' || (7200 + min_partkey) ELSE CAST(7200 + min_partkey AS VARCHAR) END"),
]

_ATTR_ID = "(100000000000 + ('0x' || substr(md5(taxonomy || '/' || slug), 1, 10))::BIGINT)"


def _meta(select_from: str, id_expr: str, id_name: str, pairs) -> str:
    return (f"SELECT {id_name}, kv.meta_key AS meta_key, kv.meta_value AS meta_value FROM ("
            f"SELECT CAST({id_expr} AS BIGINT) AS {id_name}, UNNEST({kv(pairs)}) AS kv FROM {select_from}) "
            f"WHERE kv.meta_value IS NOT NULL")


RAW_CTES: dict[str, str] = {
    "x_parents": """
        SELECT p_partkey // 4 AS k, min(p_name) AS title, max(p_retailprice) AS retail,
               CAST(DATE '2015-01-01' + CAST((p_partkey // 4) % 1000 AS INTEGER) AS TIMESTAMP) AS pd
        FROM part GROUP BY p_partkey // 4""",
    "posts": """
        SELECT CAST(10000000 + o_orderkey AS BIGINT) AS ID, 'shop_order' AS post_type,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN 'wc-completed' ELSE 'wc-pending' END AS post_status,
               o_orderdate AS post_date, o_orderdate AS post_modified, 'Order ' || o_orderkey AS post_title,
               CAST(0 AS BIGINT) AS post_parent, CAST(NULL AS VARCHAR) AS guid
        FROM orders
        UNION ALL
        SELECT 7200 + p_partkey, 'product_variation', 'publish',
               CAST(DATE '2015-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP),
               CAST(DATE '2015-01-01' + CAST(p_partkey % 1000 AS INTEGER) AS TIMESTAMP),
               p_name, 1000000 + p_partkey // 4, NULL
        FROM part
        UNION ALL
        SELECT 1000000 + k, 'product', CASE WHEN k % 10 = 9 THEN 'draft' ELSE 'publish' END,
               pd, pd + to_days(CAST(k % 30 AS INTEGER)), title, 0, NULL
        FROM x_parents
        UNION ALL
        SELECT 31000000 + k, 'attachment', 'inherit', pd, pd, 'img ' || k, 1000000 + k,
               'https://old-shop.example/uploads/p' || k || '.jpg'
        FROM x_parents""",
    "postmeta": (
        _meta("orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
              "10000000 + o_orderkey", "post_id", _ORDER_PAIRS)
        + " UNION ALL " + _meta("part", "7200 + p_partkey", "post_id", _VARIATION_PAIRS)
        + " UNION ALL " + _meta("x_parents", "1000000 + k", "post_id", _PARENT_PAIRS)
        + " UNION ALL SELECT 7200 + p_partkey, '_original_stock', CAST(NULL AS VARCHAR) FROM part WHERE p_partkey % 14 = 1"),
    "users": """
        SELECT c_custkey AS ID, lower(replace(c_name, '#', '.')) || '@mail.example' AS user_email,
               CAST(DATE '2010-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS TIMESTAMP) AS user_registered
        FROM customer""",
    "usermeta": _meta("customer", "c_custkey", "user_id", [
        ("'billing_first_name'", "split_part(c_name, '#', 1)"),
        ("'billing_last_name'", "split_part(c_name, '#', 2)"),
        ("'billing_phone'", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE '+49 30 ' || c_custkey END"),
    ]),
    "x_item_groups": """
        SELECT *, CAST(sub * (1 - disc) AS DECIMAL(12,2)) AS line_total FROM (
          SELECT l_orderkey, l_linenumber,
                 CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS sub,
                 max(CAST(l_discount AS DECIMAL(4,2))) AS disc,
                 max(CAST(l_tax AS DECIMAL(4,2))) AS tax,
                 CAST(sum(l_quantity) AS BIGINT) AS qty,
                 min(l_partkey) AS min_partkey
          FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "order_items": """
        SELECT l_orderkey * 8 + l_linenumber AS order_item_id, 10000000 + l_orderkey AS order_id,
               p_name AS order_item_name
        FROM x_item_groups JOIN part ON min_partkey = p_partkey""",
    "order_itemmeta": (
        _meta("x_item_groups", "l_orderkey * 8 + l_linenumber", "order_item_id", _ITEM_PAIRS)
        + " UNION ALL "
        + "SELECT order_item_id, kv.meta_key AS meta_key, kv.meta_value AS meta_value FROM ("
          "SELECT l_orderkey * 8 + l_linenumber AS order_item_id, UNNEST(["
          "{'meta_key': '_delivered_' || n, 'meta_value': CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR)}, "
          "{'meta_key': '_returned_' || n, 'meta_value': CASE WHEN l_returnflag = 'R' THEN "
          "CAST(CAST(epoch(l_shipdate + to_days(CAST(l_linenumber - 4 AS INTEGER))) AS BIGINT) AS VARCHAR) END}"
          ", {'meta_key': '_delivered_' || n, 'meta_value': CASE WHEN n = '1' AND l_orderkey % 17 = 0 THEN "
          "CAST(CAST(epoch(l_shipdate + INTERVAL 1 DAY) AS BIGINT) AS VARCHAR) END}, "
          "{'meta_key': 'Xdelivered-9', 'meta_value': CASE WHEN n = '1' AND l_orderkey % 19 = 0 THEN "
          "CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) END}"
          "]) AS kv FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
          "ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS VARCHAR) AS n FROM lineitem)) "
          "WHERE kv.meta_value IS NOT NULL"),
    "x_cat_nodes": """
        SELECT *, 'product_cat' AS taxonomy, lower(name) AS slug FROM (
          SELECT CAST(1 + r_regionkey AS BIGINT) AS term_id, r_name AS name, CAST(0 AS BIGINT) AS parent FROM region
          UNION ALL SELECT 100 + n_nationkey, n_name || ' &amp; Friends', 1 + n_regionkey FROM nation
          UNION ALL SELECT 1000 + s_suppkey, s_name || ' &amp; Sons', 100 + s_nationkey FROM supplier
          UNION ALL SELECT 10000000 + s_suppkey, 'Sub ' || s_name, 1000 + s_suppkey FROM supplier WHERE s_suppkey % 2 = 0
          UNION ALL SELECT 40000000 + s_suppkey, 'Deep ' || s_name, 10000000 + s_suppkey FROM supplier WHERE s_suppkey % 4 = 0)""",
    "x_attr_rows": """
        SELECT DISTINCT k, a.taxonomy AS taxonomy, a.name AS name, lower(a.name) AS slug FROM (
          SELECT p_partkey // 4 AS k, UNNEST([
            {'taxonomy': 'pa_farbe', 'name': split_part(p_name, ' ', 1)},
            {'taxonomy': 'pa_marke', 'name': CASE WHEN (1000000 + p_partkey // 4) % 9 = 0 THEN NULL ELSE p_brand END},
            {'taxonomy': 'pa_order_saison', 'name': 'Season ' || (p_size % 3)},
            {'taxonomy': 'pa_jahreszeit', 'name': ['Fruehling', 'Sommer', 'Herbst', 'Winter'][p_size % 4 + 1]},
            {'taxonomy': 'pa_geschlecht', 'name': CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'Maedchen'
                                                       WHEN p_type IN ('STANDARD', 'MEDIUM') THEN 'Jungen'
                                                       ELSE 'Unisex' END}
          ]) AS a FROM part WHERE p_partkey // 4 % 12 <> 7)
        WHERE a.name IS NOT NULL""",
    "x_size_terms": """
        SELECT DISTINCT a.taxonomy AS taxonomy, a.name AS name, a.slug AS slug FROM (
          SELECT UNNEST([
            {'taxonomy': 'pa_groesse', 'name': 'Gr ' || p_size, 'slug': 'gr-' || p_size},
            {'taxonomy': 'pa_kgr', 'name': 'KGr ' || (p_size % 10), 'slug': 'kgr-' || (p_size % 10)},
            {'taxonomy': 'pa_kopfumfang', 'name': 'KU ' || (p_size % 6), 'slug': 'ku-' || (p_size % 6)}
          ]) AS a FROM part)""",
    "x_all_terms": f"""
        SELECT term_id, name, slug, taxonomy, parent FROM x_cat_nodes
        UNION ALL
        SELECT {_ATTR_ID} AS term_id, name, slug, taxonomy, CAST(0 AS BIGINT) AS parent FROM (
          SELECT taxonomy, name, slug FROM x_attr_rows UNION SELECT taxonomy, name, slug FROM x_size_terms)""",
    "terms": "SELECT term_id, name, slug FROM x_all_terms",
    "term_taxonomy": "SELECT term_id AS term_taxonomy_id, term_id, taxonomy, parent FROM x_all_terms",
    "term_relationships": f"""
        SELECT CAST(1000000 + k AS BIGINT) AS object_id, CAST(ttid AS BIGINT) AS term_taxonomy_id FROM (
          SELECT k, UNNEST([
            CASE WHEN k % 2 = 0 AND s_min % 2 = 0 THEN 10000000 + s_min ELSE 1000 + s_min END,
            CASE WHEN k % 3 = 0 AND s_max <> s_min THEN 1000 + s_max END,
            CASE WHEN k % 10 = 5 AND s_min % 4 = 0 THEN 40000000 + s_min END]) AS ttid
          FROM (SELECT l_partkey // 4 AS k, min(l_suppkey) AS s_min, max(l_suppkey) AS s_max
                FROM lineitem GROUP BY l_partkey // 4))
        WHERE ttid IS NOT NULL AND k % 12 <> 7
        UNION ALL
        SELECT 1000000 + k, {_ATTR_ID} FROM x_attr_rows""",
    "campaign_tracking": """
        SELECT event_id AS id, event_type AS utm_medium, CAST(user_id AS VARCHAR) AS utm_source,
               props AS utm_campaign, CAST(NULL AS VARCHAR) AS utm_term, CAST(NULL AS VARCHAR) AS utm_content
        FROM events""",
}


def with_raw(query: str, extra_ctes: dict[str, str] | None = None) -> str:
    ctes = dict(RAW_CTES)
    if extra_ctes:
        ctes.update(extra_ctes)
    body = ",\n".join(f"{n} AS ({sql})" for n, sql in ctes.items())
    return f"WITH RECURSIVE {body}\nSELECT * FROM ({query})"
