"""Entity / attribute / value operators.

``eav_pivot`` turns any number of attributes of an entity into columns with
one filtered scan, one aggregate and (for the caller) one join -- instead of a
correlated scalar subquery per attribute, which Spark plans as one
nested-loop or sort-merge join per attribute.

Scale notes: the key filter is an ``IN`` list pushed to the parquet scan; the
aggregate is hash-partitioned by entity with a map-side partial aggregate, so
an entity holding many rows is combined before the shuffle.  Attribute rows
per entity are bounded by the key list, so no single group can grow with the
data except through duplicate keys, which strict mode reports.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys_map(keys: Mapping[str, str] | Iterable[str]) -> dict[str, str]:
    if isinstance(keys, Mapping):
        return dict(keys)
    return {k: k for k in keys}


def eav_pivot(meta: DataFrame, entity: str, keys: Mapping[str, str] | Iterable[str], *,
              key_col: str = "meta_key", value_col: str = "meta_value",
              on_duplicate: str = "error", entity_alias: str | None = None) -> DataFrame:
    """One row per entity that has any of ``keys``; one column per key.

    ``keys`` maps attribute key -> output column name.  A key absent for an
    entity gives NULL.  ``on_duplicate='error'`` fails the job when an entity
    holds a key twice (a scalar subquery returning two rows); ``'max'`` keeps
    the largest value.

    Plan: the key list is pushed to the scan, each row's key is turned into a
    small integer once (a literal map lookup), and one aggregate by entity
    keeps ``max(value)`` per key index.  The aggregation buffer is one slot
    per key, so memory per entity is bounded whatever the number of rows.
    Strict mode adds two fixed-width aggregates: the row count and a bitmask
    of the keys seen (``bit_or(1 << index)``); an entity has a duplicate
    exactly when it has more rows than bits.  Each output column carries the
    check, and since it does not reference the other columns, Catalyst still
    prunes the aggregates of attributes a query does not use.
    """
    if on_duplicate not in ("error", "max"):
        raise ValueError("on_duplicate must be 'error' or 'max'")
    km = _keys_map(keys)
    names = list(km.values())
    index = F.create_map(*[x for i, key in enumerate(km) for x in (F.lit(key), F.lit(i))])
    rows = (meta.where(F.col(key_col).isin(list(km)))
                .select(F.col(entity), F.element_at(index, F.col(key_col)).alias("_ki"),
                        F.col(value_col).alias("_v")))
    aggs: list[Column] = [F.max(F.when(F.col("_ki") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)]
    n_masks = (len(names) + 62) // 63
    if on_duplicate == "error":
        aggs.append(F.count(F.lit(1)).alias("_nrows"))
        for m in range(n_masks):
            bit = F.when(F.floor(F.col("_ki") / 63) == m, F.expr("shiftleft(1L, CAST(_ki % 63 AS INT))"))
            aggs.append(F.bit_or(bit).alias(f"_mask{m}"))
    out = rows.groupBy(entity).agg(*aggs)
    if on_duplicate == "error":
        distinct_keys = sum((F.coalesce(F.bit_count(F.col(f"_mask{m}")), F.lit(0)).cast("bigint")
                             for m in range(n_masks)), F.lit(0).cast("bigint"))
        dup = F.col("_nrows") > distinct_keys
        vtype = value_col_type(meta, value_col)
        msg = F.concat(F.lit(f"an attribute occurs more than once for {entity} "), F.col(entity).cast("string"))
        out = out.select(F.col(entity), *[
            F.when(dup, F.raise_error(msg).cast(vtype)).otherwise(F.col(n)).alias(n) for n in names])
    if entity_alias:
        out = out.withColumnRenamed(entity, entity_alias)
    return out


def value_col_type(meta: DataFrame, value_col: str) -> str:
    return meta.schema[value_col].dataType.simpleString()


def eav_lookup(entities: DataFrame, entity_key: str, meta: DataFrame, meta_entity: str,
               keys: Mapping[str, str] | Iterable[str], *, on_duplicate: str = "error",
               key_col: str = "meta_key", value_col: str = "meta_value") -> DataFrame:
    """``entities`` with the attributes of ``keys`` added as columns (NULL if absent).

    The left join keeps every entity; the pivot side is at most one row per
    entity, so the join never multiplies rows.
    """
    pv = eav_pivot(meta, meta_entity, keys, key_col=key_col, value_col=value_col,
                   on_duplicate=on_duplicate)
    if meta_entity == entity_key:
        return entities.join(pv, entity_key, "left")
    return entities.join(pv, F.col(entity_key) == pv[meta_entity], "left").drop(pv[meta_entity])


def eav_numbered(meta: DataFrame, entity: str, first_prefix: str, second_prefix: str, *,
                 number_col: str = "n", first_name: str = "first", second_name: str = "second",
                 key_col: str = "meta_key", value_col: str = "meta_value",
                 like_pattern: str | None = None, on_duplicate: str = "error") -> DataFrame:
    """Numbered attribute pairs ``<first_prefix><n>`` / ``<second_prefix><n>``.

    One row per first attribute row.  The number is the key text with
    ``first_prefix`` removed (every occurrence, as a text replace does) and the
    second attribute must be ``second_prefix + number`` exactly.
    ``like_pattern`` selects the first keys with SQL ``LIKE`` rules (``_``
    matches any one character); default ``<first_prefix>%`` literal.

    One scan and one shuffle: the number is derived on both kinds of rows, and
    a window by (entity, number) hands the second attribute to the first ones.
    A number held twice there fails the job (``on_duplicate='error'``, a
    scalar subquery with two rows) or keeps the largest value (``'max'``).  A
    repeated first attribute stays as many rows.
    """
    if on_duplicate not in ("error", "max"):
        raise ValueError("on_duplicate must be 'error' or 'max'")
    k, v = F.col(key_col), F.col(value_col)
    is_first = k.like(like_pattern) if like_pattern else k.startswith(first_prefix)
    is_second = k.startswith(second_prefix)
    # a key can be a first and a second one at once only with odd prefixes: one row per role
    roles = meta.where(is_first | is_second).select(F.col(entity), v.alias("_v"), F.inline(F.array(
        F.struct(F.when(is_first, F.replace(k, F.lit(first_prefix), F.lit(""))).alias(number_col), F.lit(True).alias("_first")),
        F.struct(F.when(is_second, F.substring(k, len(second_prefix) + 1, 1 << 30)).alias(number_col), F.lit(False).alias("_first")),
    ))).where(F.col(number_col).isNotNull())
    pair = Window.partitionBy(entity, number_col)
    second = F.max(F.when(~F.col("_first"), F.col("_v"))).over(pair)
    if on_duplicate == "error":
        msg = F.concat(F.lit(f"a numbered attribute occurs more than once for {entity} "),
                       F.col(entity).cast("string"), F.lit(" number "), F.col(number_col))
        twice = F.count(F.when(~F.col("_first"), 1)).over(pair) > 1
        second = F.when(twice, F.raise_error(msg).cast(value_col_type(meta, value_col))).otherwise(second)
    out = roles.withColumn("_second", second).where("_first")
    return out.select(entity, number_col, F.col("_v").alias(first_name), F.col("_second").alias(second_name))


def eav_keys_like(meta: DataFrame, pattern: str, key_col: str = "meta_key") -> DataFrame:
    """Attribute rows whose key matches a SQL ``LIKE`` pattern."""
    return meta.where(F.col(key_col).like(pattern))


def select_keys(meta: DataFrame, keys: Sequence[str], key_col: str = "meta_key",
                exclude: bool = False) -> DataFrame:
    """Rows whose key is (not) in a literal list (pushed to the scan)."""
    cond = F.col(key_col).isin(list(keys))
    return meta.where(~cond if exclude else cond)
