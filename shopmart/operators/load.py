"""Loading data sets into reporting tables: keyed upsert, key checks,
alignment to a target schema, schema versions.

Parquet has no MERGE, so an upsert is a full outer join of the target with
the de-duplicated source on the key, producing the next version of the
table; the caller writes it as a new version (``sources.tables``) and never
overwrites what it reads.  Source and target are each scanned once and
shuffled once on the key: the source's de-duplication and the join share one
partitioning, and rows with a NULL key part -- which never match -- carry a
number of their own in the join key, so they neither meet nor pile up in the
partition of the NULL key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import empty_to_null


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _null_key(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def _spread_null_keys(df: DataFrame, keys: Sequence[str], sign: int) -> DataFrame:
    """``_nk``: 0 for rows with a whole key, else a number of the row's own."""
    if not any(df.schema[k].nullable for k in keys):
        return df.withColumn("_nk", F.lit(0).cast("bigint"))
    own = (F.monotonically_increasing_id() + 1) * sign
    return df.withColumn("_nk", F.when(_null_key(keys), own).otherwise(F.lit(0).cast("bigint")))


def _last_rows(source: DataFrame, keys: Sequence[str], order_by: str | None) -> DataFrame:
    """One row per key and ``_nk`` (one aggregate over one scan)."""
    others = [c for c in source.columns if c not in keys and c != "_nk"]
    if not others:
        return source.distinct()
    row = F.struct(*[F.col(c) for c in others])
    picked = F.max(row) if order_by is None else F.max_by(row, F.struct(F.col(order_by), row))
    agg = source.groupBy(*keys, "_nk").agg(picked.alias("_row"))
    return agg.select(*keys, "_nk", *[F.col("_row")[c].alias(c) for c in others])


def dedupe_last(source: DataFrame, keys: str | Sequence[str], order_by: str | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (ties and
    ``order_by=None``: the greatest row by value, so the result is
    deterministic).  Rows with a NULL key part are kept as they are -- a NULL
    key never conflicts (as with a database unique constraint).

    One aggregate by key with ``max_by`` over a struct of the row: partial
    aggregation before the shuffle, bounded state per key, one scan.
    """
    ks = _as_list(keys)
    return _last_rows(_spread_null_keys(source, ks, 1), ks, order_by).select(*source.columns)


def upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
           columns: Sequence[str] | None = None, order_by: str | None = None,
           nullify_empty: bool = True) -> DataFrame:
    """Next version of ``target`` after inserting / updating ``source`` rows.

    * new keys are inserted (columns not in ``columns`` are NULL);
    * existing keys get every listed column from the source, unlisted
      columns keep the target's value;
    * within the source the last row per key wins (``order_by``, see
      ``dedupe_last``); ``''`` in source text becomes NULL first;
    * with ``order_by`` a column of the target too, an existing row changes
      only if the source row is not older (a NULL in the target is oldest, a
      NULL in the source older than any value).
    """
    ks = _as_list(keys)
    cols = list(columns) if columns is not None else list(source.columns)
    for k in ks:
        if k not in cols:
            raise ValueError(f"key column {k!r} must be among the upserted columns")
    missing = [c for c in cols if c not in target.columns]
    if missing:
        raise ValueError(f"columns not in target: {missing}")
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"columns not in source: {missing}")
    ordered = order_by is not None and order_by in target.columns
    extra = [order_by] if order_by is not None and order_by not in cols else []
    taken = cols + (extra if ordered else [])
    src = source.select(*cols, *extra)
    if nullify_empty:
        src = empty_to_null(src, [c for c, t in src.dtypes if t == "string" and c in cols])
    src = _last_rows(_spread_null_keys(src, ks, 1), ks, order_by)
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in taken], F.col("_nk").alias("_s_nk"), F.lit(True).alias("_s_present"))
    tgt = _spread_null_keys(target, ks, -1)
    t = tgt.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.col("_nk").alias("_t_nk"), F.lit(True).alias("_t_present"))
    cond = F.col("_t_nk") == F.col("_s_nk")
    for k in ks:
        cond = cond & (F.col(f"_t_{k}") == F.col(f"_s_{k}"))
    j = t.join(s, cond, "full")
    take = F.col("_s_present").isNotNull()
    if ordered:
        newer = F.coalesce(F.col(f"_s_{order_by}") >= F.col(f"_t_{order_by}"), F.col(f"_t_{order_by}").isNull())
        take = take & (F.col("_t_present").isNull() | newer)
    return j.select(*[
        (F.when(take, F.col(f"_s_{c}").cast(target.schema[c].dataType)).otherwise(F.col(f"_t_{c}"))
         if c in taken else F.col(f"_t_{c}")).alias(c)
        for c in target.columns])


@dataclass
class TableSpec:
    """A reporting table: schema, primary key, unique keys, foreign keys."""

    name: str
    schema: StructType
    key: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    foreign_keys: list[tuple[list[str], str, list[str]]] = field(default_factory=list)
    renames: dict[str, str] = field(default_factory=dict)   # data set column -> target column

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def key_columns(self) -> set[str]:
        """Columns of the primary, unique and foreign keys."""
        return {c for ks in [self.key, *self.unique, *(fk for fk, _, _ in self.foreign_keys)] for c in ks}


def _sources(df: DataFrame, spec: TableSpec) -> dict[str, str]:
    return {spec.renames.get(c, c): c for c in df.columns}


def _overflows(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    """Per target column: does a value not fit its type?"""
    src = _sources(df, spec)
    return {f.name: F.col(src[f.name]).isNotNull() & F.col(src[f.name]).try_cast(f.dataType).isNull()
            for f in spec.schema.fields if f.name in src}


def align(df: DataFrame, spec: TableSpec, strict: bool = True, on_overflow: str = "error") -> DataFrame:
    """Columns of ``df`` mapped to ``spec`` by name (after ``spec.renames``),
    cast to the target types, in target order.

    A target column missing from ``df`` raises when ``strict`` (else NULL).  A
    value that does not fit its type (an id above 2^31, money above
    numeric(8,2)) fails the job, as the database does; ``on_overflow='null'``
    makes it NULL, ``'null_values'`` too except in a column of a primary,
    unique or foreign key, where it fails the job (a key made NULL would
    escape the key checks), and ``split_overflow`` sets such rows apart.
    """
    if on_overflow not in ("error", "null", "null_values"):
        raise ValueError("on_overflow must be 'error', 'null' or 'null_values'")
    src = _sources(df, spec)
    missing = [c for c in spec.columns if c not in src]
    if missing and strict:
        raise ValueError(f"{spec.name}: data set lacks target columns {missing}")
    bad = _overflows(df, spec)
    fails = {"error": set(spec.columns), "null": set(), "null_values": spec.key_columns}[on_overflow]
    out = []
    for f in spec.schema.fields:
        if f.name not in src:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(src[f.name]).try_cast(f.dataType)
        if f.name in fails and df.schema[src[f.name]].dataType != f.dataType:
            msg = F.concat(F.lit(f"{spec.name}.{f.name}: out of range for {f.dataType.simpleString()}: "), F.col(src[f.name]).cast("string"))
            c = F.when(bad[f.name], F.raise_error(msg).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def split_overflow(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """``(fits, rejects)``: rows that ``align`` can store, and the others with
    ``_overflow``, the target columns whose value does not fit."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in _overflows(df, spec).items()]))
    marked = df.withColumn("_overflow", names)
    return marked.where(F.size("_overflow") == 0).drop("_overflow"), marked.where(F.size("_overflow") > 0)


def align_overflow(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``column, n``: how many values of each target column do not fit its type (0 included)."""
    bad = _overflows(df, spec)
    counts = df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in bad.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("n")) for n in bad])
    return counts.select(F.inline(pairs))


def unique_violations(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """``table, rule, key_text, n``: key values held by more than one row,
    and rows whose key has a NULL part (they never conflict, so they slip
    through a unique rule)."""
    ks = list(keys)
    rule = "unique(" + ",".join(ks) + ")"
    key_text = F.to_json(F.struct(*[F.col(k) for k in ks]))
    dup = (df.where(~_null_key(ks)).groupBy(*ks).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1)
             .select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), key_text.alias("key_text"), "n"))
    nul = (df.where(_null_key(ks)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
             .select(F.lit(table).alias("table"), F.lit(rule + " null key").alias("rule"),
                     F.lit(None).cast("string").alias("key_text"), "n"))
    return dup.unionByName(nul)


def fk_violations(child: DataFrame, child_name: str, fk: Sequence[str], parent: DataFrame,
                  parent_name: str, pk: Sequence[str], child_key: Sequence[str] | None = None) -> DataFrame:
    """``table, rule, key_text, fk_text``: child rows whose non-NULL foreign
    key has no parent (a left anti join; the parent side is only its keys)."""
    fk, pk = list(fk), list(pk)
    ck = list(child_key) if child_key else fk
    rule = f"{child_name}({','.join(fk)}) -> {parent_name}({','.join(pk)})"
    p = parent.select(*[F.col(a).alias(f"_p_{i}") for i, a in enumerate(pk)]).distinct()
    c = child.where(~_null_key(fk))
    cond = None
    for i, a in enumerate(fk):
        e = F.col(a) == F.col(f"_p_{i}")
        cond = e if cond is None else cond & e
    miss = c.join(p, cond, "left_anti")
    return miss.select(F.lit(child_name).alias("table"), F.lit(rule).alias("rule"),
                       F.to_json(F.struct(*[F.col(k) for k in ck])).alias("key_text"),
                       F.to_json(F.struct(*[F.col(k) for k in fk])).alias("fk_text"))


def check_keys(tables: Mapping[str, DataFrame], specs: Iterable[TableSpec]) -> DataFrame:
    """All key rule violations of ``tables`` (by name) under ``specs``:
    primary/unique duplicates and dangling foreign keys, one DataFrame.

    A foreign key of a given table whose parent table is not given cannot be
    checked and raises.
    """
    parts: list[DataFrame] = []
    for spec in specs:
        df = tables.get(spec.name)
        if df is None:
            continue
        for ks in ([spec.key] if spec.key else []) + spec.unique:
            u = unique_violations(df, spec.name, ks)
            parts.append(u.select("table", "rule", "key_text", F.col("n").cast("string").alias("detail")))
        for fk, parent, pk in spec.foreign_keys:
            if parent not in tables:
                raise ValueError(f"{spec.name}({','.join(fk)}): parent table {parent} not given")
            v = fk_violations(df, spec.name, fk, tables[parent], parent, pk, spec.key or None)
            parts.append(v.select("table", "rule", "key_text", F.col("fk_text").alias("detail")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Bits of the filter of changed foreign keys: at most 2**15 * FILTER_BLOCKS (16 MB).
FILTER_BLOCKS = 1 << 12


def _bit(columns: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(FILTER_BLOCKS << 15))


def _maybe_among(df: DataFrame, columns: Sequence[str], values: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``columns`` may be among ``values`` (same column types, no NULL): a Bloom filter
    with one hash, built by a bitmap aggregate of at most ``FILTER_BLOCKS`` blocks and broadcast.  It
    lets none of the values fall; the rows of ``df`` that it spares are never shuffled."""
    bit = _bit([F.col(c) for c in values.columns])
    blocks = values.select(F.shiftright(bit, 15).alias("_block"), F.pmod(bit, F.lit(1 << 15)).alias("_bit"))
    blocks = blocks.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    mine = _bit([F.col(c) for c in columns])
    place = F.pmod(mine, F.lit(1 << 15))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.get(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.getbit(byte, i)), F.pmod(place, F.lit(8)).cast("int")) == 1
    return df.join(F.broadcast(blocks), F.shiftright(mine, 15) == F.col("_block")).where(hit).drop("_block", "_bits")


def check_changes(tables: Mapping[str, DataFrame], specs: Iterable[TableSpec], changed: Mapping[str, DataFrame],
                  removed: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The violations of ``check_keys`` that a load can have made.

    ``tables`` are the tables after the load, ``changed`` the rows it inserted
    or updated (by table), ``removed`` the rows whose keys are gone.  Checked
    are the keys of changed rows (against the whole table), the foreign keys
    of changed rows, and the foreign keys of all rows that point at a removed
    key.  If the state before the load was clean, the report is that of the
    full check.  Tables are scanned, but only rows that may meet a changed
    key pass a Bloom filter and are shuffled.
    """
    removed = removed or {}
    parts: list[DataFrame] = []
    for spec in specs:
        if spec.name not in tables:
            continue
        df, new = tables[spec.name], changed.get(spec.name)
        for ks in ([spec.key] if spec.key else []) + spec.unique:
            if new is None:
                continue
            touched = new.select(*ks).where(~_null_key(ks)).distinct()
            near = _maybe_among(df.select(*ks).where(~_null_key(ks)), ks, touched).join(touched, ks, "left_semi")
            nulls = new.select(*ks).where(_null_key(ks))
            u = unique_violations(near.unionByName(nulls), spec.name, ks)
            parts.append(u.select("table", "rule", "key_text", F.col("n").cast("string").alias("detail")))
        for fk, parent, pk in spec.foreign_keys:
            if parent not in tables:
                raise ValueError(f"{spec.name}({','.join(fk)}): parent table {parent} not given")
            ck = spec.key or fk
            cols = list(dict.fromkeys([*fk, *ck]))
            child = new.select(*cols) if new is not None else df.select(*cols).limit(0)
            if parent in removed:
                gone = removed[parent].select(*[F.col(p).cast(df.schema[f].dataType).alias(f) for p, f in zip(pk, fk)]).where(~_null_key(fk)).distinct()
                # all rows that point at a removed key, changed or not, and the changed rows that do not
                orphans = _maybe_among(df.select(*cols).where(~_null_key(fk)), fk, gone).join(gone, fk, "left_semi")
                child = child.join(gone, fk, "left_anti").unionByName(orphans)
            # of the parents only those that a child may name
            wanted = child.select(*[F.col(f).cast(tables[parent].schema[p].dataType).alias(p) for f, p in zip(fk, pk)]).where(~_null_key(pk)).distinct()
            v = fk_violations(child, spec.name, fk, _maybe_among(tables[parent].select(*pk).where(~_null_key(pk)), pk, wanted), parent, pk, spec.key or None)
            parts.append(v.select("table", "rule", "key_text", F.col("fk_text").alias("detail")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def upsert_many(plan: Mapping[str, tuple[DataFrame, DataFrame, str | Sequence[str], Sequence[str] | None]],
                post=None, specs: Iterable[TableSpec] | None = None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Several upserts as one unit: returns the next version of every table
    (lazily), after ``post(tables) -> tables`` (run once, at the end), and the
    key violations across all of them (foreign keys checked only at the end,
    like deferred constraints).  Publish only when the violations are empty.
    """
    out = {}
    for name, (target, source, keys, columns) in plan.items():
        if not keys:
            raise ValueError(f"{name}: keys must be given")
        out[name] = upsert(target, source, keys, columns)
    if post is not None:
        out = post(out)
    report = check_keys(out, specs) if specs is not None else None
    return out, report


def upsert_one(target: DataFrame, source: DataFrame, keys: str | Sequence[str],
               columns: Sequence[str] | None) -> DataFrame:
    """One-table upsert with argument checks (table, columns and keys required)."""
    if target is None or source is None or not keys or not columns:
        raise ValueError("target, source, columns and keys must be given")
    return upsert(target, source, keys, columns)


def evolve(df: DataFrame, versions: Sequence[StructType], from_version: int, to_version: int) -> DataFrame:
    """Bring a table written under schema ``from_version`` to ``to_version``:
    columns added by later versions appear as NULL of their type; existing
    columns are kept (versions only add columns)."""
    if not 1 <= from_version <= to_version <= len(versions):
        raise ValueError("bad version range")
    for v in (from_version, to_version):
        if versions[v - 1] is None:
            raise ValueError(f"the table does not exist at schema version {v}")
    target = versions[to_version - 1]
    have = set(df.columns)
    return df.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in target.fields])
