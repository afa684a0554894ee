"""Keyed tables in files by key bucket: a load rewrites only the buckets it changes.

    <root>/data/<commit>/_bucket=<n>/part-*.parquet
    <root>/_manifests/<number>.json

A row lies in the bucket that the hash of its key gives.  The manifest of a
version names, for each bucket, the folder that holds it, its number of files
and the schema version it was written under.  An upsert reads and rewrites
the buckets that hold keys of the source and carries all others over by name,
so a small load costs what it changes, not what the table holds.  Commits are
optimistic (``commits``): loads into different buckets both stand, a load
into a bucket that another has replaced meanwhile is done again.

A bucket is the unit of rewriting: choose so many that one holds some hundred
megabytes.  Manifests hold one entry a bucket, whatever the rows.

Files are read under the newest schema; a column that a bucket was written
without is NULL there until the bucket is rewritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.load import upsert
from .commits import Conflict, commit, hadoop, load, newest

BUCKET = "_bucket"
#: Times that an upsert starts again after a conflict.
ATTEMPTS = 5


def _no_key(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return missing


def bucket_of(keys: Sequence[str], buckets: int, columns: Sequence[str] | None = None) -> Column:
    """Bucket of a row: hash of its key's text.  Rows with a NULL key part never
    meet another row; they are spread by all their ``columns``."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("NULL"))

    missing = _no_key(keys)
    of_key = F.concat_ws(",", *[text(k) for k in keys])
    of_row = F.concat_ws(",", *[text(c) for c in columns or keys])
    digits = F.substring(F.md5(F.when(missing, of_row).otherwise(of_key)), 1, 8)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Version:
    """One version of a keyed table, as its manifest tells it."""

    root: str
    number: int
    content: dict

    @property
    def keys(self) -> list[str]:
        return self.content["keys"]

    @property
    def buckets(self) -> int:
        return self.content["buckets"]

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(self.content["schema"])

    @property
    def parts(self) -> dict[str, dict]:
        return self.content["parts"]

    def read(self, spark: SparkSession, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table, or the given buckets of it, under its schema."""
        wanted = self.parts if buckets is None else {str(b) for b in buckets} & set(self.parts)
        paths = sorted(f"{self.root}/{self.parts[b]['folder']}" for b in wanted)
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)


def _folder(root: str) -> str:
    return f"{root}/_manifests"


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The newest version (or that of ``number``); None before the first."""
    if number is None:
        number, content = newest(spark, _folder(root))
        return Version(root, number, content) if number else None
    return Version(root, number, load(spark, _folder(root), number))


def _written(rows: DataFrame, root: str, keys: Sequence[str], buckets: int, schema_version: int, among: Sequence[int] | None = None) -> dict[str, dict]:
    """Write rows by bucket under a name of their own; the manifest entries.

    ``among`` are the buckets that are rewritten: rows without a whole key,
    which no lookup needs to find, are dealt to those.
    """
    spark = rows.sparkSession
    name = f"data/{uuid.uuid4().hex}"
    bucket = bucket_of(keys, buckets, rows.columns)
    if among:
        bucket = F.when(_no_key(keys), F.get(F.lit(list(among)), F.pmod(bucket, F.lit(len(among))))).otherwise(bucket)
    dealt = rows.withColumn(BUCKET, bucket.cast("int"))
    # one task, and so one file, for each bucket
    dealt.repartition(BUCKET).sortWithinPartitions(BUCKET, *keys).write.partitionBy(BUCKET).parquet(f"{root}/{name}")
    fs, path, jvm = hadoop(spark, f"{root}/{name}")
    out = {}
    for st in fs.listStatus(path):
        found = st.getPath().getName()
        if found.startswith(f"{BUCKET}="):
            files = [f for f in fs.listStatus(st.getPath()) if f.getPath().getName().endswith(".parquet")]
            out[found[len(BUCKET) + 1:]] = {"folder": f"{name}/{found}", "files": len(files), "schema_version": schema_version}
    return out


def create(df: DataFrame, root: str, keys: Sequence[str], buckets: int, schema_version: int = 1) -> Version:
    """Write ``df`` as the first version of a keyed table (its keys are not checked)."""
    keys = list(keys)
    parts = _written(df, root, keys, buckets, schema_version)
    content = {"keys": keys, "buckets": buckets, "schema": df.schema.jsonValue(), "schema_version": schema_version, "parts": parts}
    number, content = commit(df.sparkSession, _folder(root), 0, {}, lambda _: content, lambda now: sorted(now))
    return Version(root, number, content)


def evolve_stored(spark: SparkSession, root: str, schema: StructType, schema_version: int) -> Version:
    """Read the table under a later schema (more columns) from now on; no file is touched."""
    base = version(spark, root)
    lost = [f.name for f in base.schema.fields if f.name not in schema.names or schema[f.name].dataType != f.dataType]
    if lost or schema_version < base.content["schema_version"]:
        raise ValueError(f"schema version {schema_version} cannot follow {base.content['schema_version']}: {lost}")
    number, content = commit(spark, _folder(root), base.number, base.content,
                             lambda now: {**now, "schema": schema.jsonValue(), "schema_version": schema_version},
                             lambda now: now["schema_version"])
    return Version(root, number, content)


def upsert_changed(source: DataFrame, root: str, columns: Sequence[str] | None = None, order_by: str | None = None) -> Version:
    """Upsert ``source`` into a keyed table (rules of ``operators.load.upsert``), rewriting
    only the buckets that hold keys of the source.

    The source is computed once.  A conflict with another load starts the
    rewriting again on the newest version.
    """
    spark = source.sparkSession
    base = version(spark, root)
    if base is None:
        raise ValueError(f"{root}: no keyed table")
    store = f"{root}/_work/{uuid.uuid4().hex}"
    source.withColumn(BUCKET, bucket_of(base.keys, base.buckets, source.columns)).write.parquet(store)
    source = spark.read.parquet(store)
    touched = sorted(r[0] for r in source.select(BUCKET).distinct().collect())  # at most one a bucket
    source = source.drop(BUCKET)
    for attempt in range(ATTEMPTS):
        made = upsert(base.read(spark, touched), source, base.keys, columns, order_by)
        parts = _written(made, root, base.keys, base.buckets, base.content["schema_version"], touched)

        def built_on(now: dict) -> tuple:
            return now["schema_version"], [now["parts"].get(str(b)) for b in touched]

        try:
            number, content = commit(spark, _folder(root), base.number, base.content,
                                     lambda now: {**now, "parts": {**now["parts"], **parts}}, built_on)
            return Version(root, number, content)
        except Conflict:
            if attempt == ATTEMPTS - 1:
                raise
            base = version(spark, root)


def rewritten(before: Version, after: Version) -> tuple[list[int], list[int]]:
    """Buckets that ``after`` carries over from ``before``, and those it holds anew."""
    same = [int(b) for b, p in after.parts.items() if before.parts.get(b) == p]
    return sorted(same), sorted(int(b) for b in after.parts if int(b) not in set(same))
