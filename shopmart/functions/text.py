"""Small text rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ._col import as_col


def null_if_empty(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def collated(c: Column | str, collation: str | None = None) -> Column:
    """The text under a collation (``utf8_lcase``, ``UNICODE_CI_AI``, ...): joins, groups and
    comparisons then follow it.  Without one texts compare byte by byte."""
    return as_col(c) if collation is None else F.collate(as_col(c), collation)


def value_or_default(c: Column | str, default: str) -> Column:
    """Missing, NULL or empty text -> ``default``."""
    return F.coalesce(null_if_empty(c), F.lit(default))


def empty_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Turn ``''`` into NULL in the given (default: all string) columns; ``'0'`` stays."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    cols = set(columns)
    return df.select(*[null_if_empty(c).alias(c) if c in cols else F.col(c) for c in df.columns])
