"""Text-to-number rules of the shop database, under ANSI Spark.

The shop keeps every attribute as text and converts it the lenient way:
leading blanks are skipped, the longest numeric prefix is used, text with no
numeric prefix (``''``, ``'abc'``) becomes 0, NULL stays NULL.  Spark's ANSI
cast raises on such text, so each rule is written as ``regexp_extract`` of the
prefix plus ``try_cast``; a value that does not fit the target type becomes
NULL (the shop database would clamp it).  All of it stays inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

# Fixed patterns: the numeric prefix of a text (sign, digits, optional
# fraction, optional exponent) and the integer prefix (sign, digits).
NUMERIC_PREFIX = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)"
INTEGER_PREFIX = r"^\s*([+-]?\d+)"
# Fixed pattern: what Python's float() reads (one '_' may stand between digits).
WHOLE_NUMBER = (r"^\s*[+-]?(?:(?:\d+(?:_\d+)*(?:\.(?:\d+(?:_\d+)*)?)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?"
                r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$")


def _prefix(c: Column, pattern: str) -> Column:
    return F.regexp_extract(c, pattern, 1)


def _number(prefix: Column, t: str) -> Column:
    """The prefix as a number, 0 if it is empty; the pattern is tried again only where the cast gives NULL."""
    return F.coalesce(prefix.try_cast(t), F.when(prefix == "", F.lit(0).cast(t)))


def lenient_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """``CAST(text AS DECIMAL(p,s))`` of the shop database (rounds half up)."""
    c = as_col(c)
    return _number(_prefix(c, NUMERIC_PREFIX), f"decimal({precision},{scale})")


def lenient_long(c: Column | str) -> Column:
    """``CAST(text AS SIGNED)``: integer prefix, 0 when there is none."""
    c = as_col(c)
    return _number(_prefix(c, INTEGER_PREFIX), "bigint")


def lenient_round(c: Column | str, digits: int = 2, precision: int = 10) -> Column:
    """``CAST(ROUND(text, d) AS DECIMAL(p,d))``.

    The number is read exactly as a wide decimal and rounded half up, so the
    result does not depend on binary floating point ties.
    """
    wide = lenient_decimal(c, 38, 10)
    return F.round(wide, digits).try_cast(f"decimal({precision},{digits})")


def lenient_timestamp(c: Column | str) -> Column:
    """Text date/time (``yyyy-MM-dd[ HH:mm:ss]``) to a zone-free timestamp; bad text -> NULL."""
    return as_col(c).try_cast("timestamp_ntz")


def is_number(c: Column | str) -> Column:
    """True when the whole text reads as a number (Python ``float(s)`` test)."""
    return F.coalesce(as_col(c).rlike(WHOLE_NUMBER), F.lit(False))
