"""Stable address keys.

The key of an address is the first 16 hex digits of the SHA-1 of its parts
joined by ``','`` (NULL parts skipped, empty parts kept), read as an unsigned
64-bit number.  It is exact in ``decimal(20,0)``; a ``bigint`` would overflow
for keys at or above 2^63.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

KEY_TYPE = "decimal(20,0)"


def hex_prefix_to_unsigned(hex_text: Column, digits: int = 16) -> Column:
    """First ``digits`` hex digits as an unsigned integer in decimal(20,0)."""
    return F.conv(F.substring(hex_text, 1, digits), 16, 10).cast(KEY_TYPE)


def address_key(parts: Sequence[Column | str], address_type: Column | str) -> Column:
    """Key over ``parts`` followed by the address type (a text literal or a Column).

    NULL when every part is NULL (an order without any address attribute has
    no address), so the same key results whether the parts come from columns
    or from attribute rows.
    """
    cols = [as_col(p) for p in parts]
    t = F.lit(address_type) if isinstance(address_type, str) else address_type
    text = F.concat_ws(",", *cols, t)
    any_part = F.coalesce(*cols).isNotNull() if len(cols) > 1 else cols[0].isNotNull()
    return F.when(any_part, hex_prefix_to_unsigned(F.sha1(text))).otherwise(F.lit(None).cast(KEY_TYPE))
