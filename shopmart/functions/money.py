"""Money arithmetic in decimals: ``try_divide`` for x/0 (NULL like the shop
database), results cast to the stated precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import as_col

MONEY = "decimal(10,2)"


def money(c: Column | str, t: str = MONEY) -> Column:
    """Cast to the money type; a value that does not fit becomes NULL."""
    return as_col(c).try_cast(t)


def per_unit(amount: Column | str, qty: Column | str, t: str = MONEY) -> Column:
    """``CAST(amount / qty AS t)``, rounded half up, NULL when qty is 0 or NULL."""
    return money(F.try_divide(as_col(amount), as_col(qty)), t)
