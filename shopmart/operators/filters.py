"""Order filters.  The shop queries use four slightly different order tests
(kept apart on purpose, they give different rows on the cutoff instant)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER_TYPE = "shop_order"
COMPLETED = "wc-completed"
DEFAULT_CUTOFF = "2014-09-01"


def order_filter(cutoff: str | None = DEFAULT_CUTOFF, *, require_type: bool = True,
                 strict_after: bool = False, status: str = COMPLETED) -> Column:
    """Predicate on ``posts``: status, optional type test, date ``>=`` (or ``>``) cutoff."""
    cond = F.col("post_status") == F.lit(status)
    if require_type:
        cond = cond & (F.col("post_type") == F.lit(ORDER_TYPE))
    if cutoff is not None:
        ts = F.lit(cutoff).cast("timestamp_ntz")
        d = F.col("post_date")
        cond = cond & ((d > ts) if strict_after else (d >= ts))
    return cond


def completed_orders(posts: DataFrame, cutoff: str | None = DEFAULT_CUTOFF, *,
                     require_type: bool = True, strict_after: bool = False) -> DataFrame:
    """Completed orders since ``cutoff`` (``ID``, ``post_date``)."""
    return (posts.where(order_filter(cutoff, require_type=require_type, strict_after=strict_after))
                 .select("ID", "post_date"))
