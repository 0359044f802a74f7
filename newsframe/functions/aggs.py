"""Arg-min / arg-max aggregates that keep aggregation hash-based.

``min_by``/``max_by`` with a string or struct value need a variable-length
aggregation buffer, which makes Spark plan a sort-based aggregate over all
input rows. Collecting the candidates' ``(order, value)`` structs and taking
the array minimum / maximum keeps the plan an ``ObjectHashAggregate``; the
groups these are used on (one page, one section key) hold few candidates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def first_by(value, order, cond: Column | None = None) -> Column:
    """The ``value`` with the smallest ``order`` (among rows meeting ``cond``)."""
    item = F.struct(_c(order).alias("k"), _c(value).alias("v"))
    if cond is not None:
        item = F.when(cond, item)
    return F.array_min(F.collect_list(item))["v"]


def last_by(value, order, cond: Column | None = None) -> Column:
    """The ``value`` with the largest ``order`` (among rows meeting ``cond``)."""
    item = F.struct(_c(order).alias("k"), _c(value).alias("v"))
    if cond is not None:
        item = F.when(cond, item)
    return F.array_max(F.collect_list(item))["v"]
