"""Distinct resources that roll up over any months.

A count of distinct resources cannot be added over months: a resource used in
three of them counts once. Stored by month and service are therefore sketches
(HyperLogLog, ``2 ** lg_k`` registers, a few KB each whatever the number of
resources), which merge: the estimate over any set of months and services is
that of one sketch over all their line items. Its standard error is
``1.04 / sqrt(2 ** lg_k)``; ``bound`` states three of them.

Built with partial and final aggregation: a service that has a third of the
line items reaches the shuffle as one sketch a task.
"""

from __future__ import annotations

import datetime as _dt
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import dates
from . import summary as S

LG_K = 12
SKETCH = "resource_sketch"


def bound(lg_k: int = LG_K) -> float:
    """Relative error that an estimate stays within (three standard errors)."""
    return 3 * 1.04 / sqrt(1 << lg_k)


def resource_sketches(
    cur: DataFrame,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    rules: DataFrame | None = None,
    lg_k: int = LG_K,
) -> DataFrame:
    """(year, month, product_servicename, line_items, resource_sketch): one sketch of
    the resource ids of each month and service. Line items without a resource
    id count as line items only. Write it with ``writers.replace_months``."""
    rows = S.line_items(cur, as_of, months_back, rules)
    return rows.groupBy(C.SERVICE_NAME, C.YEAR, C.MONTH).agg(
        F.count(F.lit(1)).alias("line_items"),
        F.hll_sketch_agg(F.col(C.RESOURCE_ID), F.lit(lg_k)).alias(SKETCH),
    )


def distinct_resources(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """Line items and estimated distinct resources of stored sketches, merged by ``by``
    (nothing: over all of them)."""
    return sketches.groupBy(*by).agg(
        F.sum("line_items").alias("line_items"),
        F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("resources"),
    )
