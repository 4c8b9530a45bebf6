"""Date helpers: rolling window bounds, date keys and calendar attributes."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import columns as C
from .cache import per_session

DEFAULT_MONTHS_BACK = 7


def window_start(as_of: _dt.date, months_back: int = DEFAULT_MONTHS_BACK) -> _dt.date:
    """First day of the month ``months_back`` months before ``as_of``'s month."""
    index = as_of.year * 12 + (as_of.month - 1) - months_back
    return _dt.date(index // 12, index % 12 + 1, 1)


def as_date(value: _dt.date | str | None) -> _dt.date:
    """``value`` as a date; None means today in UTC (the billing clock), not
    the driver machine's local date."""
    if value is None:
        return _dt.datetime.now(_dt.timezone.utc).date()
    if isinstance(value, str):
        return _dt.date.fromisoformat(value)
    if isinstance(value, _dt.datetime):
        return value.date()
    return value


def period_date(year: Column | None = None, month: Column | None = None) -> Column:
    """Date of the first day of the ``year``/``month`` partition (strings,
    month possibly unpadded)."""
    y = year if year is not None else F.col(C.YEAR)
    m = month if month is not None else F.col(C.MONTH)
    return F.make_date(y.cast("int"), m.cast("int"), F.lit(1))


@per_session
def rolling_window(as_of: _dt.date, months_back: int = DEFAULT_MONTHS_BACK) -> Column:
    """Billing periods from the first of the month ``months_back`` months ago.

    Two conjuncts: one on the billing-period timestamp (parquet pushdown) and
    one on the ``year``/``month`` partition columns (partition pruning).
    """
    start = F.lit(window_start(as_of, months_back))
    # date -> timestamp is midnight in the session time zone (UTC for CUR data)
    return (F.col(C.BILLING_PERIOD_START) >= start.cast("timestamp")) & (period_date() >= start)


def date_key(d: Column) -> Column:
    """``yyyyMMdd`` text of a date or timestamp."""
    return F.date_format(F.to_date(d), "yyyyMMdd")
