"""Job entry points: the parameters a scheduled run takes.

* ``as_of`` defaults to today's date in a named time zone (the billing
  team's zone decides which month is "current").
* ``year``/``month`` select one billing month: the CUR scan is pruned to
  that partition, the fact for that month is recomputed whole and, written
  with dynamic partition overwrite, replaces only that month.
"""

from __future__ import annotations

import datetime as _dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import columns as C
from ..functions import dates
from ..operators import fact, summary, summary_sql
from ..sinks import writers
from ..sources import readers
from . import mart


def today_in(zone: str = "UTC") -> _dt.date:
    return _dt.datetime.now(ZoneInfo(zone)).date()


def current_period(zone: str = "UTC") -> tuple[str, str]:
    """(year, month) of today in ``zone``; month unpadded like the CUR's."""
    d = today_in(zone)
    return str(d.year), str(d.month)


def read_cur_window(
    spark: SparkSession,
    root: str,
    as_of: _dt.date | str | None = None,
    months_back: int = dates.DEFAULT_MONTHS_BACK,
    schema: StructType | None = None,
) -> DataFrame:
    """The CUR dataset at ``root`` restricted, at listing time, to the month
    directories of the rolling window (the window filter still applies).
    Columns are the union over all files of the dataset, so a tag that only
    some months carry is a column here (and part of every tag key): give their
    ``schema`` if it is known, else the footers of all files are read."""
    start = dates.window_start(dates.as_date(as_of), months_back)
    return readers.read_months(spark, root, since=start, schema=schema or readers.union_schema(spark, root))


def read_cur_month(spark: SparkSession, root: str, year: str, month: str) -> DataFrame:
    """One billing month of the CUR dataset at ``root``, with the columns of
    the whole dataset. Raises if the dataset has no such month."""
    stored = {(int(y), int(m)) for y, m, _ in readers.partition_dirs(spark, root)}
    if (int(year), int(month)) not in stored:
        raise ValueError(f"no billing month {int(year)}-{int(month):02d} under {root}")
    schema = readers.union_schema(spark, root)
    return readers.read_months(spark, root, months=[(year, month)], schema=schema)


def fact_for_period(cur: DataFrame, year: str, month: str) -> DataFrame:
    """The fact rows of one billing month (partition filter on the CUR).
    Year and month are compared as numbers: '09' and '9' are the same month."""
    return fact.fact_direct(month_rows(cur, year, month), months_back=None)


def month_rows(cur: DataFrame, year: str, month: str) -> DataFrame:
    """The rows of one billing month."""
    return cur.where((F.col("year").cast("int") == int(year)) & (F.col("month").cast("int") == int(month)))


def run_fact_job(
    cur: DataFrame,
    fact_path: str,
    year: str | None = None,
    month: str | None = None,
    as_of: _dt.date | str | None = None,
    zone: str = "UTC",
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    stated: bool = False,
) -> None:
    """Rolling-window run (default) or a one-month re-run (year and month).

    The months the run computes are replaced; one of them without rows is
    removed. A one-month run without rows raises, unless the caller states that
    the month exists in the data (``stated``: its folder is there, but empty); a
    window run without any rows changes nothing."""
    if (year is None) != (month is None):
        raise ValueError("give both year and month, or neither")
    if year is not None:
        wanted = (int(year), int(month))
        if not stated and month_rows(cur, year, month).isEmpty():
            raise ValueError(f"no rows of billing month {wanted[0]}-{wanted[1]:02d}")
        writers.replace_months(fact_for_period(cur, year, month), fact_path, lambda m: m == wanted)
        return
    as_of = as_of or today_in(zone)
    rows = fact.fact_direct(cur, as_of=as_of, months_back=months_back)
    if not summary.windowed(cur, as_of, months_back).isEmpty():
        writers.replace_months(rows, fact_path, mart.window_months(as_of, months_back))


def register_summary_view(
    spark: SparkSession, cur: DataFrame, as_of: _dt.date | str | None = None, name: str = "summary_view", **kw
) -> DataFrame:
    """Register the summary as a temporary view for SQL users (lazy: the view
    is a plan, computed by each query that reads it)."""
    df = summary.summary(cur, as_of=as_of, **kw)
    df.createOrReplaceTempView(name)
    return df


def create_summary_view(
    spark: SparkSession,
    table: str,
    view: str,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    tag_prefix: str = C.TAG_PREFIX,
    rules: list[tuple[str, str]] | None = None,
) -> str:
    """Create or replace the catalog view ``view``: the summary of catalog
    table ``table``, which every session reads, its window ending at the day of
    each query unless ``as_of`` is given. The tag columns are those that the
    table has now; run it again when it gets further ones. ``rules`` are
    (product code, service name) pairs in place of the built-in list. Returns
    the view's SQL text."""
    cur = spark.table(table)
    C.require_columns(cur, C.REQUIRED_CUR_COLUMNS)
    statement = summary_sql.view_text(view, table, C.tag_columns(cur, tag_prefix), as_of, months_back, rules)
    spark.sql(statement)
    return statement
