"""The whole mart build as one plan: CUR -> fact (partitioned) and the
tag, resource, account and date dimensions.

Shape at scale:

1. One aggregation of the windowed line items at fact grain, keeping the
   tag and resource columns ("wide fact"); one shuffle of partial
   aggregates. It is written once as year/month-partitioned parquet under
   the shared checkpoint folder. That cuts the lineage (a lost executor
   re-reads the staged files instead of re-running the aggregation) and,
   being columnar, lets each output read only its columns: the tag
   dimension reads the tag columns, the resource dimension seven columns.
2. fact = projection of the wide fact, written by year/month with dynamic
   partition overwrite (older months keep their files); it is read from the
   month-partitioned staging, so the write needs no second shuffle. The
   staging folder is removed once all outputs are written.
3. tag and resource dimensions = distinct projections of the wide fact
   (small: fact rows, not line items).
4. account and date dimensions read the whole raw table (not only the
   window) once: its accounts with their first and last day are staged.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import dates
from ..operators import dims, enrich, fact
from ..session import configure, scratch_path
from ..sinks import writers
from ..sources import readers


DIMENSION_KEYS = {
    "tag_dim": dims.TAG_KEY,
    "resource_dim": dims.RESOURCE_KEY,
    "account_dim": dims.ACCOUNT_KEY,
    "date_dim": dims.DATE_KEY,
}


@dataclass
class Mart:
    fact: DataFrame
    tag_dim: DataFrame
    resource_dim: DataFrame
    account_dim: DataFrame
    date_dim: DataFrame
    # the fact is read from month-partitioned staged files: a scan split
    # holds files of one (or, when small files are packed, a few) months,
    # so it is written without another shuffle
    fact_split_by_month: bool = False
    # folder of the staged wide fact and accounts, removed after a successful write
    staging: str | None = None
    # the months this run computed: one of them without rows loses its stored rows
    owns: Callable[[tuple[int, int]], bool] | None = None


def build(
    cur: DataFrame,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    instances: DataFrame | None = None,
    materialize: bool = True,
    history: DataFrame | None = None,
    rules: DataFrame | None = None,
    accounts: DataFrame | None = None,
    with_name: bool = False,
) -> Mart:
    """The five mart tables as DataFrames. With ``materialize`` the wide fact
    and the accounts with their days are computed once each and staged as parquet
    in the shared folder; the returned frames read them. ``history`` is the whole-history CUR for the
    account and date dimensions when ``cur`` was read for the window only
    (see ``jobs.read_cur_window``); by default ``cur`` itself. ``rules``
    replaces the built-in service rules, ``accounts`` adds account names,
    ``with_name`` adds the Name tag to the resource dimension."""
    spark = cur.sparkSession
    configure(spark)
    wide = fact.fact_wide_direct(cur, as_of=as_of, months_back=months_back, rules=rules, by_month=materialize)
    spans = dims.account_spans(history if history is not None else cur)
    if materialize:
        staged = scratch_path(spark, "mart")
        writers.write_partitioned(wide, f"{staged}/wide_fact", rebalance=False)
        wide = spark.read.schema(wide.schema).parquet(f"{staged}/wide_fact")  # also where the window holds no rows
        spans.write.parquet(f"{staged}/accounts")
        spans = spark.read.schema(spans.schema).parquet(f"{staged}/accounts")
    account_dim = dims.account_dim(spans)
    return Mart(
        fact=fact.narrow(wide),
        tag_dim=dims.tag_dim(wide),
        resource_dim=dims.resource_dim(wide, instances, with_name=with_name),
        account_dim=account_dim if accounts is None else enrich.account_names(account_dim, accounts),
        date_dim=dims.calendar(spans),
        fact_split_by_month=materialize,
        staging=staged if materialize else None,
        owns=window_months(as_of, months_back),
    )


def window_months(as_of: _dt.date | str | None, months_back: int | None) -> Callable[[tuple[int, int]], bool]:
    """Whether a (year, month) lies in the rolling window; without one, every month does."""
    if months_back is None:
        return lambda month: True
    start = dates.window_start(dates.as_date(as_of), months_back)
    return lambda month: month >= (start.year, start.month)


def _write_fact(mart: Mart, path: str) -> None:
    rebalance = not mart.fact_split_by_month
    # a run without any rows (say, a wrong path) leaves what is stored alone
    if mart.owns is None or mart.fact.isEmpty():
        writers.write_partitioned(mart.fact, path, rebalance=rebalance)
    else:
        writers.replace_months(mart.fact, path, mart.owns, rebalance=rebalance)


def write(mart: Mart, root: str, concurrent: bool = True) -> dict[str, str]:
    """Write the mart under ``root``: the fact partitioned with dynamic
    overwrite (partitions are swapped in at job commit); a month of the window
    that has no rows any more is removed. The fact keeps the months outside the window, so the tag and resource dimensions keep their
    stored keys: new rows are merged in (latest lookups win). The account and
    date dimensions cover the whole history and are replaced (account dim only
    if non-empty).

    The five writes are independent jobs; with ``concurrent`` they are
    submitted together from a thread pool, so the small dimension jobs run
    beside the fact write instead of after it. Any failure is re-raised.
    The staging folder is removed in either case: read the written outputs,
    not ``mart``'s frames, from then on.
    """
    root = root.rstrip("/")
    paths = {name: f"{root}/{name}" for name in ("cost_insights_fact", "tag_dim", "resource_dim", "account_dim", "date_dim")}
    tasks = [
        lambda: _write_fact(mart, paths["cost_insights_fact"]),
        lambda: merge_tags(mart.tag_dim, root),
        lambda: writers.merge_keys(mart.resource_dim, paths["resource_dim"], dims.RESOURCE_KEY),
        lambda: writers.write_if_any(mart.account_dim, lambda d: writers.replace_dataset(d, paths["account_dim"])),
        lambda: writers.replace_dataset(mart.date_dim, paths["date_dim"]),
    ]
    try:
        with ThreadPoolExecutor(max_workers=len(tasks) if concurrent else 1) as pool:
            for future in [pool.submit(task) for task in tasks]:
                future.result()
    finally:
        if mart.staging:
            readers.delete(mart.fact.sparkSession, mart.staging)
    return paths


def refresh(
    spark: SparkSession,
    cur: DataFrame,
    root: str,
    months: list[tuple[str, str]],
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    instances: DataFrame | None = None,
    rules: DataFrame | None = None,
    accounts: DataFrame | None = None,
    with_name: bool = False,
) -> None:
    """Bring the mart under ``root`` up to date with ``cur``, the rows of
    ``months``: their fact months are replaced (or removed, without rows) and
    their keys merged into all four dimensions, in one run.

    The dimensions are written before the fact, so that no fact row ever lacks
    its dimension rows, also if the run fails in between."""
    configure(spark)
    root = root.rstrip("/")
    wanted = {readers.month_number(y, m) for y, m in months}
    wide = fact.fact_wide_direct(cur, as_of=as_of, months_back=months_back, rules=rules, by_month=True)
    staged = scratch_path(spark, "wide_fact")
    writers.write_partitioned(wide, staged, rebalance=False)
    try:
        rows = spark.read.schema(wide.schema).parquet(staged)
        merge_attributes(rows, root, instances, with_name)
        merge_accounts(dims.account_dim(cur), root, accounts)
        merge_days(dims.day_bounds(cur), root)
        writers.replace_months(fact.narrow(rows), f"{root}/cost_insights_fact", wanted.__contains__, rebalance=False)
    finally:
        readers.delete(spark, staged)


def merge_attributes(wide: DataFrame, root: str, instances: DataFrame | None, with_name: bool = False) -> None:
    """Merge the tag and resource keys of a wide fact into the stored dimensions."""
    merge_tags(dims.tag_dim(wide), root)
    resources = dims.resource_dim(wide, instances, with_name=with_name)
    writers.merge_keys(resources, f"{root}/resource_dim", dims.RESOURCE_KEY)


def merge_tags(tags: DataFrame, root: str) -> None:
    """Merge tag rows into the stored dimension, and their stable keys beside it
    (``tag_key_map``, ``tag_set_dim``). A mart that was written without stable
    keys gets those of its stored rows first."""
    spark = tags.sparkSession
    stored, map_path, sets_path = f"{root}/tag_dim", f"{root}/tag_key_map", f"{root}/tag_set_dim"
    if readers.exists(spark, stored) and not readers.exists(spark, map_path):
        _merge_tag_sets(readers.read_parquet(spark, stored, merge_schema=True), map_path, sets_path)
    _merge_tag_sets(tags, map_path, sets_path)
    writers.merge_keys(tags, stored, dims.TAG_KEY, absent="")


def _merge_tag_sets(tags: DataFrame, map_path: str, sets_path: str) -> None:
    writers.merge_keys(dims.tag_set_dim(tags), sets_path, dims.TAG_SET_KEY, absent="")
    writers.merge_keys(dims.tag_key_map(tags), map_path, dims.TAG_KEY)


def merge_accounts(pairs: DataFrame, root: str, accounts: DataFrame | None) -> None:
    """Add the (payer, usage account) pairs to the stored account dimension."""
    path = f"{root}/account_dim"
    spark = pairs.sparkSession
    if readers.exists(spark, path):
        stored = readers.read_parquet(spark, path)
        if pairs.join(stored, [C.PAYER, C.USAGE_ACCOUNT], "left_anti").isEmpty() and accounts is None:
            return
        names = stored.select(*pairs.columns)
        pairs = pairs.union(names).distinct()
        if accounts is None and "account_name" in stored.columns:  # keep the names of known accounts
            known = stored.select(F.col(C.USAGE_ACCOUNT).alias("account_id"), "account_name")
            accounts = known
    rows = pairs if accounts is None else enrich.account_names(pairs, accounts)
    writers.write_if_any(rows, lambda d: writers.replace_dataset(d, path))


def merge_days(bounds: DataFrame, root: str) -> None:
    """Extend the stored date dimension to the days of ``bounds`` (lo, hi)."""
    path = f"{root}/date_dim"
    spark = bounds.sparkSession
    if readers.exists(spark, path):
        bounds = bounds.union(dims.stored_bounds(readers.read_parquet(spark, path)))
    writers.write_if_any(dims.calendar(bounds), lambda d: writers.replace_dataset(d, path))
