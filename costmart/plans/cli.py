"""Command-line job: build and write the cost mart.

    spark-submit --conf spark.checkpoint.dir=<shared folder> --py-files costmart.zip \\
        scripts/build_mart.py --cur s3://bucket/cur/ --out s3://bucket/mart/ \\
        [--as-of 2021-10-15 | --zone Asia/Kolkata] [--year 2021 --month 9] \\
        [--instances inventory.instances] [--months-back 7] [--warehouse-db billing_mart]

(or ``python -m costmart.plans.cli ...`` with a local master).

``--cur`` is a year/month-partitioned parquet path or a catalog table name.
Without ``--year/--month`` the rolling window ending at ``--as-of`` (default:
today in ``--zone``) is rebuilt; the fact's older months stay (dynamic
partition overwrite). With them, only that month of the fact is rebuilt, and
its keys are merged into the dimensions. ``--incremental`` keeps partial sums
by source file beside the mart and reads only files that changed since its last
run (see ``costmart.streaming.partials``).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..functions import dates
from ..session import configure
from ..sinks import writers
from ..sources import readers
from ..streaming import partials
from . import jobs, mart, warehouse


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="costmart", description="Build the cost mart from a CUR table.")
    p.add_argument("--cur", required=True, help="CUR parquet path (year=/month= folders) or catalog table")
    p.add_argument("--out", required=True, help="output root for the fact and the dimensions")
    p.add_argument("--as-of", dest="as_of", help="date the rolling window ends at (YYYY-MM-DD)")
    p.add_argument("--zone", default="UTC", help="time zone for the default --as-of")
    p.add_argument("--months-back", dest="months_back", type=int, default=dates.DEFAULT_MONTHS_BACK)
    p.add_argument("--year")
    p.add_argument("--month")
    p.add_argument("--instances", help="instance inventory table (account_id, instance_id, private_ip, tags)")
    p.add_argument("--with-name", dest="with_name", action="store_true", help="add the Name tag to the resource dim")
    p.add_argument("--accounts", help="account table (account_id, account_name): adds account names")
    p.add_argument("--rules", help="service rule table (product_code, service_name) in place of the built-in one")
    p.add_argument("--all-months", dest="all_months", action="store_true", help="backfill: no rolling window")
    p.add_argument("--warehouse-db", dest="warehouse_db", help="also load the mart into this catalog database")
    p.add_argument("--summary-view", dest="summary_view",
                   help="also create or replace this catalog view: the summary of the --cur table")
    p.add_argument("--incremental", action="store_true",
                   help="read only files that changed since the last incremental run into --out")
    a = p.parse_args(argv)
    if (a.year is None) != (a.month is None):
        p.error("give both --year and --month, or neither")
    if a.summary_view and _is_path(a.cur):
        p.error("--summary-view takes a --cur table")
    if a.incremental and (a.year is not None or not _is_path(a.cur)):
        p.error("--incremental takes a --cur path and no --year/--month")
    return a


def _is_path(name: str) -> bool:
    return "/" in name or ":" in name


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    a = parse(argv)
    spark = configure(spark or SparkSession.builder.appName("costmart").getOrCreate())
    out = a.out.rstrip("/")
    instances = spark.table(a.instances) if a.instances else None
    rules = spark.table(a.rules).select("product_code", "service_name") if a.rules else None
    if rules is not None:  # one name per code
        rules = writers.one_per_key(rules.toDF("rule_product_code", "rule_service_name"), "rule_product_code")
    accounts = spark.table(a.accounts) if a.accounts else None
    lookups = {"instances": instances, "rules": rules, "accounts": accounts, "with_name": a.with_name}
    as_of = dates.as_date(a.as_of) if a.as_of else jobs.today_in(a.zone)
    if a.summary_view:  # its window ends at the day of each query, unless --as-of is given
        pairs = None if rules is None else [tuple(r) for r in rules.collect()]
        months_back = None if a.all_months else a.months_back
        jobs.create_summary_view(spark, a.cur, a.summary_view, a.as_of, months_back, rules=pairs)
    if a.year is not None:
        # one-month re-run: only that month is listed and read, only that month of the fact
        # replaced; its keys are merged into the dimensions
        month = jobs.read_cur_month(spark, a.cur, a.year, a.month) if _is_path(a.cur) else spark.table(a.cur)
        rows = jobs.month_rows(month, a.year, a.month)
        if not _is_path(a.cur) and rows.isEmpty():
            raise ValueError(f"no rows of billing month {int(a.year)}-{int(a.month):02d} in {a.cur}")
        mart.refresh(spark, rows, out, [(a.year, a.month)], months_back=None, **lookups)
        return _finished(spark, out, a.warehouse_db)
    if a.incremental:
        months_back = None if a.all_months else a.months_back
        partials.refresh(spark, a.cur, out, as_of=as_of, months_back=months_back, **lookups)
        return _finished(spark, out, a.warehouse_db)
    history = readers.read_parquet(spark, a.cur, merge_schema=True) if _is_path(a.cur) else spark.table(a.cur)
    months_back = None if a.all_months else a.months_back
    windowed = _is_path(a.cur) and months_back is not None
    window = jobs.read_cur_window(spark, a.cur, as_of, months_back, history.schema) if windowed else history
    m = mart.build(window, as_of=as_of, months_back=months_back, history=history, **lookups)
    mart.write(m, out)
    return _finished(spark, out, a.warehouse_db)


def _finished(spark: SparkSession, out: str, database: str | None) -> dict[str, str]:
    """The mart's paths, after loading it into ``database`` if one is given."""
    if database:
        writers.ensure_database(spark, database)
        warehouse.load(spark, out, database)
    return {name: f"{out}/{name}" for name in ("cost_insights_fact", *mart.DIMENSION_KEYS)}


if __name__ == "__main__":
    main()
