"""Incremental fact refresh with an availableNow file stream."""

import datetime as dt
from decimal import Decimal

from costmart.operators import fact
from costmart.session import scratch_path
from costmart.sources import readers
from costmart.streaming import incremental
from cur_rows import make_cur


def _rows(day, cost, sku):
    return {
        "year": "2021", "month": str(day.month),
        "bill_billing_period_start_date": dt.datetime(day.year, day.month, 1),
        "line_item_usage_start_date": dt.datetime(day.year, day.month, day.day, 3),
        "line_item_unblended_cost": Decimal(cost), "product_sku": sku,
    }


def test_stream_refreshes_touched_months_only(spark):
    root = scratch_path(spark, "t-stream")
    cur_path, fact_path, ckpt = f"{root}/cur", f"{root}/fact", f"{root}/ckpt"
    first = make_cur(spark, [_rows(dt.date(2021, 9, 1), 1, "a"), _rows(dt.date(2021, 10, 1), 2, "a")])
    first.write.mode("append").partitionBy("year", "month").parquet(cur_path)
    incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15")
    got = {(r.month, r.unblended_cost) for r in readers.read_parquet(spark, fact_path).collect()}
    assert got == {("9", Decimal(1)), ("10", Decimal(2))}

    # a late row for October (same fact key: same day and attributes)
    late = make_cur(spark, [_rows(dt.date(2021, 10, 1), 5, "b")])
    late.write.mode("append").partitionBy("year", "month").parquet(cur_path)
    incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15")
    got = {(r.month, r.unblended_cost) for r in readers.read_parquet(spark, fact_path).collect()}
    assert got == {("9", Decimal(1)), ("10", Decimal(7))}

    whole = fact.fact_direct(readers.read_parquet(spark, cur_path), as_of="2021-10-15")
    stored = readers.read_parquet(spark, fact_path).select(*whole.columns)
    assert whole.exceptAll(stored).isEmpty() and stored.exceptAll(whole).isEmpty()


def test_refresh_is_idempotent_on_replay(spark):
    root = scratch_path(spark, "t-replay")
    cur_path, fact_path = f"{root}/cur", f"{root}/fact"
    make_cur(spark, [_rows(dt.date(2021, 9, 3), 4, "a"), _rows(dt.date(2021, 9, 4), 6, "b")]).write.mode(
        "append"
    ).partitionBy("year", "month").parquet(cur_path)
    for _ in range(2):  # a replayed micro-batch refreshes the same month again
        incremental.refresh_months(spark, cur_path, fact_path, [("2021", "9")], as_of="2021-10-15")
    got = sorted((r.date_dim_id, r.unblended_cost) for r in readers.read_parquet(spark, fact_path).collect())
    assert got == [("20210903", Decimal(4)), ("20210904", Decimal(6))]


def test_delivery_order_does_not_matter(spark):
    deliveries = [
        [_rows(dt.date(2021, 10, 2), 1, "a")],
        [_rows(dt.date(2021, 3, 9), 2, "b"), _rows(dt.date(2021, 10, 2), 3, "c")],
        [_rows(dt.date(2021, 2, 1), 5, "d")],  # before the window: ignored
    ]
    results = []
    for order in ([0, 1, 2], [2, 1, 0]):
        root = scratch_path(spark, "t-order")
        cur_path, fact_path, ckpt = f"{root}/cur", f"{root}/fact", f"{root}/ckpt"
        for i in order:
            make_cur(spark, deliveries[i]).write.mode("append").partitionBy("year", "month").parquet(cur_path)
            incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15")
        results.append(sorted((r.month, r.unblended_cost) for r in readers.read_parquet(spark, fact_path).collect()))
    assert results[0] == results[1] == [("10", Decimal(4)), ("3", Decimal(2))]


def test_backlog_in_many_batches_refreshes_each_month_once(spark):
    root = scratch_path(spark, "t-backlog")
    cur_path, fact_path, ckpt = f"{root}/cur", f"{root}/fact", f"{root}/ckpt"
    for i, day in enumerate([dt.date(2021, 9, 1), dt.date(2021, 9, 2), dt.date(2021, 10, 1), dt.date(2021, 10, 5)]):
        make_cur(spark, [_rows(day, i + 1, f"s{i}")]).write.mode("append").partitionBy("year", "month").parquet(cur_path)
    refreshed = incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15")
    assert sorted(refreshed) == [("2021", "10"), ("2021", "9")]  # once each, not once per batch
    whole = fact.fact_direct(readers.read_parquet(spark, cur_path), as_of="2021-10-15")
    stored = readers.read_parquet(spark, fact_path).select(*whole.columns)
    assert whole.exceptAll(stored).isEmpty() and stored.exceptAll(whole).isEmpty()
    assert incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15") == []


def test_continuous_mode_refreshes_per_batch(spark):
    root = scratch_path(spark, "t-continuous")
    cur_path, fact_path, ckpt = f"{root}/cur", f"{root}/fact", f"{root}/ckpt"
    make_cur(spark, [_rows(dt.date(2021, 10, 1), 2, "a")]).write.mode("append").partitionBy("year", "month").parquet(cur_path)
    query = incremental.start(spark, cur_path, fact_path, ckpt, as_of="2021-10-15", available_now=False)
    try:
        query.processAllAvailable()
        got = {(r.month, r.unblended_cost) for r in readers.read_parquet(spark, fact_path).collect()}
        assert got == {("10", Decimal(2))}
    finally:
        query.stop()


def test_rewritten_and_removed_files_are_seen(spark):
    root = scratch_path(spark, "t-rewrite")
    cur_path, fact_path, ckpt = f"{root}/cur", f"{root}/fact", f"{root}/ckpt"

    def deliver(cost, months):
        rows = make_cur(spark, [_rows(dt.date(2021, m, 2), cost, f"m{m}") for m in months])
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("year", "month").parquet(cur_path)

    def stored():
        return {(r.month, r.unblended_cost) for r in readers.read_parquet(spark, fact_path).collect()}

    deliver(2, [9, 10])
    assert len(incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15")) == 2
    deliver(50, [9, 10])
    assert len(incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15")) == 2
    assert stored() == {("9", Decimal(50)), ("10", Decimal(50))}
    deliver(50, [10])  # September is withdrawn
    incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15")
    assert stored() == {("10", Decimal(50))}


def test_months_outside_the_window_are_not_reported_and_stay_changed(spark):
    root = scratch_path(spark, "t-late")
    cur_path, fact_path, ckpt = f"{root}/cur", f"{root}/fact", f"{root}/ckpt"
    make_cur(spark, [_rows(dt.date(2021, 2, 1), 7, "old")]).write.partitionBy("year", "month").parquet(cur_path)
    assert incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of="2021-10-15") == []
    assert incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, months_back=None) == [("2021", "2")]
    assert incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, months_back=None) == []
