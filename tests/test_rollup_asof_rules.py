"""Mergeable distinct counts, lookups as of a day, and ordered rules as data."""

import datetime as dt
import itertools
import random

import pytest
from costmart import columns as C
from costmart import rules as R
from costmart.operators import asof, rollup, summary, user_rules
from costmart.session import scratch_path
from costmart.sinks import writers
from costmart.sources import readers
from cur_rows import make_cur
from pyspark.sql import functions as F


def day(n):
    return dt.date(2021, 1, 1) + dt.timedelta(days=n)


# ---------------------------------------------------------------- roll-up
def monthly(spark, rows):
    """CUR rows (month, resource id)."""
    return make_cur(spark, [
        {C.MONTH: str(m), C.BILLING_PERIOD_START: dt.datetime(2021, m, 1), C.USAGE_START: dt.datetime(2021, m, 2), C.RESOURCE_ID: r}
        for m, r in rows
    ])


def test_resources_of_several_months_count_once(spark):
    rows = [(8, "a"), (8, "b"), (8, None), (9, "a"), (9, "a"), (10, "c"), (10, None)]
    sketches = rollup.resource_sketches(monthly(spark, rows), as_of="2021-10-15")
    per_month = {r.month: (r.line_items, r.resources) for r in rollup.distinct_resources(sketches, "month").collect()}
    assert per_month == {"8": (3, 2), "9": (2, 1), "10": (2, 1)}
    whole = rollup.distinct_resources(sketches).first()
    assert (whole.line_items, whole.resources) == (7, 3)
    none = rollup.distinct_resources(rollup.resource_sketches(monthly(spark, [(10, None)]), as_of="2021-10-15")).first()
    assert (none.line_items, none.resources) == (1, 0)
    assert rollup.distinct_resources(sketches.limit(0), "month").collect() == []


def test_estimates_stay_within_the_stated_error(spark):
    rows = [(8 + i % 3, f"r{i % 5000}") for i in range(12000)]
    path = scratch_path(spark, "t-sketch")
    for lg_k in (10, 12):
        sketches = rollup.resource_sketches(monthly(spark, rows), as_of="2021-10-15", lg_k=lg_k)
        writers.replace_months(sketches, path, lambda m: True)
        stored = readers.read_parquet(spark, path)
        for months in (["8"], ["8", "9"], ["8", "9", "10"]):
            got = rollup.distinct_resources(stored.where(F.col("month").isin(months))).first().resources
            exact = len({r for m, r in rows if str(m) in months})
            assert abs(got - exact) <= exact * rollup.bound(lg_k)


def test_a_month_is_replaced(spark):
    path = scratch_path(spark, "t-sketch")
    writers.replace_months(rollup.resource_sketches(monthly(spark, [(9, "a"), (10, "b")]), as_of="2021-10-15"), path, lambda m: True)
    again = rollup.resource_sketches(monthly(spark, [(10, "c"), (10, "d")]), as_of="2021-10-15")
    writers.replace_months(again, path, lambda m: m == (2021, 10))
    assert rollup.distinct_resources(readers.read_parquet(spark, path)).first().resources == 3


# ---------------------------------------------------------------- as of a day
HISTORY = "instance_id string, private_ip string, valid_from date, valid_to date"


def looked_up(spark, used, history, bucket_days=32):
    df = spark.createDataFrame(used, "resource_id string, d date, wanted boolean")
    inv = spark.createDataFrame(history, HISTORY)
    rows = asof.with_lookup_as_of(
        df, inv, F.col("resource_id"), F.col("d"), "ip", F.col("wanted"), "instance_id", "private_ip", bucket_days=bucket_days
    )
    assert rows.columns == [*df.columns, "ip"]
    return sorted(((r.resource_id, r.d, r.ip) for r in rows.collect()), key=str)


def test_an_address_that_moved_resolves_by_day(spark):
    history = [("i-1", "old", day(0), day(100)), ("i-1", "new", day(100), None), ("i-2", "old", day(100), day(400))]
    used = [("i-1", day(n), True) for n in (-1, 0, 99, 100, 5000)] + [("i-2", day(n), True) for n in (99, 100, 399, 400)]
    got = {(k, d): ip for k, d, ip in looked_up(spark, used, history)}
    assert [got["i-1", day(n)] for n in (-1, 0, 99, 100, 5000)] == ["", "old", "old", "new", "new"]
    assert [got["i-2", day(n)] for n in (99, 100, 399, 400)] == ["", "old", "old", ""]


def plain(history, key, d):
    """The value of the row that holds on ``d``: the latest start, then the largest value."""
    starts = {}
    for k, v, a, b in history:
        if k == key and a is not None and (b is None or b > a):
            starts.setdefault(a, []).append((v is not None, v or "", b or dt.date(9999, 12, 31)))
    begun = [a for a in starts if a <= d]
    if not begun:
        return ""
    _, value, stop = max(starts[max(begun)])
    return value if d < stop else ""


@pytest.mark.parametrize("bucket_days", [1, 7, 32])
def test_random_intervals_against_brute_force(spark, bucket_days):
    rng = random.Random(bucket_days)
    history = []
    for _ in range(60):
        a = rng.randrange(200)
        stop = None if rng.random() < 0.2 else day(a + rng.randrange(-3, 90))
        history.append((f"i-{rng.randrange(6)}", f"v{rng.randrange(9)}", day(a), stop))
    history += [("i-0", "lost", None, None), (None, "x", day(0), None)]
    used = [(f"i-{k}", day(d), True) for k in range(8) for d in range(-5, 260, 3)]
    expected = sorted(((k, d, plain(history, k, d)) for k, d, _ in used), key=str)
    assert looked_up(spark, used, history, bucket_days) == expected


def test_rows_without_key_or_wish(spark):
    used = [(None, day(1), True), ("i-1", day(1), False), ("i-1", day(1), None), ("i-1", None, True), ("i-1", day(1), True)] * 2
    got = looked_up(spark, used, [("i-1", "v", day(0), None)])
    assert len(got) == 10
    assert sorted({(k, d, ip) for k, d, ip in got}, key=str) == sorted(
        {(None, day(1), ""), ("i-1", day(1), None), ("i-1", None, ""), ("i-1", day(1), "v")}, key=str
    )
    assert looked_up(spark, [], [("i-1", "v", day(0), None)]) == []
    assert looked_up(spark, [("i-1", day(1), True)], []) == [("i-1", day(1), "")]


def test_no_cross_join(spark):
    df = spark.createDataFrame([("i-1", day(1))], "resource_id string, d date")
    inv = spark.createDataFrame([("i-1", "v", day(0), None)], HISTORY)
    rows = asof.instance_addresses(df, inv, "d", F.lit(True))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# ---------------------------------------------------------------- rules
def combinations(spark):
    names = [None, "", R.DATA_TRANSFER, "Other"]
    codes = [None, "", "AmazonS3", "AmazonS3Glacier", "AmazonEC2", R.EMPTY_NAME_FEE_CODE, "awskms", "AWSEvents"]
    kinds = [None, "Fee", "Usage"]
    rows = [
        {C.SERVICE_NAME: n, C.PRODUCT_CODE: c, C.ITEM_TYPE: k, C.BILLING_ENTITY: e, C.PRODUCT_NAME: p}
        for n, c, k, e, p in itertools.product(names, codes, kinds, [None, "AWS", R.MARKETPLACE], [None, "prod"])
    ]
    return make_cur(spark, rows)


def test_builtin_rules_equal_the_case(spark):
    cur = combinations(spark)
    named = user_rules.with_service_names(cur, user_rules.builtin_rules(spark), out="n")
    expected = cur.withColumn("n", summary.service_name_case(C.SERVICE_NAME))
    assert named.exceptAll(expected.select(*named.columns)).isEmpty() and named.count() == cur.count()
    assert user_rules.builtin_rules(spark).count() == 95


def test_first_match_against_brute_force(spark):
    rng = random.Random(3)
    pick = lambda *values: rng.choice(values)
    rules = [
        (
            rng.randrange(20), pick(None, "", R.DATA_TRANSFER, "Other"),
            pick(None, "A", "Amazon", "AmazonS3", "aws", "", "AmazonS3Glacier!"), pick(True, False, True),
            pick(None, None, "Fee", "Usage"), pick(None, None, "AWS"), f"rule {i} {pick('', '{product_name}')}",
        )
        for i in range(40)
    ]
    cur = combinations(spark)
    named = user_rules.with_service_names(cur, spark.createDataFrame(rules, user_rules.SCHEMA), out="n")

    def plain_name(r):
        best = None
        for priority, raw, code, prefix, kind, entity, name in rules:
            asked = ((raw, r[C.SERVICE_NAME]), (kind, r[C.ITEM_TYPE]), (entity, r[C.BILLING_ENTITY]))
            if any(want is not None and want != has for want, has in asked):
                continue
            has = r[C.PRODUCT_CODE]
            if code is not None and (has is None or not (has.startswith(code) if prefix else has == code)):
                continue
            best = min(best or (priority, name), (priority, name))
        if best is None:
            return r[C.SERVICE_NAME]
        if "{product_name}" in best[1]:
            return None if r[C.PRODUCT_NAME] is None else best[1].replace("{product_name}", r[C.PRODUCT_NAME])
        return best[1]

    rows = named.collect()
    assert len(rows) == cur.count()
    assert [r.n for r in rows] == [plain_name(r) for r in rows]


def test_no_rules_and_too_many_lengths(spark):
    cur = combinations(spark)
    none = user_rules.with_service_names(cur, spark.createDataFrame([], user_rules.SCHEMA), out="n")
    assert none.where(~F.col("n").eqNullSafe(F.col(C.SERVICE_NAME))).isEmpty()
    rows = [(1, None, "x" * n, True, None, None, "n") for n in range(1, 300)]
    with pytest.raises(ValueError):
        user_rules.with_service_names(cur, spark.createDataFrame(rows, user_rules.SCHEMA))
    assert user_rules.with_service_names(cur.limit(0), user_rules.builtin_rules(spark)).collect() == []
