"""Property tests on random CUR rows (hypothesis): the one-level fact equals
the two-level fact, measures reconcile across levels, the lookup join
equals the CASE chain, and the summary equals the DuckDB oracle on the
same rows."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from costmart import columns as C
from costmart.operators import checks, fact, summary
from costmart.testing import oracle as O
from costmart.testing.compare import compare
from cur_rows import make_cur

AS_OF = "2021-10-15"

money = st.one_of(st.none(), st.decimals(min_value=-1000, max_value=1000, places=2, allow_nan=False))
text = lambda *vals: st.sampled_from(list(vals))

row = st.fixed_dictionaries(
    {
        "month": text("2", "3", "9", "10"),
        "day": st.integers(1, 28),
        "hour": st.integers(0, 23),
        C.USAGE_ACCOUNT: text("a1", "a2"),
        C.ITEM_TYPE: text("Usage", "SavingsPlanCoveredUsage", "SavingsPlanRecurringFee", "SavingsPlanNegation",
                          "SavingsPlanUpfrontFee", "DiscountedUsage", "RIFee", "Fee", "Tax", None),
        C.SP_ARN: text("", "sp-1", None),
        C.RI_ARN: text("", "ri-1", None),
        C.USAGE_TYPE: text("EU-SpotUsage", "EU-BoxUsage", None),
        C.PRODUCT_CODE: text("AmazonEC2", "AmazonS3", "AmazonGlacier", "OCBElasticComputeCloud", "Other"),
        C.SERVICE_NAME: text("AWS Data Transfer", "", "Amazon S3", None),
        C.BILLING_ENTITY: text("AWS", "AWS Marketplace"),
        C.PRODUCT_NAME: text("Widget", None),
        C.SERVICE_CODE: text("", "svc"),
        C.DESCRIPTION: text("m5.large Linux/UNIX Spot", "nospace", "a.b c/d e", None),
        C.RESOURCE_ID: text("i-1", "arn:x:i-2", None, "bucket"),
        C.USAGE_AMOUNT: money,
        C.UNBLENDED: money,
        C.RI_UNUSED_RECURRING: money,
        "resource_tags_user_env": text("", "prod", None),
        "resource_tags_user_team": text("core", None),
    }
)


def _cur(spark, rows):
    full = []
    for r in rows:
        r = dict(r)
        m, day, hour = int(r.pop("month")), r.pop("day"), r.pop("hour")
        r["year"], r["month"] = "2021", str(m)
        r[C.BILLING_PERIOD_START] = dt.datetime(2021, m, 1)
        r[C.USAGE_START] = dt.datetime(2021, m, day, hour)
        full.append(r)
    return make_cur(spark, full)


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_one_level_fact_equals_two_level(spark, rows):
    cur = _cur(spark, rows)
    assert _same(fact.fact(summary.summary(cur, as_of=AS_OF)), fact.fact_direct(cur, as_of=AS_OF))
    assert _same(
        fact.fact_direct(cur, as_of=AS_OF, service_names="case"), fact.fact_direct(cur, as_of=AS_OF)
    )


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_measures_reconcile(spark, rows):
    cur = _cur(spark, rows)
    s = summary.summary(cur, as_of=AS_OF)
    levels = checks.reconciliation(summary.windowed(cur, AS_OF, 7), s, fact.fact_direct(cur, as_of=AS_OF)).collect()
    assert len({tuple(r)[1:] for r in levels}) == 1


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    return con


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_summary_matches_oracle_on_random_rows(spark, duck, rows):
    cur = _cur(spark, rows)
    duck.register("random_cur_df", cur.toPandas())
    duck.execute("CREATE OR REPLACE TABLE random_cur AS SELECT * FROM random_cur_df")
    sql = f"WITH {O.view_cte(AS_OF, 7, source='random_cur')} SELECT * FROM v"
    df = summary.summary(cur, as_of=AS_OF)
    df = df.withColumns({m: df[m].cast("decimal(38,2)") for m in C.MEASURES})
    r = compare(df, duck, sql)
    assert r["ok"], r
