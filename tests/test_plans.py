"""Plan properties and whole-pipeline equalities on the test tables."""

import pytest

from costmart.operators import fact, summary
from costmart.plans import mart
from costmart.sources import fixtures as FX

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cur(spark):
    return FX.cur_from_tables(spark, SF_SMALL)


def test_fact_equals_fact_direct(cur):
    two = fact.fact(summary.summary(cur, as_of=FX.AS_OF))
    one = fact.fact_direct(cur, as_of=FX.AS_OF)
    assert two.count() == one.count() > 0
    assert two.exceptAll(one).isEmpty() and one.exceptAll(two).isEmpty()


def test_case_strategy_equals_join(cur):
    a = fact.fact_direct(cur, as_of=FX.AS_OF, service_names="join")
    b = fact.fact_direct(cur, as_of=FX.AS_OF, service_names="case")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_direct_has_one_aggregation_shuffle(cur):
    plan = _plan(fact.fact_direct(cur, as_of=FX.AS_OF))
    assert plan.count("HashAggregate") == 2  # partial + final
    for marker in ("BatchEvalPython", "ArrowEvalPython"):
        assert marker not in plan


def test_window_filter_reaches_lineitem_scan(spark, cur):
    df = fact.fact_direct(cur, as_of=FX.AS_OF)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    # the window predicate is evaluated on lineitem, below the joins
    i_filter = optimized.find("date_trunc(month")
    assert i_filter > optimized.rfind("Join")


def test_partition_pruning_on_materialized_cur(spark, cur):
    from costmart.session import scratch_path
    from costmart.sinks import writers
    from costmart.sources import readers

    path = scratch_path(spark, "t-cur")
    writers.write_partitioned(cur, path)
    stored = readers.read_parquet(spark, path)
    df = fact.fact_direct(stored, as_of=FX.AS_OF)
    plan = _plan(df)
    assert "PartitionFilters: [" in plan and "make_date" in plan
    assert "PushedFilters: [" in plan and "bill_billing_period_start_date" in plan
    direct = fact.fact_direct(cur, as_of=FX.AS_OF)
    assert df.exceptAll(direct).isEmpty() and direct.exceptAll(df).isEmpty()


def test_mart_build_reconciles(spark, cur):
    from costmart.operators import checks, dims

    m = mart.build(cur, as_of=FX.AS_OF, instances=FX.instances_from_tables(spark, SF_SMALL))
    for name, dim, key in [
        ("tag_dim", m.tag_dim, dims.TAG_KEY),
        ("resource_dim", m.resource_dim, dims.RESOURCE_KEY),
        ("account_dim", m.account_dim, dims.ACCOUNT_KEY),
        ("date_dim", m.date_dim, dims.DATE_KEY),
    ]:
        assert checks.orphan_keys(m.fact, dim, key).isEmpty(), name
    assert checks.duplicate_keys(m.tag_dim, dims.TAG_KEY).isEmpty()
    rec = checks.reconciliation(summary.windowed(cur, FX.AS_OF, 7), summary.summary(cur, as_of=FX.AS_OF), m.fact).collect()
    assert len({tuple(r)[1:] for r in rec}) == 1


def test_mart_write(spark, cur):
    from costmart.session import scratch_path
    from costmart.sources import readers

    m = mart.build(cur, as_of=FX.AS_OF)
    n = m.fact.count()
    paths = mart.write(m, scratch_path(spark, "t-mart"))
    assert readers.read_parquet(spark, paths["cost_insights_fact"]).count() == n
    assert not readers.exists(spark, m.staging)


def test_cli_builds_mart_and_reruns_one_month(spark, cur):
    from costmart.plans import cli
    from costmart.session import scratch_path
    from costmart.sinks import writers
    from costmart.sources import readers

    cur_path = scratch_path(spark, "t-cli-cur")
    writers.write_partitioned(cur, cur_path)
    out = scratch_path(spark, "t-cli-out")
    import uuid

    db = f"t_cli_{uuid.uuid4().hex[:8]}"
    writers.ensure_database(spark, db, scratch_path(spark, db))
    paths = cli.main(["--cur", cur_path, "--out", out, "--as-of", FX.AS_OF, "--warehouse-db", db], spark=spark)
    assert spark.table(f"{db}.cost_insights_fact").count() == fact.fact_direct(cur, as_of=FX.AS_OF).count()
    assert "year" not in spark.table(f"{db}.cost_insights_fact").columns
    fact_path = paths["cost_insights_fact"]
    stored = readers.read_parquet(spark, fact_path)
    expected = fact.fact_direct(cur, as_of=FX.AS_OF)
    assert stored.select(*expected.columns).exceptAll(expected).isEmpty()
    assert readers.read_parquet(spark, paths["date_dim"]).count() > 0
    before = stored.where("month <> '9'").count()
    cli.main(["--cur", cur_path, "--out", out, "--year", "2001", "--month", "9"], spark=spark)
    again = readers.read_parquet(spark, fact_path)
    assert again.where("month <> '9'").count() == before
    assert again.where("year = '2001' AND month = '9'").count() == expected.where("month = '9'").count()


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(1 for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_summary_has_one_shuffle_and_labels_after_it(cur):
    s = summary.summary(cur, as_of=FX.AS_OF)
    assert _shuffles(s) == 1
    plan = s._jdf.queryExecution().executedPlan().toString()
    # the rules join sits above the final aggregation (labels over groups)
    assert plan.find("BroadcastHashJoin") < plan.find("HashAggregate")


def test_dims_take_one_aggregation(cur):
    from costmart.operators import dims

    via_items = dims.tag_dim(summary.line_items(cur, FX.AS_OF))
    via_summary = dims.tag_dim(summary.summary(cur, as_of=FX.AS_OF))
    # Catalyst removes the summary's aggregation under the duplicate-agnostic
    # distinct (RemoveRedundantAggregates): both are one shuffle
    assert _shuffles(via_items) == 1 and _shuffles(via_summary) == 1
    assert via_items.exceptAll(via_summary).isEmpty() and via_summary.exceptAll(via_items).isEmpty()


def test_run_fact_job_window_and_one_month(spark, cur):
    from costmart.plans import jobs
    from costmart.session import scratch_path
    from costmart.sources import readers

    path = scratch_path(spark, "t-job")
    jobs.run_fact_job(cur, path, as_of=FX.AS_OF)
    window = readers.read_parquet(spark, path)
    expected = fact.fact_direct(cur, as_of=FX.AS_OF)
    assert window.select(*expected.columns).exceptAll(expected).isEmpty()
    n = window.count()  # before the re-run replaces the month's files
    jobs.run_fact_job(cur, path, year="2001", month="9")
    again = readers.read_parquet(spark, path)
    assert again.count() == n  # the month was replaced by the same rows
    import pytest

    with pytest.raises(ValueError):
        jobs.run_fact_job(cur, path, year="2001")
