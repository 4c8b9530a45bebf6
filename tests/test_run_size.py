"""What a run of many steps leaves on disk, shuffles and writes."""

import time

from costmart.operators import fact
from costmart.plans import mart
from costmart.session import configure, scratch_path
from costmart.sinks import writers
from costmart.sources import fixtures as FX
from test_month_layout import plain_cur, same, tables


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_of_a_write_go_with_it(spark):
    configure(spark)
    before = shuffle_files(spark)
    cur = FX.cur_from_tables(spark, tables(spark, undated=False))
    sums = fact.partial_sums(cur, ("bill_payer_account_id",))
    writers.write_partitioned(sums, scratch_path(spark, "t-sums"))
    end = time.time() + 5  # files are removed in the background
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.1)
    assert not left, sorted(left)


def test_parquet_is_written_with_zstd(spark):
    configure(spark)
    path = scratch_path(spark, "t-codec")
    spark.range(10).write.parquet(path)
    names = [r[0] for r in spark.read.parquet(path).selectExpr("_metadata.file_name").distinct().collect()]
    assert names and all(".zstd." in n for n in names)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_mart_deals_its_rows_by_month_before_it_makes_their_keys(spark):
    path = tables(spark)
    cur = FX.cur_from_tables(spark, path)
    plan = plan_of(fact.fact_wide_direct(cur, as_of=FX.AS_OF, by_month=True))
    # read from the top: the keys are made over the shuffle by month
    assert plan.index("sha2(") < plan.index("RebalancePartitions") and "sha2(" not in plan[plan.index("RebalancePartitions") :]
    sums = fact.partial_sums(cur, ("bill_payer_account_id",))
    plan = plan_of(fact.wide_from_partials(sums, ["resource_tags_user_env"], by_month=True))
    assert "sha2(" not in plan[plan.index("RebalancePartitions") :]
    built = mart.build(cur, as_of=FX.AS_OF)
    assert same(built.fact, fact.fact_direct(plain_cur(spark, path), as_of=FX.AS_OF))


def test_customers_meet_the_orders_and_not_the_line_items(spark):
    lines = plan_of(FX.cur_from_tables(spark, tables(spark))).splitlines()
    at = next(i for i, line in enumerate(lines) if "Join" in line and "o_custkey" in line)
    depth = lines[at].index("Join")
    under = []
    for line in lines[at + 1 :]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        under.append(line)
    assert any("c_custkey" in u for u in under) and not any("l_orderkey" in u for u in under)
