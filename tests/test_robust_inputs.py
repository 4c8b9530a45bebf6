"""Inputs that a clean fixture does not hold: drifting columns, repeated ids, padded months, failed swaps."""

import datetime as dt
from decimal import Decimal

import pytest
from costmart.operators import dims, enrich
from costmart.plans import cli, jobs
from costmart.session import scratch_path
from costmart.sinks import writers
from costmart.sources import readers
from cur_rows import make_cur
from pyspark.sql import functions as F


def _cur(spark, month, tags, **kw):
    row = {
        "year": "2021",
        "month": str(month),
        "bill_billing_period_start_date": dt.datetime(2021, month, 1),
        "line_item_usage_start_date": dt.datetime(2021, month, 2, 5),
        "line_item_line_item_type": "Usage",
        "line_item_unblended_cost": Decimal(3),
        **kw,
    }
    rows = make_cur(spark, [row])
    have = [c for c in rows.columns if c.startswith("resource_tags_")]
    return rows.drop(*have).withColumns({t: F.lit(v) for t, v in tags.items()})


def test_cli_keeps_a_tag_that_only_some_months_have(spark):
    root = scratch_path(spark, "t-drift")
    for month, tags in ((8, {"resource_tags_user_a": "x"}), (9, {"resource_tags_user_a": "x", "resource_tags_user_b": "y"})):
        _cur(spark, month, tags).write.mode("append").partitionBy("year", "month").parquet(f"{root}/cur")
    args = ["--cur", f"{root}/cur", "--out", f"{root}/mart", "--as-of", "2021-10-15"]
    cli.main(args, spark)
    tags = readers.read_parquet(spark, f"{root}/mart/tag_dim")
    got = {(r.resource_tags_user_a, r.resource_tags_user_b) for r in tags.collect()}
    assert got == {("x", ""), ("x", "y")}
    keys = {r.tag_dim_id for r in tags.collect()}
    before = {r.tag_dim_id for r in readers.read_parquet(spark, f"{root}/mart/cost_insights_fact").collect()}
    # a re-run of the month without the tag gives the same keys
    cli.main([*args, "--year", "2021", "--month", "08"], spark)
    after = {r.tag_dim_id for r in readers.read_parquet(spark, f"{root}/mart/cost_insights_fact").collect()}
    assert before == after == keys
    with pytest.raises(ValueError, match="no billing month 2021-01"):
        cli.main([*args, "--year", "2021", "--month", "1"], spark)


def test_padded_month(spark):
    cur = _cur(spark, 9, {}).withColumn("month", F.lit("09"))
    assert jobs.fact_for_period(cur, "2021", "9").count() == jobs.fact_for_period(cur, "2021", "09").count() == 1
    with pytest.raises(ValueError, match="2021-08"):
        jobs.run_fact_job(cur, scratch_path(spark, "t-none"), "2021", "8")


def test_repeated_inventory_ids_do_not_multiply_rows(spark):
    instances = spark.createDataFrame(
        [("a1", "i-1", "10.0.0.1", None), ("a2", "i-1", "10.0.0.2", None), ("a1", "i-1", None, None)],
        "account_id string, instance_id string, private_ip string, tags array<struct<Key:string,Value:string>>",
    )
    rows = spark.createDataFrame([("i-1",), ("i-1",), (None,), ("i-2",)], "resource_id string")
    found = enrich.with_instance_lookup(rows, instances, F.lit(True), {"ip": "private_ip"}).collect()
    assert sorted((str(r.resource_id), r.ip) for r in found) == [
        ("None", ""), ("i-1", "10.0.0.2"), ("i-1", "10.0.0.2"), ("i-2", ""),
    ]
    names = spark.createDataFrame([("x", "n1"), ("x", "n2")], "account_id string, account_name string")
    accounts = spark.createDataFrame([("p", "x")], "bill_payer_account_id string, line_item_usage_account_id string")
    assert [r.account_name for r in enrich.account_names(accounts, names).collect()] == ["n2"]


def test_append_new_keys_takes_a_repeated_key_once(spark):
    path = scratch_path(spark, "t-append")
    for rows in ([("a", 1), ("a", 2), ("b", 1)], [("a", 3), ("c", 1), ("c", 2)]):
        writers.append_new_keys(spark.createDataFrame(rows, "k string, v int"), path, "k")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 2), ("b", 1), ("c", 2)]


def test_merge_keys_keeps_stored_keys_and_unites_columns(spark):
    path = scratch_path(spark, "t-merge")
    writers.merge_keys(spark.createDataFrame([("a", "1"), ("b", "2")], "k string, x string"), path, "k", absent="")
    writers.merge_keys(spark.createDataFrame([("b", "3", "z")], "k string, x string, y string"), path, "k", absent="")
    got = {(r.k, r.x, r.y) for r in spark.read.parquet(path).collect()}
    assert got == {("a", "1", ""), ("b", "3", "z")}


def test_a_failed_load_leaves_the_old_rows(spark, monkeypatch):
    db = "t_failed_load"
    writers.ensure_database(spark, db, scratch_path(spark, db))
    spark.range(3).write.mode("overwrite").saveAsTable(f"{db}.t")
    bad = spark.range(5).select(F.when(F.col("id") < 9, F.raise_error(F.lit("stop"))).cast("long").alias("id"))
    for load in (writers.truncate_load, writers.swap_table):
        with pytest.raises(Exception, match="stop"):
            load(bad, f"{db}.t")
        assert spark.table(f"{db}.t").count() == 3
    writers.truncate_load(spark.table(f"{db}.t").where("id > 0"), f"{db}.t")  # reads itself
    assert sorted(r.id for r in spark.table(f"{db}.t").collect()) == [1, 2]
    writers.truncate_load(spark.range(7), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 7
    real = type(spark).sql

    def fails(self, text, *a, **k):
        if text.startswith("ALTER TABLE") and "__new_" in text:
            raise RuntimeError("between the steps")
        return real(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", fails)
    with pytest.raises(RuntimeError, match="between"):
        writers.swap_table(spark.range(9), f"{db}.t")
    monkeypatch.undo()
    assert spark.table(f"{db}.t").count() == 7
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_cross_account_rows_have_one_key_each(spark):
    source = spark.createDataFrame([("acct-1",), ("acct-2",)], "linked_account_id string")
    values = {c: "v" for c in dims.C.RESOURCE_DIM_COLUMNS}
    values |= {"line_item_operation": "RunInstances", "line_item_resource_id": "i-1"}
    values |= {"product_servicename": "Amazon Elastic Compute Cloud"}
    source = source.withColumns({c: F.lit(v) for c, v in values.items()})
    instances = spark.createDataFrame(
        [("acct-2", "i-1", "10.0.0.9", [("Name", "box")])],
        "account_id string, instance_id string, private_ip string, tags array<struct<Key:string,Value:string>>",
    )
    rows = dims.cross_account_resource_dim(source, ["acct-1", "acct-2"], instances).collect()
    assert [(r.secondary_identifier, r.resource_name) for r in rows] == [("10.0.0.9", "box")]
