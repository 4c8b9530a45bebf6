"""Inventory lookups as joins."""

import pytest

from costmart.operators import dims, enrich
from cur_rows import make_cur

INV_SCHEMA = "account_id string, instance_id string, private_ip string, tags array<struct<Key:string,Value:string>>"


@pytest.fixture(scope="module")
def instances(spark):
    return spark.createDataFrame(
        [
            ("acct-1", "i-1", "10.0.0.1", [("Name", "old"), ("env", "x"), ("Name", "web")]),
            ("acct-2", "i-2", None, [("team", "core")]),
            ("acct-2", "i-3", "10.0.0.3", None),
        ],
        INV_SCHEMA,
    )


@pytest.fixture(scope="module")
def resources(spark):
    ec2 = "Amazon Elastic Compute Cloud"
    rows = [
        {"product_sku": "a", "line_item_resource_id": "arn:aws:ec2:x:i-1", "line_item_usage_account_id": "acct-1"},
        {"product_sku": "b", "line_item_resource_id": "i-2", "line_item_usage_account_id": "acct-2"},
        {"product_sku": "c", "line_item_resource_id": "i-404", "line_item_usage_account_id": "acct-2"},
        {"product_sku": "d", "line_item_resource_id": None},
        {"product_sku": "e", "line_item_resource_id": "bucket", "product_servicename": "Amazon S3"},
        {"product_sku": "f", "line_item_resource_id": "i-3", "line_item_usage_account_id": "acct-1"},
        {"product_sku": "g", "line_item_resource_id": "i-1", "product_servicename": "Amazon S3"},
    ]
    for r in rows:
        r.setdefault("product_servicename", ec2)
    return make_cur(spark, rows)


def _by_rid(rows, col):
    return {r.line_item_resource_id: r[col] for r in rows}


def test_instance_ip_lookup(spark, resources, instances):
    from costmart.operators import summary

    s = summary.summary(resources, as_of="2021-10-15")
    rd = dims.resource_dim(s, instances, with_name=True).collect()
    ip = {(r.line_item_resource_id, r.product_servicename): r.secondary_identifier for r in rd}
    name = {(r.line_item_resource_id, r.product_servicename): r.resource_name for r in rd}
    ec2 = "Amazon Elastic Compute Cloud"
    assert ip[("arn:aws:ec2:x:i-1", ec2)] == "10.0.0.1"
    assert name[("arn:aws:ec2:x:i-1", ec2)] == "web"  # last Name wins
    assert ip[("i-2", ec2)] == "" and name[("i-2", ec2)] == ""  # NULL ip, no Name tag
    assert ip[("i-404", ec2)] == "" and name[("i-404", ec2)] == ""  # miss
    assert ip[(None, ec2)] is None  # no lookup
    assert ip[("bucket", "Amazon S3")] is None
    assert ip[("i-1", "Amazon S3")] is None  # not EC2
    assert ip[("i-3", ec2)] == "10.0.0.3" and name[("i-3", ec2)] == ""  # NULL tag list


def test_cross_account_lookup(spark, resources, instances):
    from costmart.operators import summary

    s = summary.summary(resources, as_of="2021-10-15")
    rd = dims.cross_account_resource_dim(s, ["acct-1", "acct-2"], instances).collect()
    ip = _by_rid(rd, "secondary_identifier")
    assert ip["arn:aws:ec2:x:i-1"] == "10.0.0.1"
    assert ip["i-3"] == ""  # i-3 belongs to acct-2, the row is acct-1
    assert "linked_account_id" not in rd[0].asDict()


def test_account_names(spark):
    ad = spark.createDataFrame([("p", "a1", "a1"), ("p", "a2", "a2")],
                               "bill_payer_account_id string, line_item_usage_account_id string, aws_account_dim_id string")
    acc = spark.createDataFrame([("a1", "Prod")], "account_id string, account_name string")
    got = {r.line_item_usage_account_id: r.account_name for r in enrich.account_names(ad, acc).collect()}
    assert got == {"a1": "Prod", "a2": ""}


def test_snapshot_then_instance(spark, instances):
    attrs = spark.createDataFrame(
        [("Amazon Elastic Compute Cloud", "snapshot/snap-1"), ("Amazon Elastic Compute Cloud", "i-1"),
         ("Amazon Elastic Compute Cloud", "snapshot/snap-9"), ("Amazon S3", "snapshot/snap-1")],
        "product_servicename string, resource_id string",
    )
    snaps = spark.createDataFrame([("snap-1", "2022-01-01")], "snapshot_id string, restore_expiry string")
    got = {(r.product_servicename, r.resource_id): r.secondary_identifier
           for r in enrich.secondary_identifier(attrs, instances, snaps).collect()}
    assert got[("Amazon Elastic Compute Cloud", "snapshot/snap-1")] == "2022-01-01"
    assert got[("Amazon Elastic Compute Cloud", "i-1")] == "10.0.0.1"
    assert got[("Amazon Elastic Compute Cloud", "snapshot/snap-9")] == ""
    assert got[("Amazon S3", "snapshot/snap-1")] is None


def test_volume_types(spark):
    df = spark.createDataFrame([("vol-1",), ("vol-2",), ("i-1",)], "resource_id string")
    vols = spark.createDataFrame([("vol-1", "gp3")], "volume_id string, volume_type string")
    got = {r.resource_id: r.volume_type for r in enrich.volume_types(df, vols).collect()}
    assert got == {"vol-1": "gp3", "vol-2": "", "i-1": None}


def test_lookup_is_one_pass_with_salted_keys(spark, resources, instances):
    from costmart.operators import summary

    df = dims.resource_dim(summary.line_items(resources, "2021-10-15"), instances)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan  # the input is read once
    assert "xxhash64" in plan  # rows without a lookup get a spread, non-matching key
    scans = df._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD")
    assert scans == 2  # the CUR rows once, the inventory once


def test_key_collisions_detected(spark):
    from costmart.functions import keys
    from costmart.operators import checks

    # ('a', NULL) and (NULL, 'a') share the key text 'a'
    df = spark.createDataFrame([("a", None), (None, "a"), ("b", "c")], "x string, y string")
    df = df.withColumn("k", keys.surrogate_key(["x", "y"]))
    (r,) = checks.key_tuple_stats(df, "k", ["x", "y"]).collect()
    assert (r.distinct_tuples, r.distinct_keys, r.colliding_keys) == (3, 2, 1)
    assert checks.key_collisions(df, "k", ["x", "y"]).count() == 1
