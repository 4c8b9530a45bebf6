"""Service-name derivation: lookup join and CASE chain agree on every rule,
on unmapped codes and on the fixed arms."""

import pytest

from costmart import rules as R
from costmart.operators import summary
from cur_rows import make_cur


@pytest.fixture(scope="module")
def cases(spark):
    rows = []
    for i, (code, _) in enumerate(R.DATA_TRANSFER_SERVICE_NAMES):
        rows.append({"product_sku": f"dt-{i}", "product_servicename": R.DATA_TRANSFER, "line_item_product_code": code})
    rows += [
        {"product_sku": "unmapped", "product_servicename": R.DATA_TRANSFER, "line_item_product_code": "UnmappedCode"},
        {"product_sku": "e-ec2", "product_servicename": "", "line_item_product_code": "AmazonEC2"},
        {"product_sku": "e-rds", "product_servicename": "", "line_item_product_code": "AmazonRDS"},
        {"product_sku": "e-fee", "product_servicename": "", "line_item_product_code": "OCBElasticComputeCloud",
         "line_item_line_item_type": "Fee"},
        {"product_sku": "e-nofee", "product_servicename": "", "line_item_product_code": "OCBElasticComputeCloud"},
        {"product_sku": "mkt", "product_servicename": "", "line_item_product_code": "prodX",
         "bill_billing_entity": "AWS Marketplace", "product_product_name": "Widget"},
        {"product_sku": "mkt-null", "product_servicename": "", "line_item_product_code": "prodY",
         "bill_billing_entity": "AWS Marketplace", "product_product_name": None},
        {"product_sku": "plain", "product_servicename": "Amazon S3", "line_item_product_code": "AmazonS3"},
        {"product_sku": "null", "product_servicename": None, "line_item_product_code": "AmazonS3"},
    ]
    return make_cur(spark, rows)


def _names(df):
    return {r.product_sku: r.product_servicename for r in df.select("product_sku", "product_servicename").collect()}


def test_join_equals_case(cases):
    join = _names(summary.summary(cases, as_of="2021-10-15", service_names="join"))
    case = _names(summary.summary(cases, as_of="2021-10-15", service_names="case"))
    assert join == case


def test_expected_names(cases):
    got = _names(summary.summary(cases, as_of="2021-10-15"))
    for i, (_, name) in enumerate(R.DATA_TRANSFER_SERVICE_NAMES):
        assert got[f"dt-{i}"] == name
    assert sum(1 for _, n in R.DATA_TRANSFER_SERVICE_NAMES if n == "") == 9
    assert got["unmapped"] == R.DATA_TRANSFER
    assert got["e-ec2"] == "Amazon Elastic Compute Cloud"
    assert got["e-rds"] == "Amazon Relational Database Service"
    assert got["e-fee"] == "OCBElasticComputeCloud"
    assert got["e-nofee"] == ""
    assert got["mkt"] == "AWS Marketplace Widget"
    assert got["mkt-null"] is None
    assert got["plain"] == "Amazon S3"
    assert got["null"] is None


def test_user_rules_table_is_size_checked(spark, cases):
    user = spark.createDataFrame([("UnmappedCode", "Mapped by user")], "rule_product_code string, rule_service_name string")
    got = _names(summary.summary(cases, as_of="2021-10-15", rules=user))
    assert got["unmapped"] == "Mapped by user"
    assert got["dt-0"] == R.DATA_TRANSFER  # not in the user table


def test_rules_are_unique():
    codes = [c for c, _ in R.DATA_TRANSFER_SERVICE_NAMES]
    assert len(codes) == len(set(codes)) == 89


def test_no_python_udf_in_plan(cases):
    plan = summary.summary(cases, as_of="2021-10-15")._jdf.queryExecution().executedPlan().toString()
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert marker not in plan
    assert "BroadcastHashJoin" in plan


def test_service_name_from_rules_on_line_items(spark, cases):
    from costmart import rules as R

    named = summary.service_name_from_rules(cases, R.rules_frame(spark))
    per_item = {r.product_sku: r.product_servicename for r in named.select("product_sku", "product_servicename").collect()}
    assert per_item == _names(summary.summary(cases, as_of="2021-10-15"))
    assert "rule_product_code" not in named.columns
