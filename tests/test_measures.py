"""Golden rows: one per arm of the measure CASEs and the labels."""

from decimal import Decimal as D

import pytest

from costmart.operators import fact, summary
from cur_rows import make_cur

# charge type, SP ARN, RI ARN, usage, unblended ->
#   usage_quantity, unblended, amortized, trueup, upfront_fees, public, purchase_option, charge_category
GOLDEN = [
    ("Usage", "", "", 2, 10, 2, 10, 10, 0, 0, 20, "OnDemand", "Running_Usage"),
    ("SavingsPlanCoveredUsage", "sp", "", 2, 10, 2, 10, 8, 0, 0, 20, "SavingsPlan", "Running_Usage"),
    ("SavingsPlanRecurringFee", "sp", "", 0, 10, 0, 10, 40, -5, 0, 20, "SavingsPlan", "non_usage"),
    ("SavingsPlanNegation", "sp", "", 0, -10, 0, -10, 0, 0, 0, 0, "SavingsPlan", "non_usage"),
    ("SavingsPlanUpfrontFee", "sp", "", 0, 10, 0, 10, 0, 0, 10, 20, "SavingsPlan", "non_usage"),
    ("DiscountedUsage", "", "ri", 2, 10, 2, 10, 7, 0, 0, 20, "Reserved", "Running_Usage"),
    ("RIFee", "", "ri", 0, 10, 0, 10, 7, -6, 0, 20, "Reserved", "non_usage"),
    ("Fee", "", "ri", 0, 10, 0, 10, 0, 0, 10, 20, "Reserved", "non_usage"),
    ("Fee", "", "", 0, 10, 0, 10, 10, 0, 0, 20, "OnDemand", "non_usage"),
    ("Tax", None, None, 0, 10, 0, 10, 10, 0, 0, 20, "OnDemand", "non_usage"),
]


@pytest.fixture(scope="module")
def golden_summary(spark):
    rows = [
        {
            "product_sku": f"sku-{i}",
            "line_item_line_item_type": t,
            "savings_plan_savings_plan_a_r_n": sp,
            "reservation_reservation_a_r_n": ri,
            "line_item_usage_amount": D(u),
            "line_item_unblended_cost": D(c),
        }
        for i, (t, sp, ri, u, c, *_rest) in enumerate(GOLDEN)
    ]
    cur = make_cur(spark, rows)
    return {r["product_sku"]: r for r in summary.summary(cur, as_of="2021-10-15").collect()}


@pytest.mark.parametrize("i", range(len(GOLDEN)))
def test_golden_row(golden_summary, i):
    _, _, _, _, _, uq, unbl, am, tu, up, pub, po, cc = GOLDEN[i]
    r = golden_summary[f"sku-{i}"]
    assert (r.usage_quantity, r.unblended_cost, r.amortized_cost, r.ri_sp_trueup, r.ri_sp_upfront_fees, r.public_cost) == (
        D(uq), D(unbl), D(am), D(tu), D(up), D(pub)
    )
    assert r.purchase_option == po
    assert r.charge_category == cc


def test_null_operand_makes_amortized_null(spark):
    cur = make_cur(spark, [{"line_item_line_item_type": "RIFee", "reservation_unused_recurring_fee": None}])
    (r,) = summary.summary(cur, as_of="2021-10-15").collect()
    assert r.amortized_cost is None
    (f,) = fact.fact_direct(cur, as_of="2021-10-15").collect()
    assert f.amortized_cost is None and f.unblended_cost == D(10)


def test_public_cost_null_type_is_zero(spark):
    cur = make_cur(spark, [{"line_item_line_item_type": None}])
    (r,) = summary.summary(cur, as_of="2021-10-15").collect()
    assert r.public_cost == D(0)
    assert r.charge_category == "non_usage"


def test_resource_id_count_is_zero_or_one(spark):
    cur = make_cur(spark, [{"line_item_resource_id": None}, {"line_item_resource_id": "i-9"}])
    got = sorted((r.line_item_resource_id or "", r.resource_id_count) for r in summary.summary(cur, as_of="2021-10-15").collect())
    assert got == [("", 0), ("i-9", 1)]


def test_rolling_window_bounds(spark):
    import datetime as dt

    rows = []
    for y, m in [(2021, 2), (2021, 3), (2021, 10)]:
        rows.append({"year": str(y), "month": str(m), "bill_billing_period_start_date": dt.datetime(y, m, 1),
                     "line_item_usage_start_date": dt.datetime(y, m, 2), "product_sku": f"{y}-{m}"})
    s = summary.summary(make_cur(spark, rows), as_of="2021-10-15")
    assert sorted(r.month for r in s.collect()) == ["10", "3"]
