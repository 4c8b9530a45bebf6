"""Column names of the raw cost-and-usage report (CUR) and of the mart tables.

Everything that names a column lives here so that the operators, the
fixtures and the SQL oracle agree on one spelling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

TAG_PREFIX = "resource_tags_user_"

# Raw CUR columns read by the summary (fixed names; tags are discovered).
YEAR = "year"
MONTH = "month"
BILLING_PERIOD_START = "bill_billing_period_start_date"
USAGE_START = "line_item_usage_start_date"
PAYER = "bill_payer_account_id"
USAGE_ACCOUNT = "line_item_usage_account_id"
INVOICE = "bill_invoice_id"
SKU = "product_sku"
ITEM_TYPE = "line_item_line_item_type"
SP_ARN = "savings_plan_savings_plan_a_r_n"
RI_ARN = "reservation_reservation_a_r_n"
USAGE_TYPE = "line_item_usage_type"
PRODUCT_CODE = "line_item_product_code"
PRODUCT_NAME = "product_product_name"
SERVICE_NAME = "product_servicename"
BILLING_ENTITY = "bill_billing_entity"
SERVICE_CODE = "product_servicecode"
PRODUCT_FAMILY = "product_product_family"
REGION = "product_region"
OPERATION = "line_item_operation"
DESCRIPTION = "line_item_line_item_description"
AVAILABILITY_ZONE = "line_item_availability_zone"
INSTANCE_FAMILY = "product_instance_type_family"
INSTANCE_TYPE = "product_instance_type"
OPERATING_SYSTEM = "product_operating_system"
RESOURCE_ID = "line_item_resource_id"

USAGE_AMOUNT = "line_item_usage_amount"
UNBLENDED = "line_item_unblended_cost"
SP_EFFECTIVE = "savings_plan_savings_plan_effective_cost"
SP_COMMITMENT = "savings_plan_total_commitment_to_date"
SP_USED = "savings_plan_used_commitment"
RI_EFFECTIVE = "reservation_effective_cost"
RI_UNUSED_UPFRONT = "reservation_unused_amortized_upfront_fee_for_billing_period"
RI_UNUSED_RECURRING = "reservation_unused_recurring_fee"
SP_AMORTIZED_UPFRONT = "savings_plan_amortized_upfront_commitment_for_billing_period"
RI_AMORTIZED_UPFRONT = "reservation_amortized_upfront_fee_for_billing_period"
PUBLIC_ON_DEMAND = "pricing_public_on_demand_cost"

# Raw columns copied into the summary under a business name, in summary order.
# (raw column, summary name); the computed keys are handled in summary.py.
RENAMED_KEYS = [
    (YEAR, "year"),
    (MONTH, "month"),
    (BILLING_PERIOD_START, "billing_period"),
    (PAYER, "payer_account_id"),
    (USAGE_ACCOUNT, "linked_account_id"),
    (INVOICE, "invoice_id"),
    (SKU, "product_sku"),
    (ITEM_TYPE, "charge_type"),
    (PRODUCT_CODE, "product_code"),
    (PRODUCT_NAME, "product_name"),
    (PRODUCT_FAMILY, "product_family"),
    (USAGE_TYPE, "usage_type"),
    (OPERATION, "operation"),
    (DESCRIPTION, "item_description"),
    (AVAILABILITY_ZONE, "availability_zone"),
    (REGION, "region"),
    ("product_tenancy", "tenancy"),
    ("product_physical_processor", "processor"),
    ("product_processor_features", "processor_features"),
    ("product_database_engine", "database_engine"),
    ("product_group", "product_group"),
    ("product_from_location", "product_from_location"),
    ("product_to_location", "product_to_location"),
    ("product_current_generation", "current_generation"),
    ("line_item_legal_entity", "legal_entity"),
    (BILLING_ENTITY, "billing_entity"),
    ("pricing_unit", "pricing_unit"),
]

# Resource attributes carried through the summary under their raw names
# (sorted, as the hash input order depends on it).
RESOURCE_COLUMNS = sorted(
    [RESOURCE_ID, OPERATION, PRODUCT_CODE, PRODUCT_FAMILY, REGION, SERVICE_CODE]
)
# The resource dimension adds the derived service name.
RESOURCE_DIM_COLUMNS = sorted(RESOURCE_COLUMNS + [SERVICE_NAME])

MEASURES = [
    "usage_quantity",
    "unblended_cost",
    "amortized_cost",
    "ri_sp_trueup",
    "ri_sp_upfront_fees",
    "public_cost",
]
FACT_MEASURES = [
    "amortized_cost",
    "unblended_cost",
    "ri_sp_trueup",
    "ri_sp_upfront_fees",
    "public_cost",
]

REQUIRED_CUR_COLUMNS = sorted(
    {raw for raw, _ in RENAMED_KEYS}
    | set(RESOURCE_COLUMNS)
    | {
        USAGE_START,
        SP_ARN,
        RI_ARN,
        SERVICE_NAME,
        INSTANCE_FAMILY,
        INSTANCE_TYPE,
        OPERATING_SYSTEM,
        USAGE_AMOUNT,
        UNBLENDED,
        SP_EFFECTIVE,
        SP_COMMITMENT,
        SP_USED,
        RI_EFFECTIVE,
        RI_UNUSED_UPFRONT,
        RI_UNUSED_RECURRING,
        SP_AMORTIZED_UPFRONT,
        RI_AMORTIZED_UPFRONT,
        PUBLIC_ON_DEMAND,
    }
)


def tag_columns(df: DataFrame, prefix: str = TAG_PREFIX) -> list[str]:
    """User tag columns of ``df``: names starting with ``prefix``, sorted.

    Sorting is by code point, which is also the order the key text is built in.
    """
    return sorted(c for c in df.columns if c.startswith(prefix))


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"input lacks required columns: {missing}")
