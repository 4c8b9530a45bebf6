"""Line-item classification as built-in column expressions.

All functions return ``Column`` objects over raw CUR column names, so they
stay inside whole-stage codegen. Comparisons keep SQL three-valued logic: a
NULL operand makes a ``when`` arm unknown and evaluation falls through to the
next arm, exactly like a SQL CASE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import columns as C
from .cache import per_session

# Item types that count as running usage.
USAGE_TYPES = ["DiscountedUsage", "SavingsPlanCoveredUsage", "Usage"]


@per_session
def charge_category(item_type: str = C.ITEM_TYPE) -> Column:
    t = F.col(item_type)
    return F.when(t.isin(*USAGE_TYPES), F.lit("Running_Usage")).otherwise(F.lit("non_usage"))


@per_session
def purchase_option() -> Column:
    """SavingsPlan > Reserved > Spot > OnDemand, first non-empty ARN wins."""
    return (
        F.when(F.col(C.SP_ARN) != "", F.lit("SavingsPlan"))
        .when(F.col(C.RI_ARN) != "", F.lit("Reserved"))
        .when(F.col(C.USAGE_TYPE).contains("Spot"), F.lit("Spot"))
        .otherwise(F.lit("OnDemand"))
    )


@per_session
def ri_sp_arn() -> Column:
    return (
        F.when(F.col(C.SP_ARN) != "", F.col(C.SP_ARN))
        .when(F.col(C.RI_ARN) != "", F.col(C.RI_ARN))
        .otherwise(F.lit(""))
    )


@per_session
def service(
    billing_entity: str = C.BILLING_ENTITY,
    item_type: str = C.ITEM_TYPE,
    product_name: str = C.PRODUCT_NAME,
    service_code: str = C.SERVICE_CODE,
    product_code: str = C.PRODUCT_CODE,
) -> Column:
    """Marketplace (non-discount) -> product name; empty service code ->
    product code; else the service code. Arguments are column names."""
    entity, t, name = F.col(billing_entity), F.col(item_type), F.col(product_name)
    code, pcode = F.col(service_code), F.col(product_code)
    return (
        F.when((entity == "AWS Marketplace") & ~t.contains("Discount"), name)
        .when(code == "", pcode)
        .otherwise(code)
    )


@per_session
def is_spot_ec2_usage() -> Column:
    return (
        F.col(C.USAGE_TYPE).contains("Spot")
        & (F.col(C.PRODUCT_CODE) == "AmazonEC2")
        & (F.col(C.ITEM_TYPE) == "Usage")
    )


def _part(s: Column, pattern: str, index: int) -> Column:
    """Field ``index`` (0-based) of ``s`` split on regex ``pattern``; NULL
    past the end (the split_part semantics of the source engine)."""
    return F.get(F.split(s, pattern), index)


@per_session
def spot_instance_family() -> Column:
    return F.when(is_spot_ec2_usage(), _part(F.col(C.DESCRIPTION), "[.]", 0)).otherwise(
        F.col(C.INSTANCE_FAMILY)
    )


@per_session
def spot_instance_type() -> Column:
    return F.when(is_spot_ec2_usage(), _part(F.col(C.DESCRIPTION), " ", 0)).otherwise(
        F.col(C.INSTANCE_TYPE)
    )


@per_session
def spot_platform() -> Column:
    return F.when(
        is_spot_ec2_usage(), _part(_part(F.col(C.DESCRIPTION), " ", 1), "/", 0)
    ).otherwise(F.col(C.OPERATING_SYSTEM))
