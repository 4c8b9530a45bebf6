"""Hand-made CUR rows for unit tests: every required column with a default."""

import datetime as dt
from decimal import Decimal

from pyspark.sql.types import DecimalType, StringType, StructField, StructType, TimestampType

from costmart import columns as C

MONEY_COLUMNS = [
    C.USAGE_AMOUNT, C.UNBLENDED, C.SP_EFFECTIVE, C.SP_COMMITMENT, C.SP_USED, C.RI_EFFECTIVE,
    C.RI_UNUSED_UPFRONT, C.RI_UNUSED_RECURRING, C.SP_AMORTIZED_UPFRONT, C.RI_AMORTIZED_UPFRONT,
    C.PUBLIC_ON_DEMAND,
]
TS_COLUMNS = [C.BILLING_PERIOD_START, C.USAGE_START]
TAGS = ["resource_tags_user_env", "resource_tags_user_team"]


def schema(tags=TAGS):
    fields = []
    for c in C.REQUIRED_CUR_COLUMNS + list(tags):
        if c in MONEY_COLUMNS:
            t = DecimalType(18, 2)
        elif c in TS_COLUMNS:
            t = TimestampType()
        else:
            t = StringType()
        fields.append(StructField(c, t, True))
    return StructType(fields)


DEFAULTS = {
    C.YEAR: "2021", C.MONTH: "10",
    C.BILLING_PERIOD_START: dt.datetime(2021, 10, 1),
    C.USAGE_START: dt.datetime(2021, 10, 3, 6),
    C.PAYER: "payer-1", C.USAGE_ACCOUNT: "acct-1", C.INVOICE: "inv-1", C.SKU: "sku-1",
    C.ITEM_TYPE: "Usage", C.SP_ARN: "", C.RI_ARN: "", C.USAGE_TYPE: "EU-BoxUsage",
    C.PRODUCT_CODE: "AmazonEC2", C.PRODUCT_NAME: "Amazon Elastic Compute Cloud",
    C.SERVICE_NAME: "Amazon Elastic Compute Cloud", C.BILLING_ENTITY: "AWS", C.SERVICE_CODE: "AmazonEC2",
    C.PRODUCT_FAMILY: "Compute Instance", C.REGION: "eu-west-1", C.OPERATION: "RunInstances",
    C.DESCRIPTION: "m5.large Linux/UNIX Spot Instance", C.AVAILABILITY_ZONE: "eu-west-1a",
    C.INSTANCE_FAMILY: "m5", C.INSTANCE_TYPE: "m5.large", C.OPERATING_SYSTEM: "Linux",
    "product_tenancy": "Shared", "product_physical_processor": "Intel", "product_processor_features": "",
    "product_database_engine": "", "product_group": "", "product_from_location": "",
    "product_to_location": "", "product_current_generation": "Yes", "line_item_legal_entity": "Example Inc.",
    "pricing_unit": "Hrs", C.RESOURCE_ID: "i-1",
    C.USAGE_AMOUNT: Decimal("0"), C.UNBLENDED: Decimal("10"),
    # constants of the golden rows
    C.SP_EFFECTIVE: Decimal("8"), C.SP_COMMITMENT: Decimal("100"), C.SP_USED: Decimal("60"),
    C.RI_EFFECTIVE: Decimal("7"), C.RI_UNUSED_UPFRONT: Decimal("3"), C.RI_UNUSED_RECURRING: Decimal("4"),
    C.SP_AMORTIZED_UPFRONT: Decimal("5"), C.RI_AMORTIZED_UPFRONT: Decimal("6"),
    C.PUBLIC_ON_DEMAND: Decimal("20"),
    "resource_tags_user_env": "prod", "resource_tags_user_team": "core",
}


def make_cur(spark, rows, tags=TAGS):
    sch = schema(tags)
    data = []
    for r in rows:
        full = {**DEFAULTS, **r}
        data.append(tuple(full.get(f.name) for f in sch.fields))
    return spark.createDataFrame(data, sch)
