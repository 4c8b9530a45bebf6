"""The summary: CUR line items grouped to day x account x product x resource
x tags, with the classification labels and the six cost measures.

Plan shape (one shuffle): scan -> rolling-window filter (pushed to the scan)
-> partial HashAggregate -> Exchange on the group keys -> final HashAggregate
-> derived labels. Labels that are functions of other group keys (charge
category, service, product service name, normalized tags, resource count)
are computed after the aggregation, over groups instead of line items, and
are not shuffled.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from .. import rules as R
from ..functions import classify, dates, measures
from ..functions.cache import per_session

RAW_SERVICE_NAME = "__raw_servicename"
_RULE_CODE = "rule_product_code"
_RULE_NAME = "rule_service_name"

# summary name -> expression over raw CUR columns; grouped on as values.
@per_session
def _computed_keys() -> dict[str, Column]:
    return {
        "usage_date": F.date_trunc("day", F.col(C.USAGE_START)),
        "purchase_option": classify.purchase_option(),
        "ri_sp_arn": classify.ri_sp_arn(),
        "instance_type_family": classify.spot_instance_family(),
        "instance_type": classify.spot_instance_type(),
        "platform": classify.spot_platform(),
    }


# Summary columns that are a copy of a resource column (grouped once).
ALIASES_OF_RESOURCE = {
    "product_code": C.PRODUCT_CODE,
    "product_family": C.PRODUCT_FAMILY,
    "operation": C.OPERATION,
    "region": C.REGION,
}


def join_rules(df: DataFrame, rules: DataFrame, raw: str, broadcast_rules: bool = True) -> DataFrame:
    """``df`` left-joined with the rule table on the product code, for rows
    whose raw service name is the data-transfer name (adds the rule
    columns; a row without a rule gets NULLs)."""
    r = rules.select(F.col(_RULE_CODE), F.col(_RULE_NAME))
    if broadcast_rules:  # the built-in literal, of fixed length; a user's table is the optimizer's to plan
        r = F.broadcast(r)
    return df.join(
        r,
        (F.col(raw) == F.lit(R.DATA_TRANSFER)) & (F.col(C.PRODUCT_CODE) == F.col(_RULE_CODE)),
        "left",
    )


def service_name_from_rules(
    df: DataFrame,
    rules: DataFrame,
    raw: str = C.SERVICE_NAME,
    out: str = C.SERVICE_NAME,
    broadcast_rules: bool = True,
) -> DataFrame:
    """Derive the display service name.

    Data-transfer rows look their product code up in ``rules`` (left join;
    a code without a rule keeps the raw name, a rule may map to ''). Rows
    with an empty raw name follow the fixed arms in ``rules.py``. Needs
    columns ``raw``, product code, item type, billing entity, product name.
    """
    joined = join_rules(df, rules, raw, broadcast_rules)
    return joined.withColumn(out, service_name_arms(raw)).drop(_RULE_CODE, _RULE_NAME)


@per_session
def service_name_arms(
    raw: str,
    item_type: str = C.ITEM_TYPE,
    entity: str = C.BILLING_ENTITY,
    product_name: str = C.PRODUCT_NAME,
) -> Column:
    """The name over a frame joined by ``join_rules`` (column names given)."""
    chain = F.when(F.col(_RULE_CODE).isNotNull(), F.col(_RULE_NAME))
    return _fixed_arms(chain, F.col(raw), item_type, entity, product_name)


def _fixed_arms(chain: Column, raw: Column, item_type: str, entity: str, product_name: str) -> Column:
    """Append the non-lookup arms (empty raw name) and ELSE raw to ``chain``."""
    code = F.col(C.PRODUCT_CODE)
    for product_code, name in R.EMPTY_NAME_SERVICE_NAMES:
        chain = chain.when((raw == "") & (code == product_code), F.lit(name))
    chain = chain.when(
        (raw == "") & (code == R.EMPTY_NAME_FEE_CODE) & (F.col(item_type) == R.FEE),
        F.lit(R.EMPTY_NAME_FEE_CODE),
    )
    chain = chain.when(
        (raw == "") & (F.col(entity) == R.MARKETPLACE),
        F.concat(F.lit(R.MARKETPLACE_PREFIX), F.col(product_name)),
    )
    return chain.otherwise(raw)


@per_session
def service_name_case(
    raw_name: str = C.SERVICE_NAME,
    item_type: str = C.ITEM_TYPE,
    entity: str = C.BILLING_ENTITY,
    product_name: str = C.PRODUCT_NAME,
) -> Column:
    """Same derivation as one CASE chain with the rule list inlined as arms.
    Kept to compare plans with the lookup join; the join is the default."""
    raw = F.col(raw_name)
    code = F.col(C.PRODUCT_CODE)
    chain = None
    for product_code, name in R.DATA_TRANSFER_SERVICE_NAMES:
        cond = (raw == R.DATA_TRANSFER) & (code == product_code)
        chain = F.when(cond, F.lit(name)) if chain is None else chain.when(cond, F.lit(name))
    return _fixed_arms(chain, raw, item_type, entity, product_name)


def _check_strategy(strategy: str) -> None:
    if strategy not in ("join", "case"):
        raise ValueError(f"unknown service name strategy {strategy!r}")


def windowed(cur: DataFrame, as_of: _dt.date | str | None, months_back: int | None) -> DataFrame:
    """Rows of the rolling window; ``months_back=None`` keeps all rows."""
    if months_back is None:
        return cur
    return cur.where(dates.rolling_window(dates.as_date(as_of), months_back))


def named_rows(
    cur: DataFrame,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    rules: DataFrame | None = None,
    service_names: str = "join",
) -> tuple[DataFrame, Column]:
    """The window's line items (joined with the rule table for the "join"
    strategy) and the display-service-name expression over them; callers
    put the expression straight into their projection or grouping."""
    _check_strategy(service_names)
    rows = windowed(cur, as_of, months_back)
    if service_names == "case":
        return rows, service_name_case(C.SERVICE_NAME)
    user_rules = rules is not None
    table = rules if user_rules else R.rules_frame(cur.sparkSession)
    return join_rules(rows, table, C.SERVICE_NAME, broadcast_rules=not user_rules), service_name_arms(C.SERVICE_NAME)


def line_items(
    cur: DataFrame,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    rules: DataFrame | None = None,
    service_names: str = "join",
) -> DataFrame:
    """The line items of the window with the display service name derived
    per row (a broadcast lookup pipelined into the scan stage). Distinct
    tag or resource tuples of these rows are those of the summary, so the
    dimensions can be cut from them with one aggregation instead of two."""
    rows, service_name = named_rows(cur, as_of, months_back, rules, service_names)
    return rows.withColumn(C.SERVICE_NAME, service_name).drop(_RULE_CODE, _RULE_NAME)


def summary(
    cur: DataFrame,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    rules: DataFrame | None = None,
    tag_prefix: str = C.TAG_PREFIX,
    service_names: str = "join",
) -> DataFrame:
    """The summary view over ``cur`` for the window ending at ``as_of``.

    ``service_names``: "join" looks the data-transfer rules up with a
    broadcast join (default); "case" inlines them as one CASE chain.

    Groups are formed on raw values: rows whose raw service name or raw tag
    differ (e.g. NULL vs '') stay separate rows even when their derived
    output values are equal.
    """
    C.require_columns(cur, C.REQUIRED_CUR_COLUMNS)
    tags = C.tag_columns(cur, tag_prefix)

    computed = _computed_keys()
    renamed = [(raw, name) for raw, name in C.RENAMED_KEYS if name not in ALIASES_OF_RESOURCE]
    keys = (
        [F.col(raw).alias(name) for raw, name in renamed]
        + [expr.alias(name) for name, expr in computed.items()]
        + [F.col(C.SERVICE_NAME).alias(RAW_SERVICE_NAME)]
        + [F.col(t) for t in tags]
        + [F.col(c) for c in C.RESOURCE_COLUMNS]
    )
    grouped = windowed(cur, as_of, months_back).groupBy(*keys).agg(*measures.measure_aggs())

    # Labels over the grouped rows, reading the summary's column names.
    names = ("charge_type", "billing_entity", "product_name")
    _check_strategy(service_names)
    if service_names == "case":
        labelled, service_name = grouped, service_name_case(RAW_SERVICE_NAME, *names)
    else:
        user_rules = rules is not None
        table = rules if user_rules else R.rules_frame(cur.sparkSession)
        labelled = join_rules(grouped, table, RAW_SERVICE_NAME, broadcast_rules=not user_rules)
        service_name = service_name_arms(RAW_SERVICE_NAME, *names)
    key_exprs = {name: F.col(name) for _, name in renamed}
    key_exprs.update({name: F.col(name) for name in computed})
    key_exprs.update({name: F.col(raw) for name, raw in ALIASES_OF_RESOURCE.items()})
    key_exprs["charge_category"] = classify.charge_category("charge_type")
    key_exprs["service"] = classify.service("billing_entity", "charge_type", "product_name")
    return labelled.select(
        *[key_exprs[name].alias(name) for name in SUMMARY_KEY_ORDER],
        # approx_distinct over a column that is itself a group key is exactly
        # 0 (NULL id) or 1, so no sketch is kept per group.
        F.when(F.col(C.RESOURCE_ID).isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("resource_id_count"),
        *C.MEASURES,
        service_name.alias(C.SERVICE_NAME),
        *[F.coalesce(F.col(t), F.lit("")).alias(t) for t in tags],
        *C.RESOURCE_COLUMNS,
    )


SUMMARY_KEY_ORDER = [
    "year", "month", "billing_period", "usage_date", "payer_account_id", "linked_account_id",
    "invoice_id", "product_sku", "charge_type", "charge_category", "purchase_option", "ri_sp_arn",
    "product_code", "product_name", "service", "product_family", "usage_type", "operation",
    "item_description", "availability_zone", "region", "instance_type_family", "instance_type",
    "platform", "tenancy", "processor", "processor_features", "database_engine", "product_group",
    "product_from_location", "product_to_location", "current_generation", "legal_entity",
    "billing_entity", "pricing_unit",
]
