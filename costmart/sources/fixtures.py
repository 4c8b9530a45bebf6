"""CUR-shaped inputs derived from the TPC-H-like test tables.

The column expressions are plain SQL text valid in both Spark SQL and
DuckDB (with a DuckDB variant where the dialects differ), so the Spark
pipeline and the DuckDB oracle read the same line items. These build test
inputs; they are not part of the pipeline.

Scale: the CUR is lineitem joined to orders, customer, nation and part
(equi-joins; the optimizer picks sort-merge or broadcast from measured
sizes) and expanded four-fold with a generator (explode of a 4-element
array, no cross join). Rows that are to be written by
month are dealt to it as line items, before the expansion (``by_month``). Filters on the CUR (the rolling window) are pushed
by Catalyst below the generator and the joins to the lineitem scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import DATA_TRANSFER_SERVICE_NAMES
from . import deliveries

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Fixed "as of" date for the test data (l_shipdate runs to 2001-11-04).
AS_OF = "2001-11-15"
HOURS_PER_DAY = 4
# line items of a delivery that are joined and dealt by month at once
DEALT_ITEMS = 80_000_000

_T = "(l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 12"
# data-transfer rows (every fourth line) run through all mapped product codes and some unmapped ones
_CODES = [code for code, _ in DATA_TRANSFER_SERVICE_NAMES]
_RULE_CODES = (
    f"case (l_orderkey + l_partkey) % {len(_CODES) + 4} "
    + " ".join(f"when {i} then '{code}'" for i, code in enumerate(_CODES))
    + " else 'UnmappedCode' end"
)

# (column, Spark SQL expression, DuckDB expression or None when identical)
CUR_EXPRESSIONS: list[tuple[str, str, str | None]] = [
    ("year", "cast(year(l_shipdate) as varchar(20))", None),
    ("month", "cast(month(l_shipdate) as varchar(20))", None),
    ("bill_billing_period_start_date", "date_trunc('month', cast(l_shipdate as timestamp))", "date_trunc('month', l_shipdate)"),
    ("line_item_usage_start_date", "cast(l_shipdate as timestamp) + h * interval '6' hour", "l_shipdate + h * interval '6' hour"),
    ("bill_payer_account_id", "concat('payer-', cast(c_nationkey % 3 as varchar(20)))", None),
    ("line_item_usage_account_id", "concat('acct-', cast(c_nationkey as varchar(20)))", None),
    ("bill_invoice_id", "concat('inv-', cast(l_suppkey % 6 as varchar(20)))", None),
    ("product_sku", "concat('sku-', cast(p_size as varchar(20)))", None),
    ("line_item_line_item_type",
     f"case {_T} when 0 then 'DiscountedUsage' when 1 then 'SavingsPlanCoveredUsage' "
     "when 2 then 'SavingsPlanRecurringFee' when 3 then 'SavingsPlanNegation' "
     "when 4 then 'SavingsPlanUpfrontFee' when 5 then 'RIFee' when 6 then 'Fee' "
     "when 7 then 'Tax' when 8 then 'BundledDiscount' else 'Usage' end", None),
    ("savings_plan_savings_plan_a_r_n",
     f"case when {_T} in (1,2,3,4) then concat('sp-', cast(l_suppkey % 5 as varchar(20))) "
     f"when {_T} = 11 then null else '' end", None),
    ("reservation_reservation_a_r_n",
     f"case when {_T} in (0,5) or ({_T} = 6 and l_returnflag = 'A') "
     "then concat('ri-', cast(l_suppkey % 4 as varchar(20))) else '' end", None),
    ("line_item_usage_type", "case when l_returnflag = 'R' then 'EU-SpotUsage' else 'EU-BoxUsage' end", None),
    ("line_item_product_code",
     f"case when l_linenumber % 4 = 0 then {_RULE_CODES} else "
     "case p_size % 9 when 0 then 'AmazonS3' when 1 then 'AmazonRDS' when 2 then 'AWSGlue' "
     "when 3 then 'AmazonGlacier' when 4 then 'OCBElasticComputeCloud' when 5 then 'UnmappedCode' "
     "when 6 then 'AmazonRedshift' else 'AmazonEC2' end end", None),
    ("product_product_name", "case when l_partkey % 17 = 0 then null else p_name end", None),
    ("product_servicename",
     "case l_linenumber % 4 when 0 then 'AWS Data Transfer' when 1 then '' "
     "when 2 then 'Amazon Elastic Compute Cloud' else p_type end", None),
    ("bill_billing_entity",
     "case when l_linestatus = 'F' and l_suppkey % 7 = 0 then 'AWS Marketplace' else 'AWS' end", None),
    ("product_servicecode", "case when p_size % 5 = 0 then '' else p_brand end", None),
    ("product_product_family", "p_type", None),
    ("product_region", "n_name", None),
    ("line_item_operation",
     "case l_linenumber % 3 when 0 then 'RunInstances' when 1 then 'PutObject' else 'CreateDBInstance' end", None),
    ("line_item_line_item_description",
     "case when l_partkey % 13 = 0 then 'nospace' else concat(case when l_partkey % 2 = 0 "
     "then 'm5.large' else 'r4.xlarge' end, ' Linux/UNIX Spot Instance ', cast(h % 2 as varchar(20))) end", None),
    ("line_item_availability_zone", "concat(n_name, 'a')", None),
    ("product_instance_type_family", "p_brand", None),
    ("product_instance_type", "p_name", None),
    ("product_operating_system", "'Linux'", None),
    ("product_tenancy", "'Shared'", None),
    ("product_physical_processor", "p_type", None),
    ("product_processor_features", "''", None),
    ("product_database_engine", "case when p_size % 9 = 1 then 'MySQL' else '' end", None),
    ("product_group", "p_brand", None),
    ("product_from_location", "n_name", None),
    ("product_to_location", "n_name", None),
    ("product_current_generation", "case when p_size % 2 = 0 then 'Yes' else 'No' end", None),
    ("line_item_legal_entity", "'Example Inc.'", None),
    ("pricing_unit", "'Hrs'", None),
    ("line_item_resource_id",
     "case when l_partkey % 10 = 0 then null "
     "when l_partkey % 10 = 5 then concat('arn:aws:ec2:x:snapshot/snap-', cast(l_partkey as varchar(20))) "
     "when l_partkey % 10 = 7 then concat('vol-', cast(l_partkey as varchar(20))) "
     "when l_partkey % 2 = 0 then concat('arn:aws:ec2:x:instance/i-', cast(l_partkey as varchar(20))) "
     "when l_partkey % 3 = 0 then concat('arn:aws:ec2:x:i-', cast(l_partkey as varchar(20))) "
     "else concat('i-', cast(l_partkey as varchar(20))) end", None),
    ("line_item_usage_amount", "cast(l_quantity as decimal(18,2))", None),
    ("line_item_unblended_cost", "cast(l_extendedprice as decimal(18,2))", None),
    ("savings_plan_savings_plan_effective_cost",
     "cast(cast(l_extendedprice as decimal(18,2)) - cast(l_quantity as decimal(18,2)) as decimal(18,2))", None),
    ("savings_plan_total_commitment_to_date", "cast(o_totalprice as decimal(18,2))", None),
    ("savings_plan_used_commitment", "cast(l_quantity as decimal(18,2))", None),
    ("reservation_effective_cost", "cast(p_retailprice as decimal(18,2))", None),
    ("reservation_unused_amortized_upfront_fee_for_billing_period", "cast(l_quantity as decimal(18,2))", None),
    ("reservation_unused_recurring_fee",
     "case when l_linenumber = 7 then null else cast(p_retailprice as decimal(18,2)) end", None),
    ("savings_plan_amortized_upfront_commitment_for_billing_period", "cast(p_retailprice as decimal(18,2))", None),
    ("reservation_amortized_upfront_fee_for_billing_period", "cast(l_quantity as decimal(18,2))", None),
    ("pricing_public_on_demand_cost", "cast(o_totalprice as decimal(18,2))", None),
    ("resource_tags_user_env", "case l_suppkey % 4 when 0 then null when 1 then '' else c_mktsegment end", None),
    ("resource_tags_user_team", "case when l_suppkey % 3 = 0 then null else o_orderpriority end", None),
]

_HOUR = re.compile(r"\bh\b")
_TEXT = re.compile(r"'([^'\\]*)'")
_INPUT_COLUMN = re.compile(r"\b[lopcn]_[a-z]+\b")

_AMOUNTS = ("l_quantity", "l_extendedprice", "o_totalprice", "p_retailprice")

CUR_JOIN_SQL = (
    "lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey "
    "JOIN part ON l_partkey = p_partkey "
    "CROSS JOIN (VALUES (0),(1),(2),(3)) hrs(h)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _amounts(df: DataFrame) -> DataFrame:
    """Amounts as the decimals that every expression takes them as: once a table row."""
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in _AMOUNTS if c in df.columns})


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items with their order, customer, nation and part."""
    li = _amounts(table(spark, sf_dir, "lineitem"))
    orders = _amounts(table(spark, sf_dir, "orders"))
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    part = _amounts(table(spark, sf_dir, "part"))
    # The orders meet customer and nation before the line items do, which are so
    # shuffled once a table that is too large to broadcast, not once more for customer.
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(li, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )


def _dealt_by_month(joined: DataFrame) -> DataFrame:
    """The columns of ``joined`` that the CUR is made of, with year and month, dealt by them."""
    months = {n: F.expr(e) for n, e, _ in CUR_EXPRESSIONS if n in _MONTH}
    used = sorted({c for _, e, _ in CUR_EXPRESSIONS for c in _INPUT_COLUMN.findall(e)})
    return joined.select(*used, *[e.alias(n) for n, e in months.items()]).hint("rebalance", *months)


# Columns that do not depend on the hour are computed once per line item, the two that do four times.
_MONTH = ("year", "month")
_PER_HOUR = [(n, e) for n, e, _ in CUR_EXPRESSIONS if _HOUR.search(e)]
_PER_ITEM = [(n, e) for n, e, _ in CUR_EXPRESSIONS if not _HOUR.search(e)]


def cur_from_tables(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """The raw CUR (47 fixed columns + 2 tag columns), 4 rows per lineitem.

    ``by_month``: the line items are dealt by month before they are expanded, a
    quarter of the rows and half of the columns; a write by month then needs no
    shuffle of its own."""
    joined = _joined(spark, sf_dir)
    if by_month:
        joined = _dealt_by_month(joined)
    carried = sorted({c for _, e in _PER_HOUR for c in _INPUT_COLUMN.findall(e)})
    items = joined.selectExpr(*[n if by_month and n in _MONTH else f"{e} AS {n}" for n, e in _PER_ITEM], *carried)
    hours = items.withColumn("h", F.explode(F.array(*[F.lit(i) for i in range(HOURS_PER_DAY)])))
    out = hours.selectExpr(*[n for n, _ in _PER_ITEM], *[f"{e} AS {n}" for n, e in _PER_HOUR])
    return out.select(*[name for name, _, _ in CUR_EXPRESSIONS])


def cur_items(spark: SparkSession, sf_dir: str, only: str = "true", hour: str = "true") -> DataFrame:
    """The raw CUR dealt by month, one row a line item: its four rows' own columns
    are the structs of the array ``hours`` (see ``deliveries``). ``only`` is a
    condition on the line items, ``hour`` one on the usage start of each row."""
    dealt = _dealt_by_month(_joined(spark, sf_dir).where(only))
    own = ", ".join(f"'{n}', {e}" for n, e in _PER_HOUR)
    start = dict(_PER_HOUR)["line_item_usage_start_date"]
    row = f"case when {hour.replace('line_item_usage_start_date', f'({start})')} then named_struct({own}) end"
    shared = [F.col(n) if n in _MONTH else F.expr(e).alias(n, metadata=_mark(e)) for n, e in _PER_ITEM]
    hours = ", ".join(_HOUR.sub(str(h), row) for h in range(HOURS_PER_DAY))
    return dealt.select(*shared, F.expr(f"array({hours})").alias(deliveries.HOURS))


def cur_item_groups(spark: SparkSession, sf_dir: str, only: str = "true", hour: str = "true") -> list[DataFrame]:
    """``cur_items`` as frames of consecutive months, each of up to ``DEALT_ITEMS`` line
    items (or one month): what their joins and their dealing shuffle lies on the disk one
    frame after the other (see ``deliveries.append``), whatever the length of the history."""
    month = [f(F.col("l_shipdate")).alias(n) for f, n in ((F.year, "y"), (F.month, "m"))]
    # a row a month: bounded by the calendar; items without a month come first
    counts = table(spark, sf_dir, "lineitem").where(only).groupBy(*month).count().orderBy("y", "m").collect()
    starts, held = [], 0
    for y, m, n in counts:
        if held and y is not None and held + n > DEALT_ITEMS:
            starts.append(f"make_date({y}, {m}, 1)")
            held = 0
        held += n
    if not starts:
        return [cur_items(spark, sf_dir, only, hour)]
    parts = [f"l_shipdate IS NULL OR l_shipdate < {starts[0]}"]
    parts += [f"l_shipdate >= {a} AND l_shipdate < {b}" for a, b in zip(starts, starts[1:])]
    parts += [f"l_shipdate >= {starts[-1]}"]
    return [cur_items(spark, sf_dir, f"({only}) AND ({part})", hour) for part in parts]


def _mark(expression: str) -> dict[str, str]:
    """What tells a delivery that columns are the same expression, or one text."""
    text = _TEXT.fullmatch(expression)
    return {deliveries.VALUE: text[1]} if text else {deliveries.SAME: expression}


def cur_sql() -> str:
    """DuckDB SELECT producing the same CUR rows (for the oracle)."""
    cols = ",\n  ".join(f"{duck or spark} AS {name}" for name, spark, duck in CUR_EXPRESSIONS)
    return f"SELECT\n  {cols}\nFROM {CUR_JOIN_SQL}"


# Instance inventory: one instance per part, every part. Parts with
# partkey % 4 = 3 carry a retired id that no line item references (lookup
# miss). Tags: NULL list, other key only, one Name, or two Names (the last
# one wins).
INSTANCE_EXPRESSIONS: list[tuple[str, str, str | None]] = [
    ("account_id", "concat('acct-', cast(p_partkey % 5 as varchar(20)))", None),
    ("instance_id",
     "case when p_partkey % 4 = 3 then concat('i-retired-', cast(p_partkey as varchar(20))) "
     "else concat('i-', cast(p_partkey as varchar(20))) end", None),
    ("private_ip",
     "case when p_partkey % 20 = 1 then null else concat('10.', cast(p_partkey % 256 as varchar(20)), '.', "
     "cast(p_size as varchar(20)), '.', cast(p_partkey % 7 as varchar(20))) end", None),
    ("tags",
     "case when p_partkey % 8 = 0 then null "
     "when p_partkey % 4 = 0 then array(named_struct('Key', 'team', 'Value', p_brand)) "
     "when p_partkey % 4 = 1 then array(named_struct('Key', 'Name', 'Value', p_name)) "
     "else array(named_struct('Key', 'Name', 'Value', concat('old-', p_name)), "
     "named_struct('Key', 'env', 'Value', p_type), named_struct('Key', 'Name', 'Value', p_brand)) end",
     "case when p_partkey % 8 = 0 then null "
     "when p_partkey % 4 = 0 then [{'Key': 'team', 'Value': p_brand}] "
     "when p_partkey % 4 = 1 then [{'Key': 'Name', 'Value': p_name}] "
     "else [{'Key': 'Name', 'Value': concat('old-', p_name)}, "
     "{'Key': 'env', 'Value': p_type}, {'Key': 'Name', 'Value': p_brand}] end"),
]


def instances_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.selectExpr(*[f"{expr} AS {name}" for name, expr, _ in INSTANCE_EXPRESSIONS])


def instances_sql() -> str:
    cols = ", ".join(f"{duck or spark} AS {name}" for name, spark, duck in INSTANCE_EXPRESSIONS)
    return f"SELECT {cols} FROM part"


# Addresses over time: each instance moves once, on a day of its own, and takes
# the address that a neighbouring instance had before; parts with
# partkey % 6 = 5 have a gap of three weeks, those with partkey % 9 = 4 end.
_MOVED = "cast('2001-05-01' as date) + cast(p_partkey % 150 as int)"
INSTANCE_HISTORY = [
    (
        "concat('i-', cast(p_partkey as varchar(20)))",
        "concat('10.0.', cast(p_partkey % 199 as varchar(20)), '.1')",
        "cast('1998-01-01' as date)",
        f"case when p_partkey % 6 = 5 then {_MOVED} - 21 else {_MOVED} end",
    ),
    (
        "concat('i-', cast(p_partkey as varchar(20)))",
        "concat('10.0.', cast((p_partkey + 1) % 199 as varchar(20)), '.1')",
        _MOVED,
        "case when p_partkey % 9 = 4 then cast('2001-10-20' as date) end",
    ),
]
_HISTORY_COLUMNS = ("instance_id", "private_ip", "valid_from", "valid_to")


def instance_history_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(instance_id, private_ip, valid_from, valid_to): two rows a part."""
    part = table(spark, sf_dir, "part")
    parts = [part.selectExpr(*[f"{e} AS {n}" for n, e in zip(_HISTORY_COLUMNS, row)]) for row in INSTANCE_HISTORY]
    return parts[0].union(parts[1])


def instance_history_sql() -> str:
    rows = [", ".join(f"{e} AS {n}" for n, e in zip(_HISTORY_COLUMNS, row)) for row in INSTANCE_HISTORY]
    return " UNION ALL ".join(f"SELECT {r} FROM part" for r in rows)


# Snapshot and volume inventories: one row per part, every part; ids of
# parts with partkey % 3 = 0 are of deleted resources that no line item
# references (lookup miss). Line items reference snapshots of parts with
# partkey % 10 = 5 and volumes of parts with partkey % 10 = 7.
SNAPSHOT_EXPRESSIONS = [
    ("snapshot_id",
     "case when p_partkey % 3 = 0 then concat('snap-deleted-', cast(p_partkey as varchar(20))) "
     "else concat('snap-', cast(p_partkey as varchar(20))) end"),
    ("restore_expiry", "concat('2002-', cast(p_size % 12 + 10 as varchar(20)), '-01T00:00:00Z')"),
]
VOLUME_EXPRESSIONS = [
    ("volume_id",
     "case when p_partkey % 3 = 0 then concat('vol-deleted-', cast(p_partkey as varchar(20))) "
     "else concat('vol-', cast(p_partkey as varchar(20))) end"),
    ("volume_type", "case p_size % 3 when 0 then 'gp3' when 1 then 'io2' else 'st1' end"),
]


def _inventory(spark: SparkSession, sf_dir: str, exprs) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(*[f"{e} AS {n}" for n, e in exprs])


def _inventory_sql(exprs) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in exprs)} FROM part"


def snapshots_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inventory(spark, sf_dir, SNAPSHOT_EXPRESSIONS)


def snapshots_sql() -> str:
    return _inventory_sql(SNAPSHOT_EXPRESSIONS)


def volumes_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inventory(spark, sf_dir, VOLUME_EXPRESSIONS)


def volumes_sql() -> str:
    return _inventory_sql(VOLUME_EXPRESSIONS)


# Account names: one per nation (name = nation name), every nation; nation 7
# is listed under a closed account's id, so its usage account is a miss.
ACCOUNT_EXPRESSIONS = [
    ("account_id",
     "case when n_nationkey = 7 then 'acct-closed-7' else concat('acct-', cast(n_nationkey as varchar(20))) end"),
    ("account_name", "n_name"),
]


def accounts_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(*[f"{e} AS {n}" for n, e in ACCOUNT_EXPRESSIONS])


def accounts_sql() -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in ACCOUNT_EXPRESSIONS)} FROM nation"
