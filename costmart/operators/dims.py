"""Dimensions: tag, account, date and resource.

Each is a distinct projection (a partial + final aggregate, so a hot value
is combined map-side before the shuffle) plus a key column. The date
dimension is generated from the min/max usage date, so its size is bounded
by the calendar span, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import keys
from . import enrich

TAG_KEY = "tag_dim_id"
TAG_SET_KEY = "tag_set_id"
RESOURCE_KEY = "aws_product_dim_id"
ACCOUNT_KEY = "aws_account_dim_id"
DATE_KEY = "date_dim_id"
EC2_SERVICE = "Amazon Elastic Compute Cloud"


def tag_dim(source: DataFrame, tag_prefix: str = C.TAG_PREFIX) -> DataFrame:
    """Distinct normalized tag combinations of ``source`` (summary or wide
    fact) with ``tag_dim_id`` = sha256 of the sorted values joined by '||'."""
    tags = C.tag_columns(source, tag_prefix)
    distinct = source.select(*[F.coalesce(F.col(t), F.lit("")).alias(t) for t in tags]).distinct()
    return distinct.withColumn(TAG_KEY, keys.surrogate_key(tags))


def tag_key_map(tag_dim_rows: DataFrame, tag_prefix: str = C.TAG_PREFIX) -> DataFrame:
    """(tag_dim_id, tag_set_id) of a tag dimension's rows.

    ``tag_dim_id`` hashes one value for each tag column that existed when it was
    made, so the same tags get another id once a column is added; ``tag_set_id``
    depends on the non-empty tags only. The map leads the ids of any time to it."""
    tags = C.tag_columns(tag_dim_rows, tag_prefix)
    return tag_dim_rows.select(TAG_KEY, keys.tag_set_key(tags).alias(TAG_SET_KEY)).distinct()


def tag_set_dim(tag_dim_rows: DataFrame, tag_prefix: str = C.TAG_PREFIX) -> DataFrame:
    """One row per set of non-empty tags, whatever ids it has had: the tag
    columns ('' where absent) and ``tag_set_id``."""
    tags = C.tag_columns(tag_dim_rows, tag_prefix)
    distinct = tag_dim_rows.select(*[F.coalesce(F.col(t), F.lit("")).alias(t) for t in tags]).distinct()
    return distinct.withColumn(TAG_SET_KEY, keys.tag_set_key(tags))


def by_tag_set(fact_rows: DataFrame, tag_keys: DataFrame, measures: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Sums of fact rows of any time by ``tag_set_id`` (and the ``by`` columns).

    The fact is added up by its own tag ids first, so an id that a third of the
    rows have (no tags) meets the map as a row a task and not as a hot key."""
    per_id = fact_rows.groupBy(TAG_KEY, *by).agg(*[F.sum(m).alias(m) for m in measures])
    met = per_id.join(tag_keys.select(TAG_KEY, TAG_SET_KEY), TAG_KEY, "left")
    return met.groupBy(TAG_SET_KEY, *by).agg(*[F.sum(m).alias(m) for m in measures])


def account_dim(cur: DataFrame) -> DataFrame:
    """Distinct (payer, usage account) pairs of the whole raw table."""
    return (
        cur.select(C.PAYER, C.USAGE_ACCOUNT)
        .distinct()
        .withColumn(ACCOUNT_KEY, F.col(C.USAGE_ACCOUNT))
    )


def day_bounds(cur: DataFrame) -> DataFrame:
    """One row (lo, hi): first and last usage day of ``cur``, NULL without rows."""
    # min/max of the raw column (to_date is monotonic): a partial aggregate
    # per task, one row to the final aggregate.
    return cur.agg(
        F.to_date(F.min(F.col(C.USAGE_START))).alias("lo"),
        F.to_date(F.max(F.col(C.USAGE_START))).alias("hi"),
    )


def account_spans(cur: DataFrame) -> DataFrame:
    """(payer, usage account, lo, hi): the accounts with their first and last
    usage day. ``account_dim`` and ``calendar`` of these rows are those of
    ``cur``, which is so read once for both; a row an account and task is shuffled."""
    return cur.groupBy(C.PAYER, C.USAGE_ACCOUNT).agg(
        F.to_date(F.min(C.USAGE_START)).alias("lo"), F.to_date(F.max(C.USAGE_START)).alias("hi")
    )


def stored_bounds(date_dim_rows: DataFrame, pad_days: int = 1) -> DataFrame:
    """The (lo, hi) that a stored date dimension was generated from."""
    day = F.to_date(F.col(DATE_KEY), "yyyyMMdd")
    return date_dim_rows.agg(F.min(day).alias("lo"), F.date_sub(F.max(day), pad_days).alias("hi"))


def calendar(bounds: DataFrame, pad_days: int = 1) -> DataFrame:
    """One row per day from the least ``lo`` to the largest ``hi`` of ``bounds`` plus ``pad_days``."""
    span = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = span.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.col("lo"), F.date_add(F.col("hi"), pad_days))).alias("d")
    )
    return days.select(
        F.date_format("d", "yyyyMMdd").alias(DATE_KEY),
        F.date_format("d", "dd").alias("day_attr"),
        F.date_format("d", "MMM").alias("month_attr"),
        F.date_format("d", "yyyy").alias("year_attr"),
    )


def date_dim(cur: DataFrame, pad_days: int = 1) -> DataFrame:
    """One row per day from the first to the last usage day of the whole raw
    table, plus ``pad_days`` extra days (the original job emits one)."""
    return calendar(day_bounds(cur), pad_days)


def resource_attributes(source: DataFrame) -> DataFrame:
    """Distinct resource attribute tuples with the hash key and short id."""
    return (
        source.select(*C.RESOURCE_DIM_COLUMNS)
        .distinct()
        .withColumns(
            {
                RESOURCE_KEY: keys.surrogate_key(C.RESOURCE_DIM_COLUMNS),
                "resource_id": keys.short_resource_id(F.col(C.RESOURCE_ID)),
            }
        )
    )


def is_ec2_instance(service_name: str = C.SERVICE_NAME, resource_id: str = "resource_id"):
    """Rows that get an instance lookup: EC2 service and 'i-' in the id.
    NULL inputs count as false."""
    return F.coalesce(
        (F.col(service_name) == EC2_SERVICE) & F.col(resource_id).contains("i-"), F.lit(False)
    )


def resource_dim(
    source: DataFrame, instances: DataFrame | None = None, with_name: bool = False
) -> DataFrame:
    """Resource dimension: attributes, key, short id and, for EC2 instances,
    the private IP (and with ``with_name`` the last Name tag) from the
    ``instances`` inventory ('' when not found; NULL for other resources).

    Without an inventory every EC2 instance row is a lookup miss ('').
    """
    attrs = resource_attributes(source)
    fields = {"secondary_identifier": "private_ip"}
    if with_name:
        fields["resource_name"] = "name_tag"
    return enrich.with_instance_lookup(attrs, instances, wanted=is_ec2_instance(), fields=fields)


def cross_account_resource_dim(
    source: DataFrame,
    accounts: list[str],
    instances: DataFrame | None = None,
    operation: str = "RunInstances",
) -> DataFrame:
    """Resource dimension for some accounts and one operation, with IP and
    Name tag looked up per (account, instance).

    The account column is dropped before de-duplication; a tuple seen in
    several accounts is one row, with the largest lookups (found before missed).
    """
    picked = source.where(F.col("linked_account_id").isin(*accounts) & (F.col(C.OPERATION) == operation))
    attrs = (
        picked.select(*C.RESOURCE_DIM_COLUMNS, "linked_account_id")
        .distinct()
        .withColumns(
            {
                RESOURCE_KEY: keys.surrogate_key(C.RESOURCE_DIM_COLUMNS),
                "resource_id": keys.short_resource_id(F.col(C.RESOURCE_ID)),
            }
        )
    )
    looked_up = enrich.with_instance_lookup(
        attrs,
        instances,
        wanted=is_ec2_instance(),
        fields={"secondary_identifier": "private_ip", "resource_name": "name_tag"},
        account_column="linked_account_id",
    )
    fields = ["secondary_identifier", "resource_name"]
    attributes = [c for c in looked_up.columns if c not in (*fields, "linked_account_id")]
    best = looked_up.groupBy(*attributes).agg(F.max(F.struct(*fields)).alias("__best"))
    return best.select(*attributes, *[F.col(f"__best.{f}").alias(f) for f in fields])
