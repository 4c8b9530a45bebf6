"""Lookups as of the usage day: inventories whose rows hold for a time.

An inventory row (key, value, first day, day it ends) answers only for days in
``[valid_from, valid_to)``; without an end it still holds. Closed rows are put
under the day buckets that they touch, and meet the probing rows by (key,
bucket) with the range test beside the equality; open rows, at most one a key,
meet them by key. No cross join: each probing row meets the few rows of its key
and bucket, and at most one holds.

Rows that overlap are cut before: a later start ends the earlier row, and of
rows that start on the same day the largest value holds. So a lookup never
multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import enrich

BUCKET_DAYS = 32


def disjoint(inventory: DataFrame, key: str, value: str, valid_from: str, valid_to: str) -> DataFrame:
    """(key, first, stop, value) with at most one row for any key and day; ``stop`` is NULL
    while a row holds. Rows without key or first day, and empty ones, are left out."""
    rows = inventory.select(
        F.col(key).alias("key"), F.to_date(valid_from).alias("first"), F.to_date(valid_to).alias("stop"), F.col(value).alias("value")
    ).where("key IS NOT NULL AND first IS NOT NULL AND (stop IS NULL OR stop > first)")
    # one row a key and day: what the window sorts is bounded by the calendar
    one = rows.groupBy("key", "first").agg(F.max(F.struct("value", F.coalesce("stop", F.lit("9999-12-31").cast("date")))).alias("b"))
    one = one.select("key", "first", F.col("b.value").alias("value"), F.col("b.col2").alias("stop"))
    following = F.lead("first").over(Window.partitionBy("key").orderBy("first"))
    cut = one.withColumn("stop", F.least("stop", F.coalesce(following, F.lit("9999-12-31").cast("date"))))
    return cut.withColumn("stop", F.when(F.col("stop") < F.lit("9999-12-31").cast("date"), F.col("stop")))


def _bucket(day: Column, bucket_days: int) -> Column:
    return F.floor(F.unix_date(day) / bucket_days)


def with_lookup_as_of(
    df: DataFrame,
    inventory: DataFrame,
    key: Column,
    day: Column,
    out: str,
    wanted: Column,
    inventory_key: str,
    value: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    bucket_days: int = BUCKET_DAYS,
) -> DataFrame:
    """``df`` with ``out``: the value that ``inventory`` held for ``key`` on ``day``, for rows
    where ``wanted``; '' on a miss, NULL where not wanted. Rows without key
    take a salted one, so that they do not meet in one task."""
    held = disjoint(inventory, inventory_key, value, valid_from, valid_to)
    closed = held.where("stop IS NOT NULL").select(
        F.col("key").alias("__c_key"), F.col("first").alias("__c_first"), F.col("stop").alias("__c_stop"),
        F.col("value").alias("__c_value"),
        F.explode(
            F.sequence(_bucket(F.col("first"), bucket_days), _bucket(F.date_sub("stop", 1), bucket_days))
        ).alias("__c_bucket"),
    )
    still = held.where("stop IS NULL").select(
        F.col("key").alias("__o_key"), F.col("first").alias("__o_first"), F.col("value").alias("__o_value")
    )
    asked = F.coalesce(wanted, F.lit(False))
    probed = df.withColumns(
        {"__wanted": asked, "__probe": enrich.probe(df, asked, key), "__day": F.to_date(day)}
    )
    during = (
        (F.col("__probe") == F.col("__c_key"))
        & (_bucket(F.col("__day"), bucket_days) == F.col("__c_bucket"))
        & (F.col("__day") >= F.col("__c_first"))
        & (F.col("__day") < F.col("__c_stop"))
    )
    since = (F.col("__probe") == F.col("__o_key")) & (F.col("__day") >= F.col("__o_first"))
    met = probed.join(closed, during, "left").join(still, since, "left")
    found = F.coalesce("__c_value", "__o_value", F.lit(""))
    result = met.withColumn(out, F.when(F.col("__wanted"), found))
    return result.drop(*[c for c in result.columns if c.startswith(("__c_", "__o_"))], "__wanted", "__probe", "__day")


def instance_addresses(attrs: DataFrame, history: DataFrame, day: str, wanted: Column, id_column: str = "resource_id") -> DataFrame:
    """``secondary_identifier``: the private IP the instance had on ``day``, from an inventory
    (instance_id, private_ip, valid_from, valid_to)."""
    return with_lookup_as_of(
        attrs, history, F.col(id_column), F.col(day), "secondary_identifier", wanted, "instance_id", "private_ip"
    )
