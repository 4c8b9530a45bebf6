"""Lookups against inventory tables (instances, accounts, snapshots,
volumes), expressed as left equi-joins.

Rows that need no lookup (NULL or non-EC2 ids can be a large share of a
resource table) get a salted probe key instead of their id: a NUL
character plus a 64-bit hash of the row. It is deterministic (safe on task
retries), spreads those rows evenly over the join's partitions instead of
piling NULL keys into one, and can never equal an inventory id, so they
come out unmatched and get NULL. This keeps the lookup a single pass over
its input (splitting the rows into two branches instead lets the optimizer
push the split below the input's aggregation and scan the input twice).
Join strategy (sort-merge vs broadcast) is left to the optimizer and AQE,
which measure the inventory at run time; inventories grow with the estate,
so no broadcast is forced. Each inventory is first reduced to one row per
lookup key (the largest attributes, by a partial and a final aggregation), so
an id listed twice never multiplies the rows that look it up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import keys

_FLAG = "__needs_lookup"


def instance_attributes(instances: DataFrame) -> DataFrame:
    """Inventory (account_id, instance_id, private_ip, tags array<struct<Key,
    Value>>) -> (account_id, instance_id, private_ip, name_tag)."""
    return instances.select(
        "account_id",
        "instance_id",
        F.coalesce(F.col("private_ip"), F.lit("")).alias("private_ip"),
        keys.last_tag_value(F.col("tags"), "Name").alias("name_tag"),
    )


def probe(df: DataFrame, wanted: Column, key: Column) -> Column:
    """``key`` where ``wanted`` and not NULL; else a salted key that matches nothing."""
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in df.columns]).cast("string"))
    return F.when(wanted & key.isNotNull(), key).otherwise(salt)


def _one_per_key(table: DataFrame, keys_: list[str], values: list[str]) -> DataFrame:
    """One row per key: the largest value tuple."""
    best = table.groupBy(*keys_).agg(F.max(F.struct(*values)).alias("__best"))
    return best.select(*keys_, *[F.col(f"__best.{v}").alias(v) for v in values])


def with_instance_lookup(
    df: DataFrame,
    instances: DataFrame | None,
    wanted: Column,
    fields: dict[str, str],
    id_column: str = "resource_id",
    account_column: str | None = None,
) -> DataFrame:
    """Add ``fields`` (output name -> inventory attribute: ``private_ip`` or
    ``name_tag``) for rows where ``wanted``; '' on a miss, NULL elsewhere.
    With ``account_column`` the lookup is per (account, instance)."""
    outputs = list(fields)
    flagged = df.withColumn(_FLAG, wanted)
    if instances is None:
        return flagged.withColumns(
            {o: F.when(F.col(_FLAG), F.lit("")).otherwise(F.lit(None).cast("string")) for o in outputs}
        ).drop(_FLAG)
    inv = instance_attributes(instances)
    key_cols = [("instance_id", id_column)] + ([("account_id", account_column)] if account_column else [])
    right = _one_per_key(
        inv.select(
            *[F.col(k).alias(f"__inv_{k}") for k, _ in key_cols],
            *[F.col(src).alias(f"__inv_{out}") for out, src in fields.items()],
        ),
        [f"__inv_{k}" for k, _ in key_cols],
        [f"__inv_{out}" for out in outputs],
    )
    probed = flagged.withColumn("__probe", probe(df, F.col(_FLAG), F.col(id_column)))
    cond = F.col("__probe") == F.col("__inv_instance_id")
    if account_column:
        cond = cond & (F.col(account_column) == F.col("__inv_account_id"))
    joined = probed.join(right, cond, "left")
    return joined.withColumns(
        {
            out: F.when(F.col(_FLAG), F.coalesce(F.col(f"__inv_{out}"), F.lit(""))).otherwise(
                F.lit(None).cast("string")
            )
            for out in outputs
        }
    ).drop(_FLAG, "__probe", *[f"__inv_{k}" for k, _ in key_cols], *[f"__inv_{out}" for out in outputs])


def with_lookup(
    df: DataFrame,
    table: DataFrame,
    key: Column,
    table_key: str,
    value: str,
    out: str,
    wanted: Column,
) -> DataFrame:
    """Generic single-value lookup: ``out`` = ``table.value`` where
    ``table.table_key`` equals ``key`` for rows where ``wanted``; '' on a
    miss, NULL where not wanted."""
    right = table.select(F.col(table_key).alias("__lk_key"), F.col(value).alias("__lk_val"))
    right = _one_per_key(right, ["__lk_key"], ["__lk_val"])
    probed = df.withColumns({_FLAG: wanted, "__lk_probe": probe(df, wanted, key)})
    joined = probed.join(right, F.col("__lk_probe") == F.col("__lk_key"), "left")
    return joined.withColumn(
        out, F.when(F.col(_FLAG), F.coalesce(F.col("__lk_val"), F.lit(""))).otherwise(F.lit(None).cast("string"))
    ).drop(_FLAG, "__lk_probe", "__lk_key", "__lk_val")


def account_names(account_dim: DataFrame, accounts: DataFrame) -> DataFrame:
    """Account dimension with ``account_name`` ('' when the account is not in
    the ``accounts`` table (account_id, account_name))."""
    right = accounts.select(
        F.col("account_id").alias("__acct_id"), F.col("account_name").alias("__acct_name")
    )
    right = _one_per_key(right, ["__acct_id"], ["__acct_name"])
    joined = account_dim.join(right, F.col(C.USAGE_ACCOUNT) == F.col("__acct_id"), "left")
    return joined.withColumn("account_name", F.coalesce(F.col("__acct_name"), F.lit(""))).drop(
        "__acct_id", "__acct_name"
    )


def snapshot_id(resource_id: Column) -> Column:
    """Snapshot id: the text after the first '/' (NULL if there is none)."""
    return F.get(F.split(resource_id, "/"), 1)


def secondary_identifier(
    resource_dim_attrs: DataFrame,
    instances: DataFrame | None,
    snapshots: DataFrame,
    ec2_service: str = "Amazon Elastic Compute Cloud",
) -> DataFrame:
    """EC2 rows: snapshot ids ('snap-' anywhere) get the snapshot's restore
    expiry; instance ids ('i-' anywhere, checked second) get the private IP.
    Other rows: NULL."""
    ec2 = F.coalesce(F.col(C.SERVICE_NAME) == ec2_service, F.lit(False))
    rid = F.col("resource_id")
    is_snap = ec2 & F.coalesce(rid.contains("snap-"), F.lit(False))
    is_inst = ec2 & ~is_snap & F.coalesce(rid.contains("i-"), F.lit(False))
    # both inventories in one, told apart by a letter before the id: one join
    known = snapshots.select(
        F.concat(F.lit("s:"), F.col("snapshot_id")).alias("id"), F.col("restore_expiry").alias("value")
    )
    if instances is not None:
        ips = instance_attributes(instances)
        known = known.union(ips.select(F.concat(F.lit("i:"), F.col("instance_id")), "private_ip"))
    key = F.when(is_snap, F.concat(F.lit("s:"), snapshot_id(rid))).otherwise(F.concat(F.lit("i:"), rid))
    return with_lookup(resource_dim_attrs, known, key, "id", "value", "secondary_identifier", is_snap | is_inst)


def volume_types(df: DataFrame, volumes: DataFrame, id_column: str = "resource_id") -> DataFrame:
    """``volume_type`` from the ``volumes`` table (volume_id, volume_type)
    for ids that look like volumes ('vol-' anywhere)."""
    rid = F.col(id_column)
    return with_lookup(
        df,
        volumes,
        rid,
        "volume_id",
        "volume_type",
        "volume_type",
        F.coalesce(rid.contains("vol-"), F.lit(False)),
    )
