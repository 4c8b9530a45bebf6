"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

The unit is a group of rows with equal text; a group is never split, and every
group is placed by itself: most bytes first, each to the shard whose residual
capacity has the highest dot product with the group's share of bytes, tokens
and rows. Groups with a 1/HEAVY part or more of any total (at most 3 * HEAVY of
them) are placed first, on the driver. All others are dealt by the hash of
their text to buckets of about BUCKET_GROUPS, and each bucket places its groups
in one task against its share of the capacity that is left; as a bucket ends
with its smallest groups, what it leaves uneven is a few bytes. The law that
holds is that of bytes, so bytes weigh IMPORTANCE times in the product.

Defined results: null texts are one group, of one byte a row and no tokens;
empty texts are another; rows with equal ids and repeated rows each have a
slot; shards that get nothing are simply absent; an empty table gives an empty
result. Sizes are as near equal as whole groups allow. Columns of the input
pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

HEAVY = 8192
BUCKET_GROUPS = 1 << 15  # groups that one task places
SLOT_ROWS = 16384  # rows that one task numbers
LEAST_BUCKETS = 16
LAW = "bytes"
DIMENSIONS = ["bytes", "tokens", "rows"]
IMPORTANCE = [16.0, 1.0, 1.0]


def pack(
    items: np.ndarray, shards: int, importance: list[float], total: np.ndarray | None = None, residual: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each row of ``items``, residual capacities after it).

    ``items`` are amounts by dimension, the first of which orders them (ties as
    they come). Amounts are measured in shares of a shard's capacity, ``total``
    (by default that of the items) / shards; a shard starts with a capacity of
    one in each dimension, or with ``residual`` (shards, dimensions).
    """
    total = items.sum(axis=0) if total is None else np.asarray(total, float)
    share = items * shards / np.where(total > 0, total, 1)
    residual = np.ones((shards, items.shape[1])) if residual is None else np.array(residual, float)
    place = np.zeros(len(items), np.int64)
    weights = np.array(importance)
    order = np.argsort(-share[:, 0], kind="stable")
    for i in order.tolist():
        best = int(np.argmax(residual @ (weights * share[i])))
        place[i] = best
        residual[best] -= share[i]
    return place, residual


def _amounts(rows, columns=DIMENSIONS) -> np.ndarray:
    return np.array([[float(r[c]) for c in columns] for r in rows], float).reshape(len(rows), len(columns))


def place_groups(groups: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """(heavy, others): (grp, shard) and (grp, shard, rows) of the groups (grp, bytes, tokens, rows).

    ``heavy`` has at most 3 * HEAVY rows."""
    spark = groups.sparkSession
    total = groups.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in DIMENSIONS]).first()
    is_heavy = F.lit(False)
    for c in DIMENSIONS:
        is_heavy = is_heavy | (F.col(c) * HEAVY >= F.lit(total[c] or 0)) & (F.col(c) > 0)
    # at most HEAVY groups a dimension
    heavy = sorted(groups.filter(is_heavy).collect(), key=lambda r: r["grp"])
    whole = np.array([float(total[c] or 0) for c in DIMENSIONS])
    amounts = _amounts(heavy)
    placed, residual = pack(amounts, shards, IMPORTANCE, whole)
    first = spark.createDataFrame([(r["grp"], int(s)) for r, s in zip(heavy, placed)], "grp string, shard int")
    # what is left of each shard, in shares of the capacity that the other groups fill
    left = whole - amounts.sum(axis=0)
    capacity = np.where(left > 0, residual * whole / np.where(left > 0, left, 1), 0)

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by("grp")
        items = np.stack([table.column(c).to_numpy().astype(float) for c in DIMENSIONS], axis=1)
        shard, _ = pack(items, shards, IMPORTANCE, residual=capacity)
        return pa.table({"grp": table.column("grp"), "shard": pa.array(shard.astype(np.int32)), "rows": table.column("rows")})

    buckets = max(1, -(-(total["n"] or 0) // BUCKET_GROUPS))
    light = groups.filter(~is_heavy).withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(buckets)))
    others = light.groupBy("bucket").applyInArrow(place, "grp string, shard int, rows long")
    return first, written(others, "shard-places")


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as (row, size, text_crc32, law, shard, slot, grown_shard); row is a struct of all columns."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`").cast("string")
    based = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text.cast("binary"), F.lit(b""))).alias("crc"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("grp"),
        F.coalesce(F.regexp_count(text, F.lit("\\S+")), F.lit(0)).cast("long").alias("n_tokens"),
    )
    amounts = [F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")]
    groups = written(based.groupBy("grp").agg(*amounts), "shard-groups")
    n_rows = groups.agg(F.sum("rows")).first()[0] or 0
    heavy, others = place_groups(groups, shards)
    # whole rows move once, by bucket: to their places, and to be numbered. Rows of a heavy group meet a
    # broadcast of bounded size and are dealt by id; no other group has 1/HEAVY of the rows.
    buckets = max(LEAST_BUCKETS, -(-n_rows // SLOT_ROWS))
    by_group = F.pmod(F.xxhash64("grp"), F.lit(buckets))
    marked = based.drop("n_tokens").join(F.broadcast(heavy.withColumnRenamed("shard", "own_shard")), "grp", "left")
    by_id = F.pmod(F.xxhash64("id", "crc"), F.lit(buckets))
    marked = marked.withColumn("bucket", F.when(F.col("own_shard").isNull(), by_group).otherwise(by_id))
    # units of rows with one bucket and group: their shard, and where their slots start
    light = others.withColumn("bucket", by_group)
    large = marked.filter("own_shard is not null").groupBy("bucket", "grp", F.col("own_shard").alias("shard"))
    units = light.select("bucket", "grp", "shard", "rows").union(large.agg(F.count("*").alias("rows")))
    units = written(units, "shard-units")
    counts = units.groupBy("shard", "bucket").agg(F.sum("rows").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    starts = counts.select("shard", "bucket", before.alias("bucket_slot"))
    inside = F.sum("rows").over(Window.partitionBy("shard", "bucket").orderBy("grp")) - F.col("rows")
    slots = units.withColumn("inside", inside).join(starts, ["shard", "bucket"])
    slots = slots.select("bucket", "grp", "shard", (F.col("bucket_slot") + F.col("inside")).alias("first_slot"))
    slots = written(slots, "shard-slots")
    numbered = marked.drop("own_shard").join(slots.hint("shuffle_hash"), ["bucket", "grp"])
    numbered = numbered.withColumn(
        "place", F.row_number().over(Window.partitionBy("bucket", "grp").orderBy("id", "crc", "size"))
    )
    return numbered.select(
        "row",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("first_slot") + F.col("place") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
