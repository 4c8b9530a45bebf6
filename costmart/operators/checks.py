"""Data checks on the mart: key uniqueness, orphan keys, key collisions and
measure reconciliation. Each returns a DataFrame (distributed), never a
collected list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C


def key_stats(name: str, dim: DataFrame, key: str) -> DataFrame:
    """One row: dimension name, row count, distinct key count, and the number
    of keys held by more than one row (0 for a valid dimension)."""
    per_key = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("dim_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("duplicated_keys"),
    ).select(F.lit(name).alias("dim"), "*")


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Rows of ``dim`` whose key occurs more than once."""
    dup = dim.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select(key)
    return dim.join(dup, key, "left_semi")


def orphan_keys(fact_df: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact keys without a row in ``dim``, with their fact row counts.

    The fact side is aggregated to (key, rows) first (partial aggregation:
    a key held by a third of the fact is one row per task before the
    shuffle), then anti-joined with the distinct dimension keys.
    """
    dim_key = dim_key or fact_key
    keys = dim.select(F.col(dim_key).alias("__dim_key")).distinct()
    per_key = fact_df.groupBy(F.col(fact_key)).agg(F.count(F.lit(1)).alias("fact_rows"))
    return per_key.join(keys, F.col(fact_key) == F.col("__dim_key"), "left_anti")


def orphan_counts(fact_df: DataFrame, dimensions: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dim, orphan_rows) for each dimension (rows, key), in one pass over the fact.

    Each fact row gives one (dimension, key) pair per dimension; the pairs are
    counted with partial sums, then met by the dimensions' keys in one join.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("dim"), F.col(k).alias("key")) for n, (_, k) in dimensions.items()])
    used = fact_df.select(F.explode(pairs).alias("p")).groupBy("p.dim", "p.key").agg(F.count("*").alias("n"))
    known = reduce(
        DataFrame.union, [d.select(F.lit(n).alias("dim"), F.col(k).alias("key")) for n, (d, k) in dimensions.items()]
    )
    known = known.distinct().withColumn("known", F.lit(True))
    missing = F.when(F.col("known").isNull(), F.col("n")).otherwise(0)
    met = used.join(known, ["dim", "key"], "left")
    return met.groupBy("dim").agg(F.sum(missing).alias("orphan_rows"))


def key_collisions(dim: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Keys shared by two different attribute tuples (NULL-skipping key text
    can map distinct tuples to one key)."""
    return (
        dim.select(key, *attributes)
        .distinct()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("tuples"))
        .where(F.col("tuples") > 1)
    )


def key_tuple_stats(dim: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row: distinct attribute tuples, distinct keys, and keys shared by
    more than one tuple (0 when the key is collision-free)."""
    per_key = dim.select(key, *attributes).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("distinct_tuples"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).cast("long").alias("colliding_keys"),
    )


def measure_totals(level: str, df: DataFrame, measures: list[str]) -> DataFrame:
    return df.agg(*[F.sum(m).alias(m) for m in measures]).select(F.lit(level).alias("level"), *measures)


def reconciliation(windowed_cur: DataFrame, summary_df: DataFrame, fact_df: DataFrame) -> DataFrame:
    """Totals of the fact measures at three levels (line items in the window,
    summary, fact); all three rows must be equal."""
    from ..functions import measures as M

    rows = windowed_cur.agg(*M.measure_aggs(C.FACT_MEASURES)).select(F.lit("line_items").alias("level"), *C.FACT_MEASURES)
    parts = [
        rows,
        measure_totals("summary", summary_df, C.FACT_MEASURES),
        measure_totals("fact", fact_df, C.FACT_MEASURES),
    ]
    return reduce(DataFrame.unionByName, parts)
