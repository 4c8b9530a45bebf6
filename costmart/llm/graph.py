"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _fixed(df: DataFrame) -> tuple:
    row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node reachable.

    Alternating large-star and small-star steps. Each step groups the edges by
    node (partial sums first), writes the minima and joins them to the written
    edges, so that a hub with many neighbours is a skewed join that adaptive
    execution splits (by hint, so that no links go through the driver). Stops when a round changes no edge. Self loops and
    repeated edges are ignored; an empty edge list gives an empty result.
    """
    # canonical form: u > v
    cur = written(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc"
    )
    before = _fixed(cur)
    while before[0]:
        both = written(cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cc-both")
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "cc-min")
        large = both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u != v").distinct(), "cc-large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        moved = large.join(least.hint("merge"), "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = written(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "cc")
        after = _fixed(cur)
        if after == before:
            break
        before = after
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
