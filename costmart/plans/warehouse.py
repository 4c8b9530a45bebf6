"""Load the written mart into catalog tables (the warehouse step).

* tag_dim: read with mergeSchema (tag columns come and go), loaded by a
  table swap, because its schema may change between loads;
* resource_dim, account_dim, date_dim: truncate-and-load (definition kept;
  created on the first load; a table that lacks a column of the dimension, say
  a lookup switched on since, is swapped instead);
* cost_insights_fact: every stored month (the dataset keeps months older
  than the rolling window), without the ``year``/``month`` partition
  columns, truncate-and-load.

Each table is one distributed job reading parquet and writing the table;
nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sinks import writers
from ..sources import readers

TRUNCATE_LOADED = ("resource_dim", "account_dim", "date_dim")


def _truncate_or_create(spark: SparkSession, df: DataFrame, table: str) -> None:
    if spark.catalog.tableExists(table):
        if set(df.columns) - set(spark.table(table).columns):
            writers.swap_table(df, table)
        else:
            writers.truncate_load(df, table)
    else:
        df.write.format("parquet").saveAsTable(table)


def load(spark: SparkSession, mart_root: str, database: str) -> dict[str, str]:
    root = mart_root.rstrip("/")
    tables = {}
    tag = readers.read_parquet(spark, f"{root}/tag_dim", merge_schema=True)
    tables["tag_dim"] = f"{database}.tag_dim"
    writers.swap_table(tag, tables["tag_dim"])
    for name in TRUNCATE_LOADED:
        tables[name] = f"{database}.{name}"
        _truncate_or_create(spark, readers.read_parquet(spark, f"{root}/{name}"), tables[name])
    fact = readers.read_parquet(spark, f"{root}/cost_insights_fact").drop("year", "month")
    tables["cost_insights_fact"] = f"{database}.cost_insights_fact"
    _truncate_or_create(spark, fact, tables["cost_insights_fact"])
    return tables
