"""Sinks: parquet datasets, catalog tables and JDBC.

All writes go through Spark's DataFrameWriter; nothing is collected.

* ``write_partitioned``: ``year``/``month`` layout with dynamic partition
  overwrite, so months absent from the new result (older than the rolling
  window) keep their files. A REBALANCE hint on the partition columns lets
  AQE split a hot month into several tasks and merge small ones, instead of
  one task per month (a month can hold a large share of the rows).
* ``replace_months``: the same for a stated set of months: one of them that
  gets no rows is removed, where dynamic overwrite would keep its old rows.
* ``merge_keys``: new rows replace stored ones of the same key, all other
  stored rows stay (dimensions keep the keys of months outside the window).
* ``append_new_keys``: append only rows whose key is not already stored
  (left-anti join on the key), so re-runs do not duplicate dimension keys.
* ``swap_table``: load a new table, then drop the old one and rename; the
  schema may change between loads.
* ``truncate_load``: replace the rows of an existing table, keep its
  definition (new folder, then the table's location is switched).
* ``write_if_any``: skip the write when the result is empty, so an empty
  run does not wipe the target.
* ``replace_dataset``: write to a staging folder, then swap folders (a plain
  overwrite deletes the target before its job runs).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import readers

PARTITIONS = ("year", "month")


def write_overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_dataset(df: DataFrame, path: str) -> None:
    """Replace the dataset at ``path``: ``df`` is written to a sibling staging
    folder first; only after that job succeeded is the old folder renamed away,
    the new one renamed into place and the old one removed. If the second
    rename fails the old folder gets its name back, so the old rows are never
    lost; between the two renames readers see no folder (point a catalog table
    at versioned folders, as ``truncate_load`` does, where that matters)."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}__staging-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(staging)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}__old-{uuid.uuid4().hex[:12]}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise RuntimeError(f"could not move {path} away")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), target):
        if had:
            fs.rename(old, target)
        raise RuntimeError(f"could not move {staging} to {path}")
    if had:
        fs.delete(old, True)


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: tuple[str, ...] = PARTITIONS,
    dynamic: bool = True,
    rebalance: bool = True,
) -> None:
    """Partitioned parquet write; with ``dynamic`` only the partitions present
    in ``df`` are replaced. ``rebalance=False`` skips the shuffle when each
    input split already belongs to one partition (e.g. ``df`` is read from a
    dataset partitioned the same way)."""
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def replace_months(
    df: DataFrame, path: str, owns: Callable[[tuple[int, int]], bool], rebalance: bool = True
) -> list[tuple[int, int]]:
    """Make the months that ``owns`` accepts exactly those of ``df``; the
    dataset's other months stay. Returns the months removed.

    Dynamic overwrite replaces the months that have rows. A folder of an owned
    month that still holds a file it held before the job got none: it is removed
    after the job's commit. That takes one listing a stored month and no second
    pass over ``df``. A run that fails in between is repeated: the write is
    idempotent."""
    spark = df.sparkSession
    held = {}
    for year, month, folder in readers.partition_dirs(spark, path):
        number = readers.month_number(year, month)
        if number is not None and owns(number):
            held[folder] = (number, readers.any_file(spark, folder))
    write_partitioned(df, path, rebalance=rebalance)
    removed = []
    for folder, (number, file) in held.items():
        if file is None or readers.exists(spark, file):
            readers.delete(spark, folder)
            removed.append(number)
    return sorted(set(removed))


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row of each key: the largest by its other columns, in their order."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.distinct()
    best = df.groupBy(key).agg(F.max(F.struct(*others)).alias("__best"))
    return best.select(*[F.col(key) if c == key else F.col(f"__best.{c}").alias(c) for c in df.columns])


def merge_keys(df: DataFrame, path: str, key: str, absent: str | None = None) -> None:
    """Replace the dataset at ``path`` by its rows plus those of ``df``, one
    row per key; a key in both has the row of ``df``. Columns are the union of
    both; text columns that a side lacks become ``absent`` there.

    Rows that are new or differ are staged first. Without any, nothing is
    written; if all are new they are appended; only a changed row or a new
    column rewrites the dataset."""
    spark = df.sparkSession
    merged = one_per_key(df, key)
    if not readers.exists(spark, path):
        replace_dataset(merged, path)
        return
    stored = readers.read_parquet(spark, path, merge_schema=True)

    def filled(rows: DataFrame) -> DataFrame:
        if absent is None:
            return rows
        return rows.select(
            *[F.coalesce(c, F.lit(absent)).alias(c) if t == "string" and c != key else c for c, t in rows.dtypes]
        )

    if set(merged.columns) - set(stored.columns):
        kept = stored.join(merged.select(key), key, "left_anti")
        replace_dataset(filled(merged.unionByName(kept, allowMissingColumns=True)), path)
        return
    # the columns of the stored rows; the stored row beside each new one
    new = filled(merged.unionByName(stored.limit(0), allowMissingColumns=True)).select(*stored.columns)
    others = [c for c in stored.columns if c != key]
    beside = stored.select(F.col(key).alias("__key"), F.struct(*others, F.lit(1)).alias("__stored"))
    met = new.join(beside, F.col(key) == F.col("__key"), "left")
    differs = F.col("__stored").isNull() | ~F.struct(*others, F.lit(1)).eqNullSafe(F.col("__stored"))
    staged = scratch_path(spark, "merge")
    changed = met.where(differs).select(*stored.columns, F.col("__stored").isNotNull().alias("__known"))
    changed.hint("rebalance").write.parquet(staged)
    try:
        rows = spark.read.schema(changed.schema).parquet(staged)
        known = {r["__known"] for r in rows.select("__known").distinct().collect()}
        rows = rows.drop("__known")
        if known == {False}:
            rows.write.mode("append").parquet(path)
        elif known:
            replace_dataset(rows.union(stored.join(rows.select(key), key, "left_anti").select(*stored.columns)), path)
    finally:
        readers.delete(spark, staged)


def append_new_keys(df: DataFrame, path: str, key: str) -> None:
    """Append the rows of ``df`` whose ``key`` is not in the dataset at
    ``path`` (or all rows when there is none yet). A key that ``df`` holds
    more than once is appended once, with its largest row."""
    spark = df.sparkSession
    df = one_per_key(df, key)
    if not readers.exists(spark, path):
        df.write.mode("append").parquet(path)
        return
    stored = spark.read.parquet(path).select(F.col(key).alias("__stored_key")).distinct()
    new = df.join(stored, F.col(key) == F.col("__stored_key"), "left_anti")
    # Materialize the new rows before appending: the anti join reads the
    # target, which the append then changes.
    staged_path = scratch_path(spark, "new_keys")
    new.write.parquet(staged_path)
    spark.read.schema(new.schema).parquet(staged_path).write.mode("append").parquet(path)
    readers.delete(spark, staged_path)


def write_if_any(df: DataFrame, write: Callable[[DataFrame], None]) -> bool:
    """Run ``write(df)`` unless ``df`` is empty. ``df`` is staged first (as
    parquet in the shared checkpoint folder, removed afterwards) so the
    emptiness test and the write do not compute it twice."""
    spark = df.sparkSession
    path = scratch_path(spark, "if_any")
    df.write.parquet(path)
    try:
        staged = spark.read.schema(df.schema).parquet(path)
        if staged.isEmpty():
            return False
        write(staged)
        return True
    finally:
        readers.delete(spark, path)


def truncate_load(df: DataFrame, table: str) -> None:
    """Replace all rows of existing ``table`` with ``df`` (columns by name).

    The rows are written once, to a new folder beside the table's, and the
    table is then pointed to it: one catalog operation, before which the old
    rows are read and after which the new ones are. ``df`` may read the table
    itself. The old folder is removed last."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    old = _location(spark, table)
    new = f"{old.rsplit('__v-', 1)[0].rstrip('/')}__v-{uuid.uuid4().hex[:12]}"
    df.select(*columns).write.parquet(new)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{new}'")
    spark.catalog.refreshTable(table)
    readers.delete(spark, old)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def swap_table(df: DataFrame, table: str, staging_suffix: str = "__new") -> None:
    """Load ``df`` into a table beside ``table``, rename the old table away, the new
    one in, and drop the old one last. The old rows exist under one of the two
    names until the new table has its name; if the second rename fails, the
    old table gets its name back."""
    spark = df.sparkSession
    # a new name each time: a failed load leaves its folder behind
    run = uuid.uuid4().hex[:8]
    staging, old = f"{table}{staging_suffix}_{run}", f"{table}__old_{run}"
    df.write.format("parquet").saveAsTable(staging)
    had = spark.catalog.tableExists(table)
    if had:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if had:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    truncate: bool = True,
    num_partitions: int | None = None,
) -> None:
    """Truncate-and-load into a JDBC table (the table definition is kept when
    ``truncate``). ``num_partitions`` bounds concurrent connections."""
    writer = df.write.mode("overwrite").option("truncate", str(truncate).lower())
    if num_partitions:
        writer = writer.option("numPartitions", str(num_partitions))
    writer.jdbc(url, table, properties=properties or {})


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")
