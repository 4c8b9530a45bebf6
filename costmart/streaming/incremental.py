"""Incremental maintenance of the fact, or of the whole mart (``mart_root``).

Two ways tell which months of the year/month-partitioned CUR dataset changed;
those months are recomputed from the full CUR table and replaced (a month left
without rows is removed). A month's sums need all of its rows, so a delta alone is
never aggregated into the fact.

* ``run_until_caught_up`` (scheduled runs) compares a manifest of the files
  (path, length, modification time) with that of the last run, as a
  distributed join. It sees new, rewritten and removed files of any age;
  billing exports rewrite the open month in place.
* ``start`` is a Structured Streaming file source for continuous runs. It
  sees the rows of new files only (that is how the source tracks files), so
  not a month whose rows were withdrawn.

Properties:
* Replaying a batch (after a failure) recomputes the same months from the
  same table and overwrites them again: the sink is idempotent.
* The manifest is replaced only after the refresh, so a failed run is
  repeated by the next one. Changed months outside the rolling window are not
  reported as refreshed; they stay changed until a run's window holds them.
* The set of touched months is the only thing brought to the driver; it is
  bounded by the calendar, not by the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import dates
from ..operators import fact
from ..plans import mart
from ..session import scratch_path
from ..sinks import writers
from ..sources import readers


def touched_months(batch: DataFrame) -> list[tuple[str, str]]:
    """Distinct (year, month) pairs of a micro-batch (a handful of rows)."""
    return [(r["year"], r["month"]) for r in batch.select("year", "month").distinct().collect()]


def refresh_months(
    spark: SparkSession,
    cur_path: str,
    fact_path: str,
    months: list[tuple[str, str]],
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    mart_root: str | None = None,
    lookups: dict | None = None,
) -> list[tuple[str, str]]:
    """Recompute the fact for ``months`` from the whole CUR dataset and
    replace those partitions. Returns the months refreshed: those of the
    rolling window. A month without any rows left loses its fact rows.

    With ``mart_root`` the fact is that of the mart there (``fact_path`` is not
    used) and the months' keys are merged into its four dimensions in the same
    run; ``lookups`` are the inventories that ``mart.refresh`` takes."""
    if months_back is not None:
        # months before the rolling window contribute no rows; skip them
        start = dates.window_start(dates.as_date(as_of), months_back)
        months = [(y, m) for y, m in months if (int(y), int(m)) >= (start.year, start.month)]
    if not months:
        return []
    # only the touched months' rows are read, with the columns of all months
    schema = readers.union_schema(spark, cur_path)
    cur = readers.read_months(spark, cur_path, months=months, schema=schema)
    if mart_root is not None:
        mart.refresh(spark, cur, mart_root, months, as_of, months_back, **(lookups or {}))
        return months
    wanted = {readers.month_number(y, m) for y, m in months}
    writers.replace_months(fact.fact_direct(cur, as_of=as_of, months_back=months_back), fact_path, wanted.__contains__)
    return months


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified, year, month) of the data files under ``root``;
    lists them, reads none."""
    files = readers.list_files(spark, root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"), "year", "month")


def changed_files(now: DataFrame, before: DataFrame) -> DataFrame:
    """(year, month, path) of files that are new, gone, or of another length or time."""
    a, b = now.alias("a"), before.alias("b")
    differs = F.col("a.path").isNull() | F.col("b.path").isNull()
    differs = differs | (F.col("a.length") != F.col("b.length")) | (F.col("a.modified") != F.col("b.modified"))
    return a.join(b, F.col("a.path") == F.col("b.path"), "full").where(differs).select(
        F.coalesce("a.year", "b.year").alias("year"), F.coalesce("a.month", "b.month").alias("month"),
        F.coalesce("a.path", "b.path").alias("path"),
    )


def _pending_path(checkpoint_location: str) -> str:
    return f"{checkpoint_location.rstrip('/')}/pending_months"


def start(
    spark: SparkSession,
    cur_path: str,
    fact_path: str,
    checkpoint_location: str,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    available_now: bool = True,
    max_files_per_trigger: int = 1000,
    defer_refresh: bool = False,
    mart_root: str | None = None,
    lookups: dict | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops once caught up.

    Each micro-batch either refreshes its touched months at once, or, with
    ``defer_refresh``, appends them to a pending-months table next to the
    stream checkpoint (see ``refresh_pending``): a backlog split into many
    micro-batches then recomputes each month once, not once per batch.
    """
    stream = (
        spark.readStream.schema("year string, month string")  # which months, nothing else
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("maxFileAge", "36500d")  # late deliveries may carry old times
        .parquet(cur_path)
        .select("year", "month")
    )
    pending = _pending_path(checkpoint_location)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if defer_refresh:
            # a replayed batch appends the same months again: harmless
            batch.select("year", "month").distinct().write.mode("append").parquet(pending)
        else:
            months = touched_months(batch)
            refresh_months(batch.sparkSession, cur_path, fact_path, months, as_of, months_back, mart_root, lookups)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def refresh_pending(
    spark: SparkSession,
    cur_path: str,
    fact_path: str,
    checkpoint_location: str,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    mart_root: str | None = None,
    lookups: dict | None = None,
) -> list[tuple[str, str]]:
    """Recompute every pending month once, then clear the pending table but
    for the months outside the window. If the refresh fails the months stay
    pending and the next run repeats it (the refresh is idempotent). Returns
    the months refreshed."""
    pending = _pending_path(checkpoint_location)
    if not readers.exists(spark, pending):
        return []
    # explicit schema: a batch of empty files leaves a folder without rows
    months = touched_months(spark.read.schema("year string, month string").parquet(pending))
    done = refresh_months(spark, cur_path, fact_path, months, as_of, months_back, mart_root, lookups)
    readers.delete(spark, pending)
    if left := [m for m in months if m not in done]:
        spark.createDataFrame(left, "year string, month string").write.mode("append").parquet(pending)
    return done


def run_until_caught_up(
    spark: SparkSession,
    cur_path: str,
    fact_path: str,
    checkpoint_location: str,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    mart_root: str | None = None,
    lookups: dict | None = None,
) -> list[tuple[str, str]]:
    """Refresh the months whose files changed since the last run, each once.
    Returns the months refreshed."""
    stored = f"{checkpoint_location.rstrip('/')}/manifest"
    schema = "path string, length long, modified timestamp, year string, month string"
    # as listed now: what arrives during the refresh counts as changed next time
    path = scratch_path(spark, "manifest")
    manifest(spark, cur_path).write.parquet(path)
    now = spark.read.schema(schema).parquet(path)
    before = spark.read.schema(schema).parquet(stored) if readers.exists(spark, stored) else now.limit(0)
    months = touched_months(changed_files(now, before))
    done = refresh_months(spark, cur_path, fact_path, months, as_of, months_back, mart_root, lookups)
    if months:
        left = [f"{y}-{m}" for y, m in months if (y, m) not in done]
        outside = F.concat_ws("-", "year", "month").isin(left)
        writers.replace_dataset(now.where(~outside).union(before.where(outside)), stored)
    readers.delete(spark, path)
    return done
