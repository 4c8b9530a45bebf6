"""Sinks: dynamic partition overwrite, append-new-keys, swap, truncate-load,
write-if-any, schema merge."""

import uuid

from costmart.session import scratch_path
from costmart.sinks import writers
from costmart.sources import readers


def _df(spark, rows):
    return spark.createDataFrame(rows, "year string, month string, v int")


def test_dynamic_partition_overwrite(spark):
    path = scratch_path(spark, "t-dyn")
    writers.write_partitioned(_df(spark, [("2021", "3", 1), ("2021", "4", 2)]), path)
    writers.write_partitioned(_df(spark, [("2021", "4", 9), ("2021", "5", 10)]), path)
    got = {(r.month, r.v) for r in readers.read_parquet(spark, path).collect()}
    assert got == {("3", 1), ("4", 9), ("5", 10)}
    schema = dict(readers.read_parquet(spark, path).dtypes)
    assert schema["year"] == "string" and schema["month"] == "string"


def test_static_overwrite_erases_history(spark):
    path = scratch_path(spark, "t-static")
    writers.write_partitioned(_df(spark, [("2021", "3", 1)]), path, dynamic=False)
    writers.write_partitioned(_df(spark, [("2021", "4", 9)]), path, dynamic=False)
    assert {r.month for r in readers.read_parquet(spark, path).collect()} == {"4"}


def test_append_new_keys(spark):
    path = scratch_path(spark, "t-append")
    writers.append_new_keys(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, "k")
    writers.append_new_keys(spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int"), path, "k")
    got = sorted(tuple(r) for r in readers.read_parquet(spark, path).collect())
    assert got == [("a", 1), ("b", 2), ("c", 3)]


def test_write_if_any(spark):
    path = scratch_path(spark, "t-any")
    assert writers.write_if_any(spark.createDataFrame([("a",)], "k string"), lambda d: writers.write_overwrite(d, path))
    empty = spark.createDataFrame([], "k string")
    assert not writers.write_if_any(empty, lambda d: writers.write_overwrite(d, path))
    assert [r.k for r in readers.read_parquet(spark, path).collect()] == ["a"]


def test_swap_and_truncate_load(spark):
    db = f"t_{uuid.uuid4().hex[:8]}"
    writers.ensure_database(spark, db, scratch_path(spark, db))
    t = f"{db}.dim"
    writers.swap_table(spark.createDataFrame([("a",)], "k string"), t)
    writers.swap_table(spark.createDataFrame([("b", "x")], "k string, extra string"), t)
    assert [tuple(r) for r in spark.table(t).collect()] == [("b", "x")]
    writers.truncate_load(spark.createDataFrame([("x2", "c")], "extra string, k string"), t)
    assert [tuple(r) for r in spark.table(t).collect()] == [("c", "x2")]
    assert not spark.catalog.tableExists(f"{t}__new")


def test_merge_schema(spark):
    path = scratch_path(spark, "t-merge")
    writers.write_append(spark.createDataFrame([("a",)], "env string"), path)
    writers.write_append(spark.createDataFrame([("b", "t")], "env string, team string"), path)
    got = sorted((r.env, r.team) for r in readers.read_parquet(spark, path, merge_schema=True).collect())
    assert got == [("a", None), ("b", "t")]


def test_read_months_lists_only_wanted_partitions(spark):
    import datetime as dt

    path = scratch_path(spark, "t-months")
    writers.write_partitioned(_df(spark, [("2020", "12", 1), ("2021", "3", 2), ("2021", "10", 3)]), path)
    got = readers.read_months(spark, path, since=dt.date(2021, 3, 1))
    assert sorted((r.year, r.month, r.v) for r in got.collect()) == [("2021", "10", 3), ("2021", "3", 2)]
    files = got.inputFiles()
    assert files and all("year=2020" not in f for f in files)
    one = readers.read_months(spark, path, months=[("2020", "12")])
    assert [(r.year, r.month) for r in one.collect()] == [("2020", "12")]
    assert readers.read_months(spark, path, months=[("1999", "1")]).count() == 0


def test_replace_dataset_keeps_old_data_when_the_job_fails(spark):
    import pytest
    from pyspark.sql import functions as F

    path = scratch_path(spark, "t-replace")
    writers.replace_dataset(spark.createDataFrame([("a",)], "k string"), path)
    bad = spark.createDataFrame([("0",)], "k string").select(
        F.when(F.col("k") == "0", F.raise_error("boom")).otherwise(F.col("k")).alias("k")
    )
    with pytest.raises(Exception):
        writers.replace_dataset(bad, path)
    assert [r.k for r in readers.read_parquet(spark, path).collect()] == ["a"]
    writers.replace_dataset(spark.createDataFrame([("b",)], "k string"), path)
    assert [r.k for r in readers.read_parquet(spark, path).collect()] == ["b"]
