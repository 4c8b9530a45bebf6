"""Readers: parquet datasets (flat or year/month partitioned), catalog
tables and JDBC.

Partition values are read back as strings (``year``/``month`` are text in
the CUR and the fact; Spark would infer integers), so the rolling-window
and period predicates compare the same types they were written with and
still prune partitions. The reader gives the partition columns a schema of
its own; no session setting is touched, so readers may be created from
several threads of one session.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def _layout(spark: SparkSession, path: str) -> tuple[list[str], str]:
    """(partition columns, a folder of data files) of the dataset at ``path``.

    Goes down the first ``column=value`` folders that end in a data file: a few
    listings of one folder each, whatever the number of files.
    """
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def down(folder, columns):
        folders = []
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if not status.isDirectory():
                if not _hidden(name):
                    return columns, folder.toString()
            elif "=" in name and not _hidden(name):
                folders.append(status.getPath())
        for inner in folders:
            found = down(inner, [*columns, inner.getName().split("=", 1)[0]])
            if found is not None:
                return found
        return None

    if not fs.exists(hpath) or not fs.getFileStatus(hpath).isDirectory():
        return [], path
    return down(hpath, []) or ([], path)


def as_text(schema: StructType, columns: list[str]) -> StructType:
    """``schema`` with ``columns`` last, as strings."""
    found = StructType([f for f in schema.fields if f.name not in columns])
    for c in columns:
        found = found.add(c, StringType())
    return found


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A parquet dataset; partition columns as strings. ``merge_schema``
    unions the columns of files written with different schemas (a column
    absent from a file reads as NULL)."""
    columns, folder = _layout(spark, path)
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if not columns:
        return reader.parquet(path)
    schema = reader.parquet(path if merge_schema else folder).schema
    return spark.read.schema(as_text(schema, columns)).parquet(path)


def union_schema(spark: SparkSession, root: str) -> StructType:
    """The columns of all files under ``root`` (tag columns come and go over
    the months). Footers are read in a distributed job, data is not."""
    found = spark.read.option("mergeSchema", "true").parquet(root).schema
    return as_text(found, _layout(spark, root)[0])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, modificationTime, length, year, month) of the files under
    ``root``. The listing is Spark's own (distributed over folders where there
    are many); file contents are not read."""
    files = spark.read.format("binaryFile").load(root).select("path", "modificationTime", "length")
    # from the path, as text: a partition column would be read as a number
    of = {c: F.url_decode(F.regexp_extract("path", f"/{c}=([^/]*)/", 1)) for c in ("year", "month")}
    return files.withColumns(of)


def partition_dirs(spark: SparkSession, root: str) -> list[tuple[str, str, str]]:
    """(year, month, path) of the ``year=*/month=*`` directories under
    ``root``. Lists directories only (years x months entries), never the
    data files."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    if not fs.exists(base):
        return out
    for ys in fs.listStatus(base):
        yname = ys.getPath().getName()
        if not (ys.isDirectory() and yname.startswith("year=")):
            continue
        for ms in fs.listStatus(ys.getPath()):
            mname = ms.getPath().getName()
            if ms.isDirectory() and mname.startswith("month="):
                out.append((yname[5:], mname[6:], ms.getPath().toString()))
    return out


def month_number(year: str, month: str) -> tuple[int, int] | None:
    """The month as numbers ('09' and '9' are the same); None for anything else."""
    return (int(year), int(month)) if year.isdigit() and month.isdigit() else None


def folders(spark: SparkSession, path: str) -> list[str]:
    """The ``column=value`` folders in ``path`` (none where it does not exist)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    inner = [s.getPath() for s in fs.listStatus(hpath) if s.isDirectory()]
    return [p.toString() for p in inner if "=" in p.getName() and not _hidden(p.getName())]


def any_file(spark: SparkSession, folder: str) -> str | None:
    """A data file in ``folder`` itself, if it holds one."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(hpath):
        if not status.isDirectory() and not _hidden(status.getPath().getName()):
            return status.getPath().toString()
    return None


def read_months(
    spark: SparkSession,
    root: str,
    since: _dt.date | None = None,
    months: list[tuple[str, str]] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read only some month partitions of a year/month dataset: those on or
    after ``since`` and/or those in ``months``. Spark then lists the files
    of these directories only, instead of every file under ``root`` (the
    pruning of ``read_parquet`` + a filter happens after a full listing).
    The columns are those of ``schema``, or else the union of the columns of
    the files read. Returns an empty frame with the dataset's columns when
    nothing matches."""
    wanted = {(y, str(int(m))) for y, m in months} if months is not None else None
    paths = []
    for y, m, path in partition_dirs(spark, root):
        if since is not None and (int(y), int(m)) < (since.year, since.month):
            continue
        if wanted is not None and (y, str(int(m))) not in wanted:
            continue
        paths.append(path)
    if not paths:
        return spark.createDataFrame([], schema or union_schema(spark, root))
    reader = spark.read.option("basePath", root)
    if schema is None:
        found = reader.option("mergeSchema", "true").parquet(*paths).schema
        schema = as_text(found, _layout(spark, root)[0])
        reader = spark.read.option("basePath", root)
    return reader.schema(schema).parquet(*paths)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """A JDBC table. Without a partition column the read is one task; give
    ``partition_column`` (numeric/date) with bounds to split it."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 1))
        )
    return reader.load()


def delete(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` (Hadoop file system); False if absent."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)
