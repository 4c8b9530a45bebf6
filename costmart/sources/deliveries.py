"""Deliveries of the derived CUR: files appended to a year/month dataset.

The rows come as items (``fixtures.cur_items``): the hours of a line item lie in
one array beside the columns that they share (null where an hour is not delivered). Spark joins them, evaluates every
expression and deals them by month; each task then repeats the shared columns and
writes its files in Arrow, a column at a time, so that a text is hashed once per
item and not once per hour. Spark's own writer takes rows one value at a time.
Columns that are marked as the same expression (``SAME``) or as one text
(``VALUE``) are evaluated and sent to the writer once, or not at all.

A task writes to a hidden folder of the dataset; the driver moves the files of the
tasks that succeeded into their month folders, so a failed or repeated task leaves
nothing behind. This needs a folder that every executor sees as a path (a mount);
on other file systems Spark's writer appends the same rows.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOURS = "hours"
# Marks in a column's metadata, which a column put in its place no longer has:
SAME = "delivery.same"  # all columns of one mark hold the same values
VALUE = "delivery.value"  # the text that all rows hold
_FOLDER = "__folder"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a month
# The 47 columns make one method that the JVM would only interpret, so they are left to
# smaller ones; batches are bounded by their records, whose bytes need no count a row.
_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2**31 - 1)}
# line items of a month that are expanded and written together, as one row group
GROUP_ITEMS = 32768
# values of a column that the writer encodes at a time
WRITE_ROWS = 16384


def expanded(items: DataFrame) -> DataFrame:
    """The rows of ``items``, one per hour."""
    shared = [c for c in items.columns if c != HOURS]
    rows = items.select(*shared, F.explode(HOURS).alias(HOURS)).where(F.col(HOURS).isNotNull())
    return rows.select(*shared, f"{HOURS}.*")


def _sources(items: DataFrame) -> tuple[dict[str, str], dict[str, str]]:
    """(column -> the column that holds its values, column -> its one text) of the marked columns."""
    of, values, first = {}, {}, {}
    for field in items.schema.fields:
        if VALUE in field.metadata:
            values[field.name] = field.metadata[VALUE]
        elif SAME in field.metadata:
            source = first.setdefault(field.metadata[SAME], field.name)
            if source != field.name:
                of[field.name] = source
    return of, values


def _expand(items, names: list[str], of: dict[str, str] | None = None, values: dict[str, str] | None = None):
    """Arrow table of items -> table of their hours; a shared text is dictionary-encoded first."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    hours = pa.concat_arrays(items.column(HOURS).chunks)
    rows, each = pc.list_parent_indices(hours), hours.flatten()
    if each.null_count:
        rows, each = rows.filter(each.is_valid()), each.filter(each.is_valid())
    own = {f.name: i for i, f in enumerate(each.type)}
    fields = each.flatten()
    of, values, made = of or {}, values or {}, {}

    def column(name):
        if name in own:
            return fields[own[name]]
        if name in values:
            return pa.DictionaryArray.from_arrays(np.zeros(len(rows), "int32"), [values[name]])
        source = of.get(name, name)
        if source not in made:
            found = pa.concat_arrays(items.column(source).chunks)
            made[source] = (found.dictionary_encode() if pa.types.is_string(found.type) else found).take(rows)
        return made[source]

    return pa.table([column(n) for n in names], names=names)


def _is_text(kind) -> bool:
    import pyarrow as pa

    return pa.types.is_string(kind) or pa.types.is_dictionary(kind)


def _writer(staged: str, names: list[str], of: dict[str, str] | None = None, values: dict[str, str] | None = None):
    """Function for ``mapInArrow``: writes a task's items below ``staged``, returns its files."""

    def write(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        task, files, waiting = uuid.uuid4().hex, {}, {}

        def flush(folder):
            rows = _expand(pa.Table.from_batches(waiting.pop(folder)), names, of, values)
            if rows.num_rows == 0:
                return
            if folder not in files:
                os.makedirs(f"{staged}/{folder}", exist_ok=True)
                files[folder] = pq.ParquetWriter(
                    f"{staged}/{folder}/part-{task}.parquet", rows.schema, compression="zstd",
                    store_decimal_as_integer=True, store_schema=False,
                    # amounts differ from item to item: a dictionary of them is only given up again
                    use_dictionary=[f.name for f in rows.schema if _is_text(f.type)],
                    # a row group holds items in no order: only its times are worth a least and a largest value
                    write_statistics=[f.name for f in rows.schema if pa.types.is_temporal(f.type)],
                    write_batch_size=WRITE_ROWS,
                )
            files[folder].write_table(rows, row_group_size=rows.num_rows)

        try:
            for batch in batches:
                for folder in pc.unique(batch.column(_FOLDER)).to_pylist():
                    part = batch.filter(pc.equal(batch.column(_FOLDER), folder))
                    held = waiting.setdefault(folder, [])
                    held.append(part)
                    if sum(b.num_rows for b in held) >= GROUP_ITEMS:
                        flush(folder)
            for folder in list(waiting):
                flush(folder)
        finally:
            for file in files.values():
                file.close()
        yield pa.RecordBatch.from_pydict({"file": pa.array([f"{f}/part-{task}.parquet" for f in files], pa.string())})

    return write


def _mounted(spark: SparkSession, path: str) -> str | None:
    """``path`` as the executors' operating system knows it, None on other file systems."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hpath).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def append(
    items: DataFrame | list[DataFrame], path: str, by: tuple[str, ...] = ("year", "month"), replace: bool = False
) -> None:
    """Append the hours of ``items``, which are dealt by month, to the dataset at ``path``;
    with ``replace`` a month that gets rows loses those it held before, as a dynamic overwrite does.

    ``items`` may be frames of different months: the shuffle files of one go before those
    of the next are written, and the months of all come into the dataset together, last."""
    frames = [items] if isinstance(items, DataFrame) else items
    spark = frames[0].sparkSession
    root = _mounted(spark, path)
    if root is None:
        rows = functools.reduce(DataFrame.unionByName, map(expanded, frames))
        writer = rows.write.mode("overwrite" if replace else "append")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
        return
    staging = f"_delivery-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path
    fs = hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath(path))
    try:
        files = [f for frame in frames for f in _staged(frame, f"{root}/{staging}", by)]
        folders = sorted({f.rsplit("/", 1)[0] for f in files})
        held = [s.getPath() for f in folders if fs.exists(hpath(f"{path}/{f}")) for s in fs.listStatus(hpath(f"{path}/{f}"))]
        for folder in folders:
            fs.mkdirs(hpath(f"{path}/{folder}"))
        for file in files:
            if not fs.rename(hpath(f"{path}/{staging}/{file}"), hpath(f"{path}/{file}")):
                raise RuntimeError(f"could not move {file} into {path}")
        for old in held if replace else []:
            fs.delete(old, True)
    finally:
        fs.delete(hpath(f"{path}/{staging}"), True)


def _staged(items: DataFrame, staged: str, by: tuple[str, ...]) -> list[str]:
    """Write the hours of ``items`` below the folder ``staged``. Returns the files, by their path in it."""
    spark = items.sparkSession
    columns = expanded(items).columns
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c), F.lit(_NO_VALUE))) for c in by])
    of, values = _sources(items.drop(*by))
    dealt = items.withColumn(_FOLDER, folder).drop(*by, *of, *values)
    write = _writer(staged, [c for c in columns if c not in by], of, values)
    before = {k: spark.conf.get(k) for k in _CONF}
    try:
        for k, v in _CONF.items():
            spark.conf.set(k, v)
        return [file for (file,) in dealt.mapInArrow(write, "file string").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
