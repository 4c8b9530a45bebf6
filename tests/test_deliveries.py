"""A delivery holds the rows of the CUR, whatever wrote its files."""

from __future__ import annotations

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from costmart.plans import registry
from costmart.session import configure
from costmart.sources import deliveries
from costmart.sources import fixtures as FX

SHIPPED = [dt.datetime(2001, 8, 19), dt.datetime(2001, 8, 19, 12), dt.datetime(2001, 9, 3), None]


@pytest.fixture
def sf_dir(spark, tmp_path):
    configure(spark)
    rows = {
        "nation": [(0, "N0")],
        "customer": [(1, 0, "BUILDING"), (2, 0, None)],
        "orders": [(1, 1, 10.5, "1-URGENT"), (2, 2, None, "2-HIGH")],
        "part": [(p, f"part {p}", "TYPE", None if p == 2 else "B", p, 9.0) for p in range(1, 5)],
        # the same line twice, and one without a ship date
        "lineitem": [(o, p, 3, n, 2.0, None if p == 3 else 7.25, "R", "F", SHIPPED[p - 1])
                     for o, p, n in [(1, 1, 1), (1, 1, 1), (1, 2, 2), (2, 3, 3), (2, 4, 4)]],
    }
    schemas = {
        "nation": "n_nationkey int, n_name string",
        "customer": "c_custkey long, c_nationkey int, c_mktsegment string",
        "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string",
        "part": "p_partkey long, p_name string, p_type string, p_brand string, p_size int, p_retailprice double",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    }
    for name, data in rows.items():
        spark.createDataFrame(data, schemas[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("mounted", [True, False])
def test_a_delivery_holds_the_rows_of_the_cur(spark, sf_dir, monkeypatch, mounted):
    if not mounted:  # another file system: Spark's writer
        monkeypatch.setattr(deliveries, "_mounted", lambda spark, path: None)
    cut = "line_item_usage_start_date < TIMESTAMP '2001-08-20 00:00:00'"
    cur = FX.cur_from_tables(spark, sf_dir, by_month=True)
    assert cur.count() == 20
    for name, hour, expected in [("all", "true", cur), ("early", cut, cur.where(cut)), ("late", f"NOT ({cut})", cur.where(f"NOT ({cut})"))]:
        path = f"{sf_dir}/{name}"
        deliveries.append(FX.cur_items(spark, sf_dir, hour=hour), path)
        stored = spark.read.schema(cur.schema).parquet(path).select(*cur.columns)
        assert _sorted(stored) == _sorted(expected)
        # only the months that have rows, and nothing beside them
        folders = {f.removeprefix(path) for f in glob.glob(f"{path}/*/*") if "part-" not in f and "_SUCCESS" not in f}
        of = [F.coalesce(c, F.lit("__HIVE_DEFAULT_PARTITION__")) for c in ("year", "month")]
        assert folders == {f"/year={y}/month={m}" for y, m in expected.select(*of).distinct().collect()}
        assert not glob.glob(f"{path}/_delivery*")
    # a second delivery is added, the files' own columns have the types of the CUR
    deliveries.append(FX.cur_items(spark, sf_dir), f"{sf_dir}/all")
    again = spark.read.parquet(f"{sf_dir}/all/year=2001")
    assert spark.read.schema(cur.schema).parquet(f"{sf_dir}/all").count() == 40
    assert set(again.drop("month").dtypes) == set(cur.drop("year", "month").dtypes)


def test_groups_of_items_are_written_apart(spark, sf_dir, monkeypatch):
    """A month of more items than one row group holds loses and repeats none; settings are put back."""
    import pyarrow as pa

    items = FX.cur_items(spark, sf_dir).where("year is not null").drop("year", "month").toArrow()
    names = [n for n, _, _ in FX.CUR_EXPRESSIONS if n not in ("year", "month")]
    items = items.append_column("__folder", pa.array(["year=1/month=1"] * items.num_rows))
    monkeypatch.setattr(deliveries, "GROUP_ITEMS", 1)
    write = deliveries._writer(f"{sf_dir}/staged", names)
    [files] = write(iter(items.to_batches(max_chunksize=1)))
    [file] = files.column("file").to_pylist()
    import pyarrow.parquet as pq

    assert pq.ParquetFile(f"{sf_dir}/staged/{file}").num_row_groups == items.num_rows
    assert spark.read.parquet(f"{sf_dir}/staged/{file}").count() == 4 * items.num_rows


def test_settings_are_put_back_after_a_failure(spark, sf_dir):
    before = {k: spark.conf.get(k) for k in deliveries._CONF}
    bad = FX.cur_items(spark, sf_dir).withColumn("product_sku", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        deliveries.append(bad, f"{sf_dir}/bad")
    assert {k: spark.conf.get(k) for k in deliveries._CONF} == before
    assert not glob.glob(f"{sf_dir}/bad/*")


def test_columns_of_one_expression_reach_the_writer_once(spark, sf_dir):
    """A column with the values of another, or with one text, is neither evaluated nor sent to the writer."""
    items = FX.cur_items(spark, sf_dir).drop("year", "month")
    of, values = deliveries._sources(items)
    assert of["product_to_location"] == of["product_from_location"] == "product_region"
    assert values["product_tenancy"] == "Shared" and values["product_processor_features"] == ""
    rows = deliveries.expanded(items)
    for name, source in of.items():
        assert rows.where(~F.col(name).eqNullSafe(F.col(source))).isEmpty()
    for name, text in values.items():
        assert rows.where(~F.col(name).eqNullSafe(F.lit(text))).isEmpty()
    names = rows.columns
    sent = deliveries._expand(items.drop(*of, *values).toArrow(), names, of, values)
    own = deliveries._expand(items.toArrow(), names)
    assert sorted(map(repr, sent.to_pylist())) == sorted(map(repr, own.to_pylist()))


@pytest.mark.parametrize("name", ["product_region", "product_to_location", "product_tenancy"])
def test_a_replaced_column_is_no_copy(spark, sf_dir, name):
    items = FX.cur_items(spark, sf_dir).where("year is not null").withColumn(name, F.concat("line_item_product_code", F.lit("!")))
    expected = deliveries.expanded(items)
    deliveries.append(items, f"{sf_dir}/replaced")
    stored = spark.read.schema(expected.schema).parquet(f"{sf_dir}/replaced").select(*expected.columns)
    assert stored.where(~F.col(name).endswith("!")).isEmpty()
    assert _sorted(stored) == _sorted(expected)


def test_amounts_have_no_dictionary(spark, sf_dir):
    import pyarrow.parquet as pq

    deliveries.append(FX.cur_items(spark, sf_dir), f"{sf_dir}/cur")
    file = glob.glob(f"{sf_dir}/cur/year=2001/month=8/part-*")[0]
    group = pq.ParquetFile(file).metadata.row_group(0)
    columns = {c.path_in_schema: c for c in map(group.column, range(group.num_columns))}
    assert not columns["line_item_unblended_cost"].has_dictionary_page
    assert columns["line_item_resource_id"].has_dictionary_page
    assert columns["line_item_usage_start_date"].statistics.has_min_max


def test_a_long_history_is_dealt_in_groups_of_months(spark, sf_dir, monkeypatch):
    """No frame joins and deals more than the bound (or a month): what lies on the disk at once does not grow with the months."""
    cur = FX.cur_from_tables(spark, sf_dir)
    assert len(FX.cur_item_groups(spark, sf_dir)) == 1
    monkeypatch.setattr(FX, "DEALT_ITEMS", 2)
    frames = FX.cur_item_groups(spark, sf_dir)
    months = [{(r.year, r.month) for r in f.select("year", "month").distinct().collect()} for f in frames]
    assert months == [{(None, None)}, {("2001", "8")}, {("2001", "9")}]
    assert len(FX.cur_item_groups(spark, sf_dir, "l_shipdate is null or month(l_shipdate) = 9")) == 1
    deliveries.append(frames, f"{sf_dir}/grouped")
    assert _sorted(spark.read.schema(cur.schema).parquet(f"{sf_dir}/grouped").select(*cur.columns)) == _sorted(cur)


@pytest.mark.parametrize("mounted", [True, False])
def test_a_month_is_rewritten_in_place(spark, sf_dir, monkeypatch, mounted):
    """The months that a delivery holds are replaced, also those of several frames; the others keep their rows."""
    if not mounted:
        monkeypatch.setattr(deliveries, "_mounted", lambda spark, path: None)
    path, cur = f"{sf_dir}/cur", FX.cur_from_tables(spark, sf_dir)
    deliveries.append(FX.cur_items(spark, sf_dir), path)
    monkeypatch.setattr(FX, "DEALT_ITEMS", 1)
    late = FX.cur_item_groups(spark, sf_dir, "month(l_shipdate) = 9 OR l_shipdate IS NULL")
    assert len(late) == 2
    stored = lambda: spark.read.schema(cur.schema).parquet(path).select(*cur.columns)
    deliveries.append(late, path, replace=True)
    assert _sorted(stored()) == _sorted(cur)
    august = FX.cur_items(spark, sf_dir, hour="hour(line_item_usage_start_date) = 0").where("month = '8'")
    deliveries.append(august, path, replace=True)
    kept = cur.where("month is distinct from '8' or hour(line_item_usage_start_date) = 0")
    assert kept.count() < cur.count() and _sorted(stored()) == _sorted(kept)
    deliveries.append([august, *late], path)  # appended: what is there stays
    assert stored().count() == 2 * kept.count()


def test_the_first_days_of_a_month(spark, sf_dir):
    """No hour is lost with the line items that a delivery leaves out, wherever an item's hours pass midnight or a month."""
    times = [dt.datetime(2001, m, d, h) for m, d in [(1, 31), (2, 13), (2, 14), (2, 15), (2, 28)] for h in (0, 1, 5, 6, 11, 12, 18, 23)]
    of = FX.table(spark, sf_dir, "lineitem")
    items = [(1, 1, 3, i, 2.0, 7.25, "R", "F", t) for i, t in enumerate(times)]
    spark.createDataFrame(items, of.schema).write.mode("overwrite").parquet(f"{sf_dir}/lineitem.parquet")
    wanted = FX.cur_from_tables(spark, sf_dir).where(registry._FIRST_DAYS)
    frames = registry._item_groups(spark, sf_dir, registry._FIRST_DAYS_ITEMS, registry._FIRST_DAYS)
    rows = deliveries.expanded(frames[0])
    assert wanted.count() > 0 and _sorted(rows.select(*wanted.columns)) == _sorted(wanted)
