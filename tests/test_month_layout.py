"""The CUR dealt by month before its expansion, and the whole history read once by a mart build."""

import datetime as dt
from decimal import Decimal

from costmart import columns as C
from costmart.operators import dims
from costmart.plans import mart, registry
from costmart.session import scratch_path
from costmart.sinks import writers
from costmart.sources import fixtures as FX
from costmart.sources import readers
from cur_rows import make_cur


def tables(spark, undated=True):
    """Small tables of the test schema, line items on either side of months and of the early cut (some without a day)."""
    path = scratch_path(spark, "t-tables")
    days = [dt.datetime(2001, m, d, h) for m, d, h in [(1, 31, 7), (7, 31, 23), (8, 18, 0), (8, 19, 5), (8, 19, 6), (8, 20, 0), (9, 1, 0)]]
    ships = [*days, *([None] if undated else []), dt.datetime(2001, 8, 31, 12)]
    items = [
        (i % 4, i % 5, i % 3, i, float(i), None if i == 5 else i + 0.005, "R" if i % 2 else "A", "F", ship)
        for i, ship in enumerate(ships * 3)
    ]
    of = {
        "lineitem": (items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        # an order key that comes twice, one without its customer, a null key
        "orders": ([(0, 1, 10.1, "1-URGENT"), (1, 2, 1e6, "5-LOW"), (1, 1, 0.005, None), (2, 2, 3.0, "x"), (3, 9, 3.0, "x"), (None, 1, 4.0, "y")],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"),
        "customer": ([(1, 7, "BUILDING"), (2, 8, None), (2, 7, "MACHINERY")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": ([(7, "GERMANY"), (8, "INDIA")], "n_nationkey int, n_name string"),
        "part": ([(k, f"p{k}", "Brand#1", "TIN", k + 3, 900.125 + k) for k in (0, 1, 2, 3, 3)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    }
    for name, (rows, schema) in of.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def plain_cur(spark, path):
    """Every column by its expression over the joined tables, in the order of the SQL."""
    t = {n: FX.table(spark, path, n) for n in ("lineitem", "orders", "customer", "nation", "part")}
    for name, rows in t.items():
        rows.createOrReplaceTempView(f"t_layout_{name}")
    on = FX.CUR_JOIN_SQL.split("CROSS JOIN")[0]
    for name in t:
        on = on.replace(f"JOIN {name} ", f"JOIN t_layout_{name} ").replace(f"{name} JOIN", f"t_layout_{name} JOIN")
    columns = ", ".join(f"{e} AS {n}" for n, e, _ in FX.CUR_EXPRESSIONS)
    return spark.sql(f"SELECT {columns} FROM (SELECT *, explode(array(0, 1, 2, 3)) AS h FROM {on})")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_rows_by_month_are_the_plain_rows(spark):
    path = tables(spark)
    want = plain_cur(spark, path)
    assert want.count() > 60 and same(FX.cur_from_tables(spark, path), want)
    by_month = FX.cur_from_tables(spark, path, by_month=True)
    assert same(by_month, want)
    cut = "line_item_usage_start_date >= timestamp '2001-08-20 00:00:00'"
    late = registry._late_cur(by_month)
    assert not late.isEmpty() and same(late, want.where(cut))


def test_a_delivery_shuffles_line_items_and_not_the_expanded_rows(spark, monkeypatch):
    path, out = tables(spark, undated=False), scratch_path(spark, "t-cur")
    plans, written = [], writers.write_partitioned

    def watched(df, path, **kw):
        plans.append((df._jdf.queryExecution().optimizedPlan().toString(), kw.get("rebalance", True)))
        written(df, path, **kw)

    monkeypatch.setattr(writers, "write_partitioned", watched)
    registry.QUERIES["period_filter_padded"](spark, path)
    plan, rebalanced = plans[0]
    # read from the top: the expansion stands over the shuffle by month
    assert not rebalanced and plan.index("Generate explode") < plan.index("RebalancePartitions")
    registry._deliver(registry._early_cur(FX.cur_from_tables(spark, path, by_month=True)), out)
    assert same(readers.read_parquet(spark, out), registry._early_cur(plain_cur(spark, path)))


def test_a_mart_build_reads_the_history_once(spark):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    rows = [
        {"year": "2021", "month": str(m), C.USAGE_START: None if acct is None else dt.datetime(2021, m, 3, 5),
         C.USAGE_ACCOUNT: acct, C.UNBLENDED: Decimal(m)}
        for m, acct in [(2, "acct-1"), (9, "acct-2"), (9, "acct-2"), (10, None)]
    ]
    make_cur(spark, rows).write.parquet(cur_path)
    cur = spark.read.parquet(cur_path)
    accounts, days = ({tuple(r) for r in d.collect()} for d in (dims.account_dim(cur), dims.date_dim(cur)))
    built = mart.build(cur, as_of="2021-10-15")
    readers.delete(spark, cur_path)  # all that the outputs need is staged
    mart.write(built, root)
    assert {tuple(r) for r in readers.read_parquet(spark, f"{root}/account_dim").collect()} == accounts
    assert {tuple(r) for r in readers.read_parquet(spark, f"{root}/date_dim").collect()} == days
    assert len(accounts) == 3 and not readers.exists(spark, built.staging)
