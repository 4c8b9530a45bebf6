"""The mart kept up to date: dimensions with the fact, emptied months, partial sums by file."""

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from costmart import columns as C
from costmart.operators import checks, dims, fact
from costmart.plans import cli, jobs, mart
from costmart.session import scratch_path
from costmart.sinks import writers
from costmart.sources import readers
from costmart.streaming import incremental, partials
from cur_rows import make_cur

AS_OF = "2021-10-15"


def row(day, cost, sku="a", **more):
    return {
        "year": "2021", "month": str(day.month),
        C.BILLING_PERIOD_START: dt.datetime(day.year, day.month, 1),
        C.USAGE_START: dt.datetime(day.year, day.month, day.day, 3),
        C.UNBLENDED: Decimal(cost), "product_sku": sku, **more,
    }


def deliver(spark, path, rows, tags=("resource_tags_user_env", "resource_tags_user_team")):
    make_cur(spark, rows, list(tags)).coalesce(1).write.mode("append").partitionBy("year", "month").parquet(path)


def stored(spark, root, name="cost_insights_fact"):
    return readers.read_parquet(spark, f"{root}/{name}", merge_schema=True)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def orphans(spark, root):
    dim = {n: (stored(spark, root, n), k) for n, k in mart.DIMENSION_KEYS.items()}
    return {r.dim: r.orphan_rows for r in checks.orphan_counts(stored(spark, root), dim).collect()}


def assert_whole(spark, cur_path, root, months_back=7):
    """The stored mart is that of a whole recomputation."""
    cur = readers.read_parquet(spark, cur_path, merge_schema=True)
    assert same(fact.fact_direct(cur, as_of=AS_OF, months_back=months_back), stored(spark, root))
    assert same(dims.account_dim(cur), stored(spark, root, "account_dim"))
    assert same(dims.date_dim(cur), stored(spark, root, "date_dim"))
    assert set(orphans(spark, root).values()) == {0}


# ---------------------------------------------------------------- readers
def test_concurrent_reads_leave_the_settings_alone(spark):
    path = scratch_path(spark, "t-race")
    spark.createDataFrame([("2021", "09", 1)], "year string, month string, v int").write.partitionBy(
        "year", "month"
    ).parquet(path)
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    with ThreadPoolExecutor(8) as pool:
        types = list(pool.map(lambda _: dict(readers.read_parquet(spark, path).dtypes)["month"], range(40)))
    assert set(types) == {"string"} and spark.conf.get(key) == before
    assert readers.read_parquet(spark, path).collect()[0].month == "09"  # as written, not a number
    assert dict(spark.read.parquet(path).dtypes)["month"] == "int"


def test_reader_layouts(spark):
    flat, empty = scratch_path(spark, "t-flat"), scratch_path(spark, "t-empty")
    spark.range(3).write.parquet(flat)
    assert readers.read_parquet(spark, flat).columns == ["id"]
    spark.range(3).selectExpr("id", "'2021' as year", "id as month").write.partitionBy("year", "month").parquet(empty)
    readers.delete(spark, f"{empty}/year=2021/month=0")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(empty).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(f"{empty}/year=2021/month=0"))  # a folder without files comes first
    assert sorted(readers.read_parquet(spark, empty).select("month").collect()) == [("1",), ("2",)]


# ---------------------------------------------------------------- emptied months
def test_replace_months_removes_only_owned_months_without_rows(spark):
    path = scratch_path(spark, "t-owned")
    months = spark.createDataFrame([("2021", str(m), m) for m in (3, 8, 9, 10)], "year string, month string, v int")
    writers.write_partitioned(months, path)
    new = spark.createDataFrame([("2021", "9", 99)], "year string, month string, v int")
    assert writers.replace_months(new, path, lambda m: m >= (2021, 9)) == [(2021, 10)]
    got = {(r.month, r.v) for r in readers.read_parquet(spark, path).collect()}
    assert got == {("3", 3), ("8", 8), ("9", 99)}


def emptied(spark, path, month):
    """The month's file is replaced by one without rows."""
    folder = f"{path}/year=2021/month={month}"
    schema = readers.read_parquet(spark, path).drop("year", "month").schema
    readers.delete(spark, folder)
    spark.createDataFrame([], schema).coalesce(1).write.parquet(folder)


@pytest.mark.parametrize("how", ["window", "one month", "refresh", "partials"])
def test_emptied_month_is_gone(spark, how):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    deliver(spark, cur_path, [row(dt.date(2021, 9, 1), 1), row(dt.date(2021, 10, 1), 2)])
    args = ["--cur", cur_path, "--out", root, "--as-of", AS_OF]
    run = {
        "window": lambda: cli.main(args, spark),
        "one month": lambda: cli.main([*args, "--year", "2021", "--month", "10"], spark),
        "refresh": lambda: incremental.run_until_caught_up(spark, cur_path, "", f"{root}/s", AS_OF, mart_root=root),
        "partials": lambda: cli.main([*args, "--incremental"], spark),
    }[how]
    if how in ("window", "one month"):
        cli.main(args, spark)
    else:
        run()
    assert {r.month for r in stored(spark, root).collect()} == {"9", "10"}
    emptied(spark, cur_path, 10)
    run()
    assert {r.month for r in stored(spark, root).collect()} == {"9"}


def test_a_run_without_any_rows_changes_nothing(spark):
    cur = make_cur(spark, [row(dt.date(2021, 10, 1), 2)])
    root = scratch_path(spark, "t-mart")
    mart.write(mart.build(cur, as_of=AS_OF), root)
    mart.write(mart.build(cur.limit(0), as_of=AS_OF), root)
    jobs.run_fact_job(cur.limit(0), f"{root}/cost_insights_fact", as_of=AS_OF)
    assert stored(spark, root).count() == 1


# ---------------------------------------------------------------- dimensions follow
@pytest.mark.parametrize("how", ["refresh", "stream", "one month"])
def test_dimensions_follow_the_fact(spark, how):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    deliver(spark, cur_path, [row(dt.date(2021, 9, 1), 1)])
    mart.write(mart.build(readers.read_parquet(spark, cur_path), as_of=AS_OF), root)
    late = row(dt.date(2021, 10, 5), 2, **{C.USAGE_ACCOUNT: "acct-9", C.RESOURCE_ID: "i-9", "resource_tags_user_env": "x"})
    deliver(spark, cur_path, [late])
    if how == "refresh":
        incremental.run_until_caught_up(spark, cur_path, "", f"{root}/s", AS_OF, mart_root=root)
    elif how == "stream":
        incremental.start(spark, cur_path, "", f"{root}/s", AS_OF, mart_root=root).awaitTermination()
    else:
        cli.main(["--cur", cur_path, "--out", root, "--year", "2021", "--month", "10"], spark)
    assert orphans(spark, root) == {"tag_dim": 0, "resource_dim": 0, "account_dim": 0, "date_dim": 0}
    assert_whole(spark, cur_path, root)


def test_account_names_and_lookups_stay(spark):
    names = spark.createDataFrame([("acct-1", "one")], "account_id string, account_name string")
    root = scratch_path(spark, "t-mart")
    cur = make_cur(spark, [row(dt.date(2021, 9, 1), 1)])
    mart.write(mart.build(cur, as_of=AS_OF, accounts=names), root)
    more = make_cur(spark, [row(dt.date(2021, 10, 1), 1, **{C.USAGE_ACCOUNT: "acct-2"})])
    mart.refresh(spark, more, root, [("2021", "10")], AS_OF)
    got = {r[C.USAGE_ACCOUNT]: r.account_name for r in stored(spark, root, "account_dim").collect()}
    assert got == {"acct-1": "one", "acct-2": ""}


def files_of(spark, path):
    return {r.path for r in readers.list_files(spark, path).collect()}


def test_merge_keys_writes_only_what_differs(spark):
    path = scratch_path(spark, "t-merge")

    def merged(rows, schema="k string, v string"):
        writers.merge_keys(spark.createDataFrame(rows, schema), path, "k", absent="")
        return {tuple(r) for r in readers.read_parquet(spark, path, merge_schema=True).collect()}

    merged([("a", "1"), ("b", None)])
    first = files_of(spark, path)
    merged([("b", "")])
    second = files_of(spark, path)
    assert merged([("a", "1")]) == {("a", "1"), ("b", "")} and files_of(spark, path) == second  # nothing new
    assert merged([("c", "3")]) == {("a", "1"), ("b", ""), ("c", "3")} and second < files_of(spark, path)  # appended
    assert merged([("a", "9")]) == {("a", "9"), ("b", ""), ("c", "3")}  # changed: rewritten
    assert not second & files_of(spark, path) and first != second
    got = merged([("d", "4", "n")], "k string, v string, w string")  # a new column
    assert got == {("a", "9", ""), ("b", "", ""), ("c", "3", ""), ("d", "4", "n")}
    assert merged([("e", "5")]) == got | {("e", "5", "")}  # a side that lacks it


# ---------------------------------------------------------------- partial sums by file
def test_partials_after_add_rewrite_and_delete(spark):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")

    def run():
        return partials.refresh(spark, cur_path, root, as_of=AS_OF)

    deliver(spark, cur_path, [row(dt.date(2021, 9, 1), 1), row(dt.date(2021, 10, 2), 2, "b"), row(dt.date(2021, 1, 3), 9)])
    assert run() == [("2021", "10"), ("2021", "9")]  # January is outside the window
    assert_whole(spark, cur_path, root)
    assert run() == []

    deliver(spark, cur_path, [row(dt.date(2021, 10, 2), 5, "c", **{C.PAYER: "payer-2", C.USAGE_ACCOUNT: "acct-2"})])
    assert run() == [("2021", "10")]  # added: the same fact key grows
    assert_whole(spark, cur_path, root)

    readers.delete(spark, f"{cur_path}/year=2021/month=9")
    deliver(spark, cur_path, [row(dt.date(2021, 9, 7), 4, "d"), row(dt.date(2021, 9, 1), 3)])
    assert run() == [("2021", "9")]  # rewritten
    assert_whole(spark, cur_path, root)

    readers.delete(spark, f"{cur_path}/year=2021/month=10")
    assert run() == [("2021", "10")]  # removed, with its account
    assert_whole(spark, cur_path, root)
    assert {r.month for r in stored(spark, root).collect()} == {"9"}

    readers.delete(spark, f"{cur_path}/year=2021/month=1")
    assert run() == []  # outside the window; the days it gave are gone
    assert same(dims.date_dim(readers.read_parquet(spark, cur_path)), stored(spark, root, "date_dim"))


def test_partials_read_only_changed_files(spark, monkeypatch):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    read = []
    plain = partials.changed_rows

    def watched(*args):
        rows = plain(*args)
        read.append(set() if rows is None else {f.rsplit("/", 1)[-1] for f in rows.inputFiles()})
        return rows

    monkeypatch.setattr(partials, "changed_rows", watched)
    deliver(spark, cur_path, [row(dt.date(2021, 9, 1), 1), row(dt.date(2021, 10, 2), 2)])
    partials.refresh(spark, cur_path, root, as_of=AS_OF)
    first = {p.rsplit("/", 1)[-1] for p in files_of(spark, cur_path)}
    assert read[-1] == first
    deliver(spark, cur_path, [row(dt.date(2021, 10, 3), 4)])
    partials.refresh(spark, cur_path, root, as_of=AS_OF)
    assert len(read[-1]) == 1 and not read[-1] & first  # the late file alone, not its month
    assert_whole(spark, cur_path, root)


def test_partials_sum_a_long_history_some_months_at_a_time(spark, monkeypatch):
    """What a run shuffles at once is bounded; files of other columns or partly new months are summed all the same."""
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    summed, plain = [], fact.partial_sums

    def watched(rows, *args):
        summed.append({(r.year, r.month) for r in rows.select("year", "month").distinct().collect()})
        return plain(rows, *args)

    monkeypatch.setattr(fact, "partial_sums", watched)
    days = [dt.date(2021, 9, 1), dt.date(2021, 10, 1), dt.date(2021, 10, 2), dt.date(2021, 1, 3)]
    deliver(spark, cur_path, [row(d, i + 1) for i, d in enumerate(days)], tags=["resource_tags_user_env"])
    assert partials.refresh(spark, cur_path, root, as_of=AS_OF) == [("2021", "10"), ("2021", "9")]
    assert summed == [{("2021", "1"), ("2021", "9"), ("2021", "10")}]
    assert_whole(spark, cur_path, root)

    monkeypatch.setattr(partials, "SUMMED_BYTES", 1)
    summed.clear()
    deliver(spark, cur_path, [row(dt.date(2021, 8, 2), 3, "late"), row(dt.date(2021, 9, 2), 7, "late")])
    deliver(spark, cur_path, [row(dt.date(2021, 10, 2), 5, "late")], tags=["resource_tags_user_env"])
    assert len(partials.refresh(spark, cur_path, root, as_of=AS_OF)) == 3
    assert summed == [{("2021", "8")}, {("2021", "9")}, {("2021", "10")}]
    assert_whole(spark, cur_path, root)
    assert partials.refresh(spark, cur_path, root, as_of=AS_OF) == []


def test_partials_with_a_new_tag_column_and_new_rules(spark):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    deliver(spark, cur_path, [row(dt.date(2021, 9, 1), 1)], tags=["resource_tags_user_env"])
    partials.refresh(spark, cur_path, root, as_of=AS_OF)
    deliver(spark, cur_path, [row(dt.date(2021, 10, 1), 2)])
    # every key of the window changes with the columns, so September is derived again
    assert partials.refresh(spark, cur_path, root, as_of=AS_OF) == [("2021", "10"), ("2021", "9")]
    assert_whole(spark, cur_path, root)
    transfer = {C.SERVICE_NAME: "AWS Data Transfer", C.PRODUCT_CODE: "X"}
    deliver(spark, cur_path, [row(dt.date(2021, 10, 4), 2, **transfer)])
    partials.refresh(spark, cur_path, root, as_of=AS_OF)
    rules = spark.createDataFrame([("X", "Ex")], "rule_product_code string, rule_service_name string")
    assert len(partials.refresh(spark, cur_path, root, as_of=AS_OF, rules=rules)) == 2
    assert partials.refresh(spark, cur_path, root, as_of=AS_OF, rules=rules) == []
    cur = readers.read_parquet(spark, cur_path, merge_schema=True)
    assert same(fact.fact_direct(cur, as_of=AS_OF, rules=rules), stored(spark, root))


def test_partials_derive_older_months_when_asked(spark):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    deliver(spark, cur_path, [row(dt.date(2021, 1, 1), 1), row(dt.date(2021, 10, 1), 2)])
    assert partials.refresh(spark, cur_path, root, as_of=AS_OF) == [("2021", "10")]
    assert partials.refresh(spark, cur_path, root, months_back=None) == [("2021", "1")]
    assert_whole(spark, cur_path, root, months_back=None)
    assert partials.refresh(spark, cur_path, root, months_back=None) == []


def test_a_failed_run_is_repeated(spark, monkeypatch):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    deliver(spark, cur_path, [row(dt.date(2021, 10, 1), 2)])

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(partials, "_derive", broken)
        with pytest.raises(RuntimeError):
            partials.refresh(spark, cur_path, root, as_of=AS_OF)
    assert partials.refresh(spark, cur_path, root, as_of=AS_OF) == [("2021", "10")]
    assert_whole(spark, cur_path, root)  # the sums that the failed run left do not count
    assert len(readers.folders(spark, f"{root}/_partials/sums")) == 1


def test_compaction_keeps_the_sums(spark):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    for i in range(5):
        deliver(spark, cur_path, [row(dt.date(2021, 10, 1 + i), i + 1, f"s{i}", **{C.USAGE_ACCOUNT: f"acct-{i}"})])
        partials.refresh(spark, cur_path, root, as_of=AS_OF, compact_after=3)
        assert_whole(spark, cur_path, root)
    runs = {r.run for r in partials.stored_files(spark, root).collect()}
    assert len(runs) <= 3 and len(readers.folders(spark, f"{root}/_partials/sums")) == len(runs)


def test_files_without_rows_and_odd_paths(spark):
    cur_path, root = scratch_path(spark, "t cur %20"), scratch_path(spark, "t-mart")
    deliver(spark, cur_path, [row(dt.date(2021, 9, 1), 1), row(dt.date(2021, 10, 1), 2)])
    emptied(spark, cur_path, 10)
    partials.refresh(spark, cur_path, root, as_of=AS_OF)
    assert {r.month for r in stored(spark, root).collect()} == {"9"}
    deliver(spark, cur_path, [row(dt.date(2021, 10, 1), 7)])
    assert partials.refresh(spark, cur_path, root, as_of=AS_OF) == [("2021", "10")]
    assert_whole(spark, cur_path, root)


def test_incremental_cli_loads_the_warehouse(spark):
    cur_path, root = scratch_path(spark, "t-cur"), scratch_path(spark, "t-mart")
    db = f"t_inc_{uuid.uuid4().hex[:8]}"
    inst = f"{db}_inst"
    spark.createDataFrame(
        [("acct-1", "i-1", "10.0.0.1", [{"Key": "Name", "Value": "web"}])],
        "account_id string, instance_id string, private_ip string, tags array<struct<Key:string,Value:string>>",
    ).createOrReplaceTempView(inst)
    deliver(spark, cur_path, [row(dt.date(2021, 10, 1), 2)])
    args = ["--cur", cur_path, "--out", root, "--as-of", AS_OF, "--incremental", "--warehouse-db", db, "--instances", inst]
    cli.main(args, spark)
    assert "resource_name" not in spark.table(f"{db}.resource_dim").columns
    deliver(spark, cur_path, [row(dt.date(2021, 10, 2), 2)])
    cli.main([*args, "--with-name"], spark)  # a column that the table lacks
    assert spark.table(f"{db}.resource_dim").collect()[0].resource_name == "web"
    assert spark.table(f"{db}.cost_insights_fact").count() == 2
    with pytest.raises(SystemExit):
        cli.main([*args, "--year", "2021", "--month", "10"], spark)
