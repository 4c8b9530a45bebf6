"""The stored summary view, and tag keys that do not depend on the tag columns."""

import datetime as dt
import hashlib
import itertools
import uuid
from decimal import Decimal

import pytest
from costmart import columns as C
from costmart import rules as R
from costmart.functions import keys
from costmart.operators import dims, fact, summary, summary_sql
from costmart.plans import cli, jobs, mart
from costmart.session import configure, scratch_path
from costmart.sinks import writers
from costmart.sources import readers
from cur_rows import make_cur
from pyspark.sql import functions as F

TAGS = ["resource_tags_user_env", "resource_tags_user_team"]


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def db(spark):
    name = f"t_view_{uuid.uuid4().hex[:8]}"
    writers.ensure_database(spark, name, scratch_path(spark, name))
    return name


def rows_of_all_kinds():
    kinds = ["Usage", "DiscountedUsage", "RIFee", "Fee", "SavingsPlanCoveredUsage", "SavingsPlanRecurringFee",
             "SavingsPlanUpfrontFee", "SavingsPlanNegation", "Tax", "EdpDiscount", None]
    names = [None, "", R.DATA_TRANSFER, "Other's"]
    codes = ["AmazonEC2", "AmazonGlacier", R.EMPTY_NAME_FEE_CODE, "Unknown"]
    out = []
    for i, (kind, raw, code) in enumerate(itertools.product(kinds, names, codes)):
        out.append({
            C.ITEM_TYPE: kind, C.SERVICE_NAME: raw, C.PRODUCT_CODE: code,
            C.RI_ARN: [None, "", "ri-1"][i % 3], C.SP_ARN: [None, "", "", "sp-1"][i % 4],
            C.USAGE_TYPE: ["EU-SpotUsage", "EU-Box", None][i % 3],
            C.DESCRIPTION: ["m5.large Linux/UNIX Spot", "nospace", None][i % 3],
            C.BILLING_ENTITY: [R.MARKETPLACE, "AWS", None][(i // 4) % 3],
            C.SERVICE_CODE: ["", "code", None][(i // 2) % 3], C.PRODUCT_NAME: [None, "p'n"][i % 2],
            C.RESOURCE_ID: [None, "i-1"][i % 2], "resource_tags_user_env": [None, "", "x"][i % 3],
            C.USAGE_AMOUNT: Decimal(i), C.UNBLENDED: Decimal(i * 3),
        })
    return out


def test_view_equals_the_summary(spark, db):
    make_cur(spark, rows_of_all_kinds()).write.partitionBy("year", "month").format("parquet").saveAsTable(f"{db}.cur")
    jobs.create_summary_view(spark, f"{db}.cur", f"{db}.v", as_of="2021-10-15")
    whole = summary.summary(spark.table(f"{db}.cur"), as_of="2021-10-15")
    other = configure(spark.newSession()).table(f"{db}.v")
    assert other.columns == whole.columns and dict(other.dtypes) == dict(whole.dtypes)
    assert same(whole, spark.table(f"{db}.v")) and whole.count() > 100
    # one aggregation, and the window prunes the table's partitions
    plan = spark.table(f"{db}.v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_view_follows_the_calendar_and_further_tags(spark, db):
    today = dt.datetime.now(dt.timezone.utc).date()

    def month(back):
        index = today.year * 12 + today.month - 1 - back
        return dt.datetime(index // 12, index % 12 + 1, 1)

    rows = [
        {C.YEAR: str(m.year), C.MONTH: str(m.month), C.BILLING_PERIOD_START: m, C.USAGE_START: m}
        for m in (month(0), month(7), month(8), month(20))
    ]
    make_cur(spark, rows, TAGS[:1]).write.format("parquet").saveAsTable(f"{db}.cur")
    text = jobs.create_summary_view(spark, f"{db}.cur", f"{db}.v")
    assert "current_date()" in text
    assert spark.table(f"{db}.v").count() == 2 and TAGS[1] not in spark.table(f"{db}.v").columns
    jobs.create_summary_view(spark, f"{db}.cur", f"{db}.v", months_back=8)
    assert spark.table(f"{db}.v").count() == 3
    jobs.create_summary_view(spark, f"{db}.cur", f"{db}.v", months_back=None)
    assert spark.table(f"{db}.v").count() == 4
    # the table gets a further tag; the view is replaced
    spark.sql(f"ALTER TABLE {db}.cur ADD COLUMNS ({TAGS[1]} STRING)")
    extra = make_cur(spark, rows[:1]).select(*spark.table(f"{db}.cur").columns)
    extra.write.mode("append").insertInto(f"{db}.cur")
    assert TAGS[1] not in spark.table(f"{db}.v").columns
    jobs.create_summary_view(spark, f"{db}.cur", f"{db}.v")
    found = {(r[TAGS[0]], r[TAGS[1]]) for r in configure(spark.newSession()).table(f"{db}.v").collect()}
    assert found == {("prod", ""), ("prod", "core")}


def test_view_with_odd_names_and_rules(spark, db):
    tag = "resource_tags_user_a b`c"
    cur = make_cur(spark, [{C.SERVICE_NAME: R.DATA_TRANSFER, C.PRODUCT_CODE: "It's"}], TAGS[:1])
    view = summary_sql.query_text("cur_odd", [TAGS[0], tag], as_of="2021-10-15", rules=[("It's", "a\\b")])
    cur.withColumn(tag, F.lit("v")).createOrReplaceTempView("cur_odd")
    got = spark.sql(view).collect()[0]
    assert got[tag] == "v" and got[C.SERVICE_NAME] == "a\\b"


def test_view_from_the_command_line(spark, db):
    cur = make_cur(spark, rows_of_all_kinds())
    cur.write.partitionBy("year", "month").format("parquet").saveAsTable(f"{db}.cur")
    out = scratch_path(spark, "t-mart")
    cli.main(["--cur", f"{db}.cur", "--out", out, "--as-of", "2021-10-15", "--summary-view", f"{db}.v"], spark)
    assert same(summary.summary(spark.table(f"{db}.cur"), as_of="2021-10-15"), spark.table(f"{db}.v"))
    with pytest.raises(SystemExit):
        cli.main(["--cur", "/a/path", "--out", out, "--summary-view", f"{db}.v"], spark)


# ---------------------------------------------------------------- tag keys
def plain_text(tags):
    def escaped(s):
        return "".join("\\" + c if c in "\\&=" else c for c in s)

    return "&".join(f"{escaped(n)}={escaped(v)}" for n, v in sorted(tags.items()) if v)


def test_tag_set_text_is_canonical(spark):
    values = [None, "", "a", "a&b", "a=b", "a\\", "\\&=", "ü"]
    names = ["resource_tags_user_b=&", "resource_tags_user_a"]
    rows = list(itertools.product(values, values))
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    got = df.select(*[F.col(f"`{n}`") for n in names], keys.tag_set_text(names).alias("t"), keys.tag_set_key(names).alias("k"))
    texts = {}
    for *v, t, k in got.collect():
        tags = {n: x or "" for n, x in zip(names, v)}
        assert t == plain_text(tags) and k == hashlib.sha256(t.encode()).hexdigest()
        assert texts.setdefault(t, tags) == tags  # different tags never share a text
    assert spark.range(1).select(keys.tag_set_text([]).alias("t")).first().t == ""


def test_same_tags_keep_one_row_when_a_column_appears(spark):
    root = scratch_path(spark, "t-mart")
    env = {"resource_tags_user_env": "x", "resource_tags_user_team": None}
    old = {C.YEAR: "2021", C.MONTH: "1", C.BILLING_PERIOD_START: dt.datetime(2021, 1, 1), C.USAGE_START: dt.datetime(2021, 1, 2)}
    mart.write(mart.build(make_cur(spark, [{**env, **old}], TAGS[:1]), as_of="2021-02-01"), root)
    mart.write(mart.build(make_cur(spark, [env]), as_of="2021-10-15"), root)
    stored = {n: readers.read_parquet(spark, f"{root}/{n}", merge_schema=True) for n in ("tag_dim", "tag_key_map", "tag_set_dim")}
    assert stored["tag_dim"].count() == 2  # the parity key changed with the columns
    assert stored["tag_set_dim"].count() == 1 and stored["tag_key_map"].count() == 2
    fact_rows = readers.read_parquet(spark, f"{root}/cost_insights_fact")
    sums = dims.by_tag_set(fact_rows, stored["tag_key_map"], ["unblended_cost"]).collect()
    assert [(r.tag_set_id, r.unblended_cost) for r in sums] == [
        (hashlib.sha256(b"resource_tags_user_env=x").hexdigest(), Decimal(20))
    ]


def test_a_mart_written_without_stable_keys_gets_them(spark):
    root = scratch_path(spark, "t-mart")
    early = fact.fact_wide_direct(make_cur(spark, [{}], TAGS[:1]), as_of="2021-10-15")
    writers.merge_keys(dims.tag_dim(early), f"{root}/tag_dim", dims.TAG_KEY, absent="")
    mart.write(mart.build(make_cur(spark, [{}]), as_of="2021-10-15"), root)
    ids = {r.tag_dim_id for r in readers.read_parquet(spark, f"{root}/tag_key_map").collect()}
    assert ids == {r.tag_dim_id for r in readers.read_parquet(spark, f"{root}/tag_dim", merge_schema=True).collect()}
    assert len(ids) == 2
