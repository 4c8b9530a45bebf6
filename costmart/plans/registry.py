"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every query reads the test tables of ``sf_dir`` (the CUR is derived from
lineitem, orders, customer, nation and part), so its work grows with them.
Money columns are cast to DECIMAL(38,2) on both sides so the value hashes
compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import dates
from ..operators import dims, enrich, fact, summary
from ..session import configure
from ..sources import deliveries
from ..sources import fixtures as FX
from ..testing import oracle as O

MONEY = "decimal(38,2)"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle_sql is not None:
            ORACLE[name] = oracle_sql
        return fn

    return deco


def money(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(MONEY) for c in cols if c in df.columns})


def _cur(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    configure(spark)
    return FX.cur_from_tables(spark, sf_dir, by_month)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.summary(_cur(spark, sf_dir), as_of=FX.AS_OF)


# ---------------------------------------------------------------- summary
@register("summary_view", O.with_view("SELECT * FROM v"))
def q_summary_view(spark, sf_dir):
    return money(_summary(spark, sf_dir), C.MEASURES)


# ------------------------------------------------------------------- fact
@register("cost_fact", O.with_fact("SELECT * FROM fact"))
def q_cost_fact(spark, sf_dir):
    return money(fact.fact(_summary(spark, sf_dir)), C.FACT_MEASURES)


@register("cost_fact_direct", O.with_fact("SELECT * FROM fact"))
def q_cost_fact_direct(spark, sf_dir):
    return money(fact.fact_direct(_cur(spark, sf_dir), as_of=FX.AS_OF), C.FACT_MEASURES)


@register("cost_fact_backfill", O.with_fact("SELECT * FROM fact", months_back=None))
def q_cost_fact_backfill(spark, sf_dir):
    """The fact over the whole history (rolling window off): how months
    older than the window are (re)built; the whole CUR is aggregated."""
    return money(fact.fact_direct(_cur(spark, sf_dir), months_back=None), C.FACT_MEASURES)


# --------------------------------------------------------- classification
def _label_counts(label: str, measure: str | None = None):
    def run(spark, sf_dir):
        aggs = [F.count(F.lit(1)).alias("view_rows")]
        if measure:
            aggs.append(F.sum(measure).cast(MONEY).alias(measure))
        return _summary(spark, sf_dir).groupBy(label).agg(*aggs)

    extra = f", CAST(sum({measure}) AS {O.MONEY}) AS {measure}" if measure else ""
    return run, O.with_view(f"SELECT {label}, count(*) AS view_rows{extra} FROM v GROUP BY {label}")


for _label, _measure in [
    ("charge_category", "usage_quantity"),
    ("purchase_option", "amortized_cost"),
    ("ri_sp_arn", None),
    ("service", "unblended_cost"),
]:
    _fn, _sql = _label_counts(_label, _measure)
    register(_label, _sql)(_fn)

_SPOT_KEYS = ["usage_type", "product_code", "charge_type", "item_description",
              "instance_type_family", "instance_type", "platform"]


@register(
    "spot_instance_attributes",
    O.with_view(f"SELECT {', '.join(_SPOT_KEYS)}, count(*) AS view_rows FROM v "
                f"WHERE usage_type LIKE '%Spot%' GROUP BY {', '.join(_SPOT_KEYS)}"),
)
def q_spot(spark, sf_dir):
    s = _summary(spark, sf_dir)
    return s.where(F.col("usage_type").contains("Spot")).groupBy(*_SPOT_KEYS).agg(
        F.count(F.lit(1)).alias("view_rows")
    )


@register(
    "service_name_rules",
    O.with_view("SELECT product_code, product_servicename, count(*) AS view_rows, "
                f"CAST(sum(unblended_cost) AS {O.MONEY}) AS unblended_cost "
                "FROM v GROUP BY product_code, product_servicename"),
)
def q_service_name_rules(spark, sf_dir):
    return _summary(spark, sf_dir).groupBy("product_code", C.SERVICE_NAME).agg(
        F.count(F.lit(1)).alias("view_rows"), F.sum("unblended_cost").cast(MONEY).alias("unblended_cost")
    )


@register(
    "service_name_case",
    O.with_view("SELECT product_code, product_servicename, count(*) AS view_rows "
                "FROM v GROUP BY product_code, product_servicename"),
)
def q_service_name_case(spark, sf_dir):
    """The service name derived with the inlined CASE chain instead of the
    lookup join."""
    s = summary.summary(_cur(spark, sf_dir), as_of=FX.AS_OF, service_names="case")
    return s.groupBy("product_code", C.SERVICE_NAME).agg(F.count(F.lit(1)).alias("view_rows"))


@register(
    "cost_measures",
    O.with_view("SELECT year, month, charge_type, "
                + ", ".join(f"CAST(sum({m}) AS {O.MONEY}) AS {m}" for m in O.MEASURES)
                + " FROM v GROUP BY year, month, charge_type"),
)
def q_cost_measures(spark, sf_dir):
    return _summary(spark, sf_dir).groupBy("year", "month", "charge_type").agg(
        *[F.sum(m).cast(MONEY).alias(m) for m in C.MEASURES]
    )


@register(
    "tag_normalization",
    O.with_view(f"SELECT {', '.join(O.TAGS)}, count(*) AS view_rows FROM v GROUP BY {', '.join(O.TAGS)}"),
)
def q_tag_normalization(spark, sf_dir):
    s = _summary(spark, sf_dir)
    tags = C.tag_columns(s)
    return s.groupBy(*tags).agg(F.count(F.lit(1)).alias("view_rows"))


@register(
    "rolling_window",
    f"WITH {O.cur_cte()} SELECT year, month, bill_billing_period_start_date AS billing_period, "
    f"count(*) AS line_items, CAST(sum(line_item_unblended_cost) AS {O.MONEY}) AS unblended_cost "
    f"FROM cur WHERE {O.window_predicate()} GROUP BY year, month, bill_billing_period_start_date",
)
def q_rolling_window(spark, sf_dir):
    rows = summary.windowed(_cur(spark, sf_dir), FX.AS_OF, dates.DEFAULT_MONTHS_BACK)
    return rows.groupBy("year", "month", F.col(C.BILLING_PERIOD_START).alias("billing_period")).agg(
        F.count(F.lit(1)).alias("line_items"), F.sum(C.UNBLENDED).cast(MONEY).alias("unblended_cost")
    )


# The window of today in a zone 5.5 hours ahead of UTC, long enough to hold months of the test data.
ZONE, ZONE_MONTHS = "Asia/Kolkata", 304
_ZONE_TODAY = "CAST((make_timestamp(epoch_us(now())) + INTERVAL 330 MINUTE) AS DATE)"


@register(
    "zone_window",
    f"WITH {O.cur_cte()}, t AS (SELECT year({_ZONE_TODAY}) * 12 + month({_ZONE_TODAY}) AS asked) "
    f"SELECT year, month, count(*) AS line_items, CAST(sum(line_item_unblended_cost) AS {O.MONEY}) AS unblended_cost "
    f"FROM cur, t WHERE asked - (year::INT * 12 + month::INT) <= {ZONE_MONTHS} GROUP BY year, month",
)
def q_zone_window(spark, sf_dir):
    """The rolling window that ends today in the billing team's zone (the default of a scheduled run)."""
    from . import jobs

    rows = summary.windowed(_cur(spark, sf_dir), jobs.today_in(ZONE), ZONE_MONTHS)
    return rows.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("line_items"), F.sum(C.UNBLENDED).cast(MONEY).alias("unblended_cost")
    )


# ------------------------------------------------------------- dimensions
@register(
    "tag_dim",
    O.with_view(f"SELECT DISTINCT {', '.join(O.TAGS)}, "
                f"sha256(concat_ws('||', {', '.join(O.TAGS)})) AS tag_dim_id FROM v"),
)
def q_tag_dim(spark, sf_dir):
    # distinct tags of the window's line items = those of the summary
    return dims.tag_dim(summary.line_items(_cur(spark, sf_dir), FX.AS_OF))


@register(
    "account_dim",
    f"WITH {O.cur_cte()} SELECT bill_payer_account_id, line_item_usage_account_id, "
    "line_item_usage_account_id AS aws_account_dim_id FROM cur "
    "GROUP BY bill_payer_account_id, line_item_usage_account_id",
)
def q_account_dim(spark, sf_dir):
    return dims.account_dim(_cur(spark, sf_dir))


@register(
    "date_dim",
    f"WITH {O.cur_cte()}, b AS (SELECT CAST(min(line_item_usage_start_date) AS DATE) AS lo, "
    "CAST(max(line_item_usage_start_date) AS DATE) AS hi FROM cur), "
    "d AS (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, "
    "INTERVAL 1 DAY)) AS d FROM b) "
    "SELECT strftime(d, '%Y%m%d') AS date_dim_id, strftime(d, '%d') AS day_attr, "
    "strftime(d, '%b') AS month_attr, strftime(d, '%Y') AS year_attr FROM d",
)
def q_date_dim(spark, sf_dir):
    return dims.date_dim(_cur(spark, sf_dir))


_RES = ", ".join(O.RESOURCE_DIM_COLUMNS)
_EC2_I = "product_servicename = 'Amazon Elastic Compute Cloud' AND resource_id LIKE '%i-%'"
_NAME_SQL = "coalesce(list_filter(i.tags, lambda x: x.Key = 'Name')[-1].Value, '')"


def _resource_sql(with_name: bool) -> str:
    name = f", CASE WHEN {_EC2_I} THEN {_NAME_SQL} END AS resource_name" if with_name else ""
    return O.with_view(
        f", inst AS ({FX.instances_sql()}), "
        f"ra AS (SELECT {_RES}, sha256(concat_ws('||', {_RES})) AS aws_product_dim_id, "
        f"regexp_extract(line_item_resource_id, '[^:]*$') AS resource_id FROM (SELECT DISTINCT {_RES} FROM v) r) "
        f"SELECT ra.*, CASE WHEN {_EC2_I} THEN coalesce(i.private_ip, '') END AS secondary_identifier{name} "
        "FROM ra LEFT JOIN inst i ON i.instance_id = ra.resource_id"
    )


@register("resource_dim", _resource_sql(False))
def q_resource_dim(spark, sf_dir):
    # one aggregation: distinct resource tuples of the window's line items
    return dims.resource_dim(summary.line_items(_cur(spark, sf_dir), FX.AS_OF), FX.instances_from_tables(spark, sf_dir))


@register("resource_name_tag", _resource_sql(True))
def q_resource_name_tag(spark, sf_dir):
    return dims.resource_dim(_summary(spark, sf_dir), FX.instances_from_tables(spark, sf_dir), with_name=True)


CROSS_ACCOUNTS = ["acct-1", "acct-2", "acct-3", "acct-12"]


@register(
    "cross_account_resource_dim",
    O.with_view(
        f", inst AS ({FX.instances_sql()}), "
        f"ca AS (SELECT DISTINCT {_RES}, linked_account_id FROM v WHERE linked_account_id IN "
        f"({', '.join(O.q(a) for a in CROSS_ACCOUNTS)}) AND line_item_operation = 'RunInstances'), "
        f"ra AS (SELECT *, sha256(concat_ws('||', {_RES})) AS aws_product_dim_id, "
        "regexp_extract(line_item_resource_id, '[^:]*$') AS resource_id FROM ca) "
        f"SELECT DISTINCT {', '.join('ra.' + c for c in O.RESOURCE_DIM_COLUMNS)}, ra.aws_product_dim_id, "
        f"ra.resource_id, CASE WHEN {_EC2_I} THEN coalesce(i.private_ip, '') END AS secondary_identifier, "
        f"CASE WHEN {_EC2_I} THEN {_NAME_SQL} END AS resource_name "
        "FROM ra LEFT JOIN inst i ON i.instance_id = ra.resource_id AND i.account_id = ra.linked_account_id"
    ),
)
def q_cross_account(spark, sf_dir):
    return dims.cross_account_resource_dim(
        _summary(spark, sf_dir), CROSS_ACCOUNTS, FX.instances_from_tables(spark, sf_dir)
    )


@register(
    "account_names",
    f"WITH {O.cur_cte()}, acc AS ({FX.accounts_sql()}), "
    "ad AS (SELECT DISTINCT bill_payer_account_id, line_item_usage_account_id FROM cur) "
    "SELECT bill_payer_account_id, line_item_usage_account_id, line_item_usage_account_id AS aws_account_dim_id, "
    "coalesce(acc.account_name, '') AS account_name FROM ad LEFT JOIN acc ON acc.account_id = ad.line_item_usage_account_id",
)
def q_account_names(spark, sf_dir):
    return enrich.account_names(dims.account_dim(_cur(spark, sf_dir)), FX.accounts_from_tables(spark, sf_dir))


_SNAP_SQL = (
    "CASE WHEN product_servicename = 'Amazon Elastic Compute Cloud' AND resource_id LIKE '%snap-%' "
    "THEN coalesce(s.restore_expiry, '') "
    "WHEN product_servicename = 'Amazon Elastic Compute Cloud' AND resource_id LIKE '%i-%' "
    "THEN coalesce(i.private_ip, '') END"
)


@register(
    "snapshot_enrichment",
    O.with_view(
        f", inst AS ({FX.instances_sql()}), snaps AS ({FX.snapshots_sql()}), "
        f"ra AS (SELECT {_RES}, sha256(concat_ws('||', {_RES})) AS aws_product_dim_id, "
        f"regexp_extract(line_item_resource_id, '[^:]*$') AS resource_id FROM (SELECT DISTINCT {_RES} FROM v) r) "
        f"SELECT ra.*, {_SNAP_SQL} AS secondary_identifier FROM ra "
        "LEFT JOIN inst i ON i.instance_id = ra.resource_id "
        "LEFT JOIN snaps s ON s.snapshot_id = str_split(ra.resource_id, '/')[2]"
    ),
)
def q_snapshot_enrichment(spark, sf_dir):
    """Secondary identifier as the older job intended: EC2 snapshot ids get
    the snapshot's restore expiry (checked first), instance ids the IP."""
    attrs = dims.resource_attributes(_summary(spark, sf_dir))
    return enrich.secondary_identifier(
        attrs, FX.instances_from_tables(spark, sf_dir), FX.snapshots_from_tables(spark, sf_dir)
    )


@register(
    "volume_enrichment",
    O.with_view(
        f", vols AS ({FX.volumes_sql()}), "
        f"ra AS (SELECT {_RES}, sha256(concat_ws('||', {_RES})) AS aws_product_dim_id, "
        f"regexp_extract(line_item_resource_id, '[^:]*$') AS resource_id FROM (SELECT DISTINCT {_RES} FROM v) r) "
        "SELECT ra.*, CASE WHEN resource_id LIKE '%vol-%' THEN coalesce(vo.volume_type, '') END AS volume_type "
        "FROM ra LEFT JOIN vols vo ON vo.volume_id = ra.resource_id"
    ),
)
def q_volume_enrichment(spark, sf_dir):
    attrs = dims.resource_attributes(_summary(spark, sf_dir))
    return enrich.volume_types(attrs, FX.volumes_from_tables(spark, sf_dir))


# ---------------------------------------------------------- period filter
PERIOD = ("2001", "9")


@register("period_filter", O.with_fact(f"SELECT * FROM fact WHERE year = '{PERIOD[0]}' AND month = '{PERIOD[1]}'"))
def q_period_filter(spark, sf_dir):
    """A one-month run: the CUR restricted to the (year, month) partition."""
    from . import jobs

    return money(jobs.fact_for_period(_cur(spark, sf_dir), *PERIOD), C.FACT_MEASURES)


@register(
    "summary_view_sql",
    O.with_view(
        "SELECT product_servicename, purchase_option, count(*) AS view_rows, "
        + ", ".join(f"CAST(sum({m}) AS {O.MONEY}) AS {m}" for m in ("amortized_cost", "public_cost"))
        + " FROM v GROUP BY product_servicename, purchase_option"
    ),
)
def q_summary_view_sql(spark, sf_dir):
    """SQL users: the summary registered as a temporary view, queried with
    spark.sql."""
    from . import jobs

    jobs.register_summary_view(spark, _cur(spark, sf_dir), as_of=FX.AS_OF, name="summary_view")
    return spark.sql(
        "SELECT product_servicename, purchase_option, count(*) AS view_rows, "
        f"CAST(sum(amortized_cost) AS {MONEY}) AS amortized_cost, CAST(sum(public_cost) AS {MONEY}) AS public_cost "
        "FROM summary_view GROUP BY product_servicename, purchase_option"
    )


# ------------------------------------------------------------------ sinks
# Each sink query writes data derived from the tables into a fresh folder
# under the shared checkpoint root, then returns what a reader sees.
EARLY_AS_OF = "2001-08-20"  # an earlier run, when the CUR held rows up to this day
EARLY_CUT = f"line_item_usage_start_date < TIMESTAMP '{EARLY_AS_OF} 00:00:00'"


def _early_cur(cur: DataFrame) -> DataFrame:
    return cur.where(F.col(C.USAGE_START) < F.lit(EARLY_AS_OF).cast("timestamp"))


def _early_cte() -> str:
    return f"cur1 AS (SELECT * FROM cur WHERE {EARLY_CUT})"


@register(
    "fact_partition_overwrite",
    # Months of the early run that the later run does not rewrite survive;
    # the early run saw those months whole, so the result equals the fact
    # over the early run's (wider) window.
    O.with_fact("SELECT * FROM fact", months_back=10),
)
def q_fact_partition_overwrite(spark, sf_dir):
    from ..session import scratch_path
    from ..sinks import writers
    from ..sources import readers

    cur = _cur(spark, sf_dir)
    path = scratch_path(spark, "fact")
    writers.write_partitioned(fact.fact_direct(_early_cur(cur), as_of=EARLY_AS_OF), path)
    writers.write_partitioned(fact.fact_direct(cur, as_of=FX.AS_OF), path)
    return money(readers.read_parquet(spark, path), C.FACT_MEASURES)


@register(
    "dim_append_new_keys",
    f"WITH {O.cur_cte()}, {_early_cte()}, {O.view_cte(EARLY_AS_OF, name='v1', source='cur1')}, "
    f"{O.view_cte()} SELECT DISTINCT * FROM ({O.tag_dim_select('v1')} UNION ALL {O.tag_dim_select('v')}) t",
)
def q_dim_append_new_keys(spark, sf_dir):
    from ..session import checkpoint_root, scratch_path
    from ..sinks import writers
    from ..sources import readers

    checkpoint_root(spark)
    cur = _cur(spark, sf_dir)
    path = scratch_path(spark, "tag_dim")
    writers.append_new_keys(dims.tag_dim(summary.summary(_early_cur(cur), as_of=EARLY_AS_OF)), path, dims.TAG_KEY)
    writers.append_new_keys(dims.tag_dim(summary.summary(cur, as_of=FX.AS_OF)), path, dims.TAG_KEY)
    return readers.read_parquet(spark, path)


_ENV = ["resource_tags_user_env"]


@register(
    "dim_schema_merge",
    f"WITH {O.cur_cte()}, {O.view_cte()} "
    f"SELECT resource_tags_user_env, CAST(NULL AS VARCHAR) AS resource_tags_user_team, tag_dim_id "
    f"FROM ({O.tag_dim_select('v', _ENV)}) a UNION ALL {O.tag_dim_select('v')}",
)
def q_dim_schema_merge(spark, sf_dir):
    from ..session import scratch_path
    from ..sinks import writers
    from ..sources import readers

    cur = _cur(spark, sf_dir)
    path = scratch_path(spark, "tag_dim_drift")
    # First load: only the env tag existed; later a team tag was added.
    writers.write_append(dims.tag_dim(summary.summary(cur.drop("resource_tags_user_team"), as_of=FX.AS_OF)), path)
    writers.write_append(dims.tag_dim(summary.summary(cur, as_of=FX.AS_OF)), path)
    return readers.read_parquet(spark, path, merge_schema=True)


def _scratch_db(spark, name: str) -> str:
    import uuid

    from ..session import scratch_path
    from ..sinks import writers

    db = f"costmart_{name}_{uuid.uuid4().hex[:8]}"
    writers.ensure_database(spark, db, scratch_path(spark, db))
    return db


@register("dim_swap", f"WITH {O.cur_cte()}, {O.view_cte()} {O.tag_dim_select('v')}")
def q_dim_swap(spark, sf_dir):
    from ..sinks import writers

    cur = _cur(spark, sf_dir)
    table = f"{_scratch_db(spark, 'swap')}.tag_dim"
    # The second load adds a column; the swap replaces the table definition.
    writers.swap_table(dims.tag_dim(summary.summary(cur.drop("resource_tags_user_team"), as_of=FX.AS_OF)), table)
    writers.swap_table(dims.tag_dim(summary.summary(cur, as_of=FX.AS_OF)), table)
    return spark.table(table)


@register("dim_truncate_load", f"WITH {O.cur_cte()} {O.account_dim_select('cur')}")
def q_dim_truncate_load(spark, sf_dir):
    from ..sinks import writers

    cur = _cur(spark, sf_dir)
    table = f"{_scratch_db(spark, 'load')}.account_dim"
    dims.account_dim(_early_cur(cur)).write.format("parquet").saveAsTable(table)
    writers.truncate_load(dims.account_dim(cur), table)
    return spark.table(table)


@register("write_if_any", f"WITH {O.cur_cte()} {O.account_dim_select('cur')}")
def q_write_if_any(spark, sf_dir):
    from ..session import checkpoint_root, scratch_path
    from ..sinks import writers
    from ..sources import readers

    checkpoint_root(spark)
    cur = _cur(spark, sf_dir)
    path = scratch_path(spark, "account_dim")
    writers.write_if_any(dims.account_dim(cur), lambda d: writers.write_overwrite(d, path))
    # A run over a period without line items must leave the stored rows alone.
    later = cur.where(F.col(C.USAGE_START) >= F.lit("2030-01-01").cast("timestamp"))
    writers.write_if_any(dims.account_dim(later), lambda d: writers.write_overwrite(d, path))
    return readers.read_parquet(spark, path)


@register(
    "warehouse_load",
    O.with_fact(
        "SELECT aws_account_dim_id, date_dim_id, charge_type, purchase_option, charge_category, product_code, "
        + ", ".join(O.FACT_MEASURES)
        + ", tag_dim_id, aws_product_dim_id FROM fact",
        months_back=10,
    ),
)
def q_warehouse_load(spark, sf_dir):
    """Two mart runs (an early one and the current one) written to the same
    root, then loaded into catalog tables; the loaded fact holds every stored
    month without the partition columns."""
    from ..session import scratch_path
    from . import mart, warehouse

    cur = _cur(spark, sf_dir)
    root = scratch_path(spark, "mart")
    mart.write(mart.build(_early_cur(cur), as_of=EARLY_AS_OF), root)
    mart.write(mart.build(cur, as_of=FX.AS_OF), root)
    db = _scratch_db(spark, "dw")
    warehouse.load(spark, root, db)  # first load creates the tables
    tables = warehouse.load(spark, root, db)  # second load: swap + truncate-and-load
    return money(spark.table(tables["cost_insights_fact"]), C.FACT_MEASURES)


# ----------------------------------------------------------------- checks
def _mart_frames(spark, sf_dir):
    cur = _cur(spark, sf_dir)
    s = summary.summary(cur, as_of=FX.AS_OF)
    f = fact.fact_direct(cur, as_of=FX.AS_OF)
    return cur, s, f


_KEY_STATS_SQL = (
    "SELECT '{dim}' AS dim, CAST(sum(n) AS BIGINT) AS dim_rows, count(*) AS distinct_keys, "
    "CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicated_keys "
    "FROM (SELECT {key}, count(*) AS n FROM ({body}) d GROUP BY {key}) k"
)


@register(
    "dim_key_uniqueness",
    O.with_view(
        ", inst AS (" + FX.instances_sql() + ") "
        + " UNION ALL ".join(
            [
                _KEY_STATS_SQL.format(dim="tag_dim", key="tag_dim_id", body=O.tag_dim_select("v")),
                _KEY_STATS_SQL.format(
                    dim="resource_dim",
                    key="aws_product_dim_id",
                    body=f"SELECT DISTINCT {_RES}, sha256(concat_ws('||', {_RES})) AS aws_product_dim_id FROM v",
                ),
                _KEY_STATS_SQL.format(dim="account_dim", key="aws_account_dim_id", body=O.account_dim_select("cur")),
            ]
        )
    ),
)
def q_dim_key_uniqueness(spark, sf_dir):
    from ..operators import checks

    cur, s, _ = _mart_frames(spark, sf_dir)
    parts = [
        checks.key_stats("tag_dim", dims.tag_dim(s), dims.TAG_KEY),
        checks.key_stats("resource_dim", dims.resource_dim(s, FX.instances_from_tables(spark, sf_dir)), dims.RESOURCE_KEY),
        checks.key_stats("account_dim", dims.account_dim(cur), dims.ACCOUNT_KEY),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register(
    "resource_key_collisions",
    O.with_view(
        "SELECT CAST(sum(n) AS BIGINT) AS distinct_tuples, count(*) AS distinct_keys, "
        "CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS colliding_keys "
        f"FROM (SELECT aws_product_dim_id, count(*) AS n FROM (SELECT DISTINCT {_RES}, "
        f"sha256(concat_ws('||', {_RES})) AS aws_product_dim_id FROM v) d GROUP BY aws_product_dim_id) k"
    ),
)
def q_resource_key_collisions(spark, sf_dir):
    """Resource keys against attribute tuples: the key text skips NULLs, so
    different tuples could share a key; ``colliding_keys`` counts those."""
    from ..operators import checks

    attrs = dims.resource_attributes(summary.line_items(_cur(spark, sf_dir), FX.AS_OF))
    return checks.key_tuple_stats(attrs, dims.RESOURCE_KEY, C.RESOURCE_DIM_COLUMNS)


_ORPHAN_SQL = "SELECT '{dim}' AS dim, count(*) AS orphan_rows FROM fact WHERE {key} NOT IN (SELECT {key} FROM ({body}) d)"


@register(
    "orphan_fact_keys",
    O.with_fact(
        " UNION ALL ".join(
            [
                _ORPHAN_SQL.format(dim="tag_dim", key="tag_dim_id", body=O.tag_dim_select("v")),
                _ORPHAN_SQL.format(
                    dim="resource_dim",
                    key="aws_product_dim_id",
                    body=f"SELECT sha256(concat_ws('||', {_RES})) AS aws_product_dim_id FROM v",
                ),
                _ORPHAN_SQL.format(dim="account_dim", key="aws_account_dim_id", body=O.account_dim_select("cur")),
                _ORPHAN_SQL.format(
                    dim="date_dim",
                    key="date_dim_id",
                    body="SELECT strftime(CAST(line_item_usage_start_date AS DATE), '%Y%m%d') AS date_dim_id FROM cur",
                ),
            ]
        )
    ),
)
def q_orphan_fact_keys(spark, sf_dir):
    from ..operators import checks

    cur, s, f = _mart_frames(spark, sf_dir)
    pairs = [
        ("tag_dim", dims.tag_dim(s), dims.TAG_KEY),
        ("resource_dim", dims.resource_attributes(s), dims.RESOURCE_KEY),
        ("account_dim", dims.account_dim(cur), dims.ACCOUNT_KEY),
        ("date_dim", dims.date_dim(cur), dims.DATE_KEY),
    ]
    out = None
    for name, dim, key in pairs:
        part = checks.orphan_keys(f, dim, key).agg(
            F.coalesce(F.sum("fact_rows"), F.lit(0)).alias("orphan_rows")
        ).select(F.lit(name).alias("dim"), "orphan_rows")
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "measure_reconciliation",
    O.with_fact(
        "SELECT 'line_items' AS level, "
        + ", ".join(f"CAST(sum(m_{m}) AS {O.MONEY}) AS {m}" for m in O.FACT_MEASURES)
        + " FROM (SELECT "
        + ", ".join(f"{e} AS m_{m}" for m, e in O.MEASURES_SQL if m in O.FACT_MEASURES)
        + f" FROM cur WHERE {O.window_predicate()}) w UNION ALL "
        + "SELECT 'summary' AS level, "
        + ", ".join(f"CAST(sum({m}) AS {O.MONEY}) AS {m}" for m in O.FACT_MEASURES)
        + " FROM v UNION ALL SELECT 'fact' AS level, "
        + ", ".join(f"CAST(sum({m}) AS {O.MONEY}) AS {m}" for m in O.FACT_MEASURES)
        + " FROM fact"
    ),
)
def q_measure_reconciliation(spark, sf_dir):
    from ..operators import checks

    cur, s, f = _mart_frames(spark, sf_dir)
    windowed = summary.windowed(cur, FX.AS_OF, dates.DEFAULT_MONTHS_BACK)
    return money(checks.reconciliation(windowed, s, f), C.FACT_MEASURES)


# -------------------------------------------------------------- streaming
@register("incremental_fact_stream", O.with_fact("SELECT * FROM fact"))
def q_incremental_fact_stream(spark, sf_dir):
    """The CUR arrives in two deliveries (rows before and from the early
    cut-off day); after each, the stream refreshes the touched months. The
    final fact equals the batch fact over the whole CUR."""
    from ..session import scratch_path
    from ..sources import readers
    from ..streaming import incremental

    root = scratch_path(spark, "stream")
    cur_path, fact_path, ckpt = f"{root}/cur", f"{root}/fact", f"{root}/_checkpoint"
    deliveries.append(_early_items(spark, sf_dir), cur_path)
    incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of=FX.AS_OF)
    deliveries.append(_late_items(spark, sf_dir), cur_path)
    incremental.run_until_caught_up(spark, cur_path, fact_path, ckpt, as_of=FX.AS_OF)
    return money(readers.read_parquet(spark, fact_path), C.FACT_MEASURES)


# ------------------------------------------------- drift, re-runs, rewrites
_DRIFT_CUT = "CAST(month AS INT) >= 8"  # months before August lack the team tag


@register(
    "tag_drift_fact",
    # an absent tag counts as '' in the fact's key
    O.with_fact("SELECT * FROM fact").replace(
        "cur AS (\n",
        "cur AS (SELECT * REPLACE (CASE WHEN " + _DRIFT_CUT + " THEN resource_tags_user_team END "
        "AS resource_tags_user_team) FROM (\n",
        1,
    ).replace("\n),\nv AS (", "\n)),\nv AS (", 1),
)
def q_tag_drift_fact(spark, sf_dir):
    """A CUR whose early months lack one tag column, read back with the union of columns."""
    from ..session import scratch_path
    from ..sinks import writers
    from . import jobs

    cur = _cur(spark, sf_dir, by_month=True)
    path = scratch_path(spark, "drift")
    late = F.expr(_DRIFT_CUT)
    writers.write_partitioned(cur.where(late), path, rebalance=False)
    writers.write_partitioned(cur.where(~late).drop("resource_tags_user_team"), path, rebalance=False)
    window = jobs.read_cur_window(spark, path, FX.AS_OF)
    return money(fact.fact_direct(window, as_of=FX.AS_OF), C.FACT_MEASURES)


@register(
    "period_filter_padded",
    O.with_fact(f"SELECT * FROM fact WHERE year = '{PERIOD[0]}' AND month = '{PERIOD[1]}'", months_back=None),
)
def q_period_filter_padded(spark, sf_dir):
    """A CUR with zero-padded month folders, asked for the unpadded month."""
    from ..session import scratch_path
    from ..sinks import writers
    from . import jobs

    path = scratch_path(spark, "padded")
    cur = _cur(spark, sf_dir, by_month=True)
    writers.write_partitioned(cur.withColumn("month", F.lpad("month", 2, "0")), path, rebalance=False)
    rows = jobs.fact_for_period(jobs.read_cur_month(spark, path, *PERIOD), *PERIOD)
    return money(rows.withColumn("month", F.col("month").cast("int").cast("string")), C.FACT_MEASURES)


@register(
    "stored_mart_orphans",
    "SELECT * FROM (VALUES ('account_dim', 0), ('date_dim', 0), ('resource_dim', 0), ('tag_dim', 0)) "
    "AS t(dim, orphan_rows)",
)
def q_stored_mart_orphans(spark, sf_dir):
    """Two runs to one root: no stored fact row lacks its row in a stored dimension."""
    from ..operators import checks
    from ..session import scratch_path
    from ..sources import readers
    from . import mart

    cur, root = _cur(spark, sf_dir), scratch_path(spark, "mart")
    mart.write(mart.build(_early_cur(cur), as_of=EARLY_AS_OF, history=cur), root)
    mart.write(mart.build(cur, as_of=FX.AS_OF), root)
    stored = {n: readers.read_parquet(spark, f"{root}/{n}", merge_schema=True) for n in mart.DIMENSION_KEYS}
    return checks.orphan_counts(
        readers.read_parquet(spark, f"{root}/cost_insights_fact"),
        {n: (stored[n], k) for n, k in mart.DIMENSION_KEYS.items()},
    )


_FIRST_DAYS = "day(line_item_usage_start_date) < 15"
# an item's hours begin within 18 of its ship date: its first or its last one is before the 15th, or none
_FIRST_DAYS_ITEMS = "day(l_shipdate) < 15 OR day(l_shipdate + interval '18' hour) < 15"


@register(
    "incremental_rewritten_file",
    O.with_fact("SELECT * FROM fact"),
)
def q_incremental_rewritten_file(spark, sf_dir):
    """A month first delivered without its later days, then rewritten in place: the second run refreshes it."""
    from ..session import scratch_path
    from ..sources import readers
    from ..streaming import incremental

    cur_path, fact_path, state = (scratch_path(spark, n) for n in ("cur", "fact", "state"))
    deliveries.append(_item_groups(spark, sf_dir, _FIRST_DAYS_ITEMS, _FIRST_DAYS), cur_path)
    incremental.run_until_caught_up(spark, cur_path, fact_path, state, as_of=FX.AS_OF)
    deliveries.append(_item_groups(spark, sf_dir), cur_path, replace=True)
    incremental.run_until_caught_up(spark, cur_path, fact_path, state, as_of=FX.AS_OF)
    return money(readers.read_parquet(spark, fact_path), C.FACT_MEASURES)


# ------------------------------------------------- the mart kept up to date
def _deliver(rows: DataFrame, path: str) -> None:
    """Append ``rows``, which are dealt by month, to the CUR dataset at ``path``."""
    rows.write.mode("append").partitionBy("year", "month").parquet(path)


def _late_cur(cur: DataFrame) -> DataFrame:
    cut = F.lit(EARLY_AS_OF).cast("timestamp")
    # An item's hours lie within a day of its ship date, so its billing period
    # starts no earlier than that of the day before: known before the expansion.
    billed = F.col(C.BILLING_PERIOD_START) >= F.date_trunc("month", cut - F.expr("interval 1 day"))
    return cur.where(billed).where(F.col(C.USAGE_START) >= cut)


def _items(spark: SparkSession, sf_dir: str, only: str = "true", hour: str = "true") -> DataFrame:
    configure(spark)
    return FX.cur_items(spark, sf_dir, only, hour)


def _item_groups(spark: SparkSession, sf_dir: str, only: str = "true", hour: str = "true") -> list[DataFrame]:
    """The same in frames of a bounded number of line items each."""
    configure(spark)
    return FX.cur_item_groups(spark, sf_dir, only, hour)


# The line items of ``_early_cur``: an item's first hour is that of its ship date ...
_EARLY_ITEMS = f"l_shipdate < TIMESTAMP '{EARLY_AS_OF} 00:00:00'"
# ... and of ``_late_cur``: an item's hours lie within a day of its ship date.
_LATE_ITEMS = f"l_shipdate > TIMESTAMP '{EARLY_AS_OF} 00:00:00' - interval 1 day"


def _early_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items and hours of ``_early_cur``."""
    return _items(spark, sf_dir, _EARLY_ITEMS, EARLY_CUT)


def _late_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items and hours of ``_late_cur``."""
    return _items(spark, sf_dir, _LATE_ITEMS, f"NOT ({EARLY_CUT})")


def _two_deliveries(spark, sf_dir) -> str:
    """A mart built from the early delivery and brought up to date after the rest came. Returns its root."""
    from ..session import scratch_path
    from ..sources import readers
    from ..streaming import incremental
    from . import mart

    cur_path, root, state = (scratch_path(spark, n) for n in ("cur", "mart", "state"))
    instances = FX.instances_from_tables(spark, sf_dir)
    deliveries.append(_early_items(spark, sf_dir), cur_path)
    mart.write(mart.build(readers.read_parquet(spark, cur_path), as_of=FX.AS_OF, instances=instances), root)
    deliveries.append(_late_items(spark, sf_dir), cur_path)
    incremental.run_until_caught_up(
        spark, cur_path, "", state, as_of=FX.AS_OF, mart_root=root, lookups={"instances": instances}
    )
    return root


@register("incremental_mart_orphans", ORACLE["stored_mart_orphans"])
def q_incremental_mart_orphans(spark, sf_dir):
    """After a late delivery no fact row lacks its row in any dimension."""
    from ..operators import checks
    from ..sources import readers
    from . import mart

    root = _two_deliveries(spark, sf_dir)
    stored = {n: readers.read_parquet(spark, f"{root}/{n}", merge_schema=True) for n in mart.DIMENSION_KEYS}
    return checks.orphan_counts(
        readers.read_parquet(spark, f"{root}/cost_insights_fact"),
        {n: (stored[n], k) for n, k in mart.DIMENSION_KEYS.items()},
    )


@register("incremental_resource_dim", _resource_sql(False))
def q_incremental_resource_dim(spark, sf_dir):
    """The stored resource dimension after a late delivery, lookups included."""
    from ..sources import readers

    return readers.read_parquet(spark, f"{_two_deliveries(spark, sf_dir)}/resource_dim", merge_schema=True)


@register("emptied_month", O.with_fact("SELECT * FROM fact WHERE NOT (year = '2001' AND month = '10')"))
def q_emptied_month(spark, sf_dir):
    """A month rewritten to a file without rows leaves the stored fact."""
    from ..session import scratch_path
    from ..sources import readers
    from ..streaming import incremental

    cur_path, fact_path, state = (scratch_path(spark, n) for n in ("cur", "fact", "state"))
    items = _items(spark, sf_dir)
    deliveries.append(items, cur_path)
    incremental.run_until_caught_up(spark, cur_path, fact_path, state, as_of=FX.AS_OF)
    folder = f"{cur_path}/year=2001/month=10"
    readers.delete(spark, folder)
    spark.createDataFrame([], deliveries.expanded(items).drop("year", "month").schema).coalesce(1).write.parquet(folder)
    incremental.run_until_caught_up(spark, cur_path, fact_path, state, as_of=FX.AS_OF)
    return money(readers.read_parquet(spark, fact_path), C.FACT_MEASURES)


def _partials_mart(spark, sf_dir) -> str:
    """A mart kept by partial sums over files that are added, rewritten and removed. Returns its root."""
    from ..session import scratch_path
    from ..sources import readers
    from ..streaming import partials

    cur_path, root = scratch_path(spark, "cur"), scratch_path(spark, "mart")

    def refresh():
        partials.refresh(spark, cur_path, root, as_of=FX.AS_OF)

    hour = f"({EARLY_CUT}) AND NOT (year = '2001' AND month = '7' AND day(line_item_usage_start_date) > 9)"
    deliveries.append(_item_groups(spark, sf_dir, _EARLY_ITEMS, hour), cur_path)
    refresh()
    # added files, some of them in a month that is stored
    deliveries.append(_item_groups(spark, sf_dir, _LATE_ITEMS, f"NOT ({EARLY_CUT})"), cur_path)
    refresh()
    readers.delete(spark, f"{cur_path}/year=2001/month=7")  # rewritten with its later days
    deliveries.append(_items(spark, sf_dir, "year(l_shipdate) = 2001 AND month(l_shipdate) = 7"), cur_path)
    readers.delete(spark, f"{cur_path}/year=2001/month=11")  # removed
    refresh()
    return root


_REMOVED = "NOT (year = '2001' AND month = '11')"


@register("partials_fact", O.with_fact(f"SELECT * FROM fact WHERE {_REMOVED}"))
def q_partials_fact(spark, sf_dir):
    """The fact added up from the partial sums of changed files equals a recomputation."""
    from ..sources import readers

    return money(readers.read_parquet(spark, f"{_partials_mart(spark, sf_dir)}/cost_insights_fact"), C.FACT_MEASURES)


@register(
    "partials_whole_history",
    f"WITH {O.cur_cte()}, c AS (SELECT * FROM cur WHERE {_REMOVED}), "
    "b AS (SELECT CAST(min(line_item_usage_start_date) AS DATE) AS lo, "
    "CAST(max(line_item_usage_start_date) AS DATE) AS hi FROM c), "
    "d AS (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, "
    "INTERVAL 1 DAY)) AS d FROM b) "
    "SELECT 'date_dim' AS dim, strftime(d, '%Y%m%d') AS key, strftime(d, '%b') AS detail FROM d UNION ALL "
    "SELECT DISTINCT 'account_dim' AS dim, line_item_usage_account_id AS key, bill_payer_account_id AS detail FROM c",
)
def q_partials_whole_history(spark, sf_dir):
    """Account and date dimension of the whole history, kept from per-file accounts and day bounds."""
    from ..sources import readers

    root = _partials_mart(spark, sf_dir)
    days = readers.read_parquet(spark, f"{root}/date_dim")
    accounts = readers.read_parquet(spark, f"{root}/account_dim")
    return days.select(F.lit("date_dim").alias("dim"), F.col(dims.DATE_KEY).alias("key"), F.col("month_attr").alias("detail")).union(
        accounts.select(F.lit("account_dim"), C.USAGE_ACCOUNT, C.PAYER)
    )


# ------------------------------------------------ stable tag keys, stored view
def _two_tag_schemes(spark, sf_dir) -> str:
    """A mart whose early run knew the env tag only; the months before the later run's window keep its ids."""
    from ..session import scratch_path
    from . import mart

    cur, root = _cur(spark, sf_dir), scratch_path(spark, "mart")
    mart.write(mart.build(_early_cur(cur).drop("resource_tags_user_team"), as_of=EARLY_AS_OF), root)
    mart.write(mart.build(cur, as_of=FX.AS_OF), root)
    return root


_TAG_SCHEMES = (
    f"WITH {O.cur_cte()}, {_early_cte()}, {O.view_cte(EARLY_AS_OF, name='v1', source='cur1', tags=_ENV)}, {O.view_cte()}, "
    f"t AS (SELECT DISTINCT {O.TAGS[0]}, '' AS {O.TAGS[1]}, sha256(concat_ws('||', {O.TAGS[0]})) AS tag_dim_id FROM v1 "
    f"UNION {O.tag_dim_select('v')})"
)


@register("tag_key_map", f"{_TAG_SCHEMES} SELECT DISTINCT tag_dim_id, {O.tag_set_key(O.TAGS)} AS tag_set_id FROM t")
def q_tag_key_map(spark, sf_dir):
    """From the tag ids of both runs to the stable key."""
    from ..sources import readers

    return readers.read_parquet(spark, f"{_two_tag_schemes(spark, sf_dir)}/tag_key_map")


@register("tag_set_dim", f"{_TAG_SCHEMES} SELECT DISTINCT {', '.join(O.TAGS)}, {O.tag_set_key(O.TAGS)} AS tag_set_id FROM t")
def q_tag_set_dim(spark, sf_dir):
    """One row for the same tags before and after a tag column was added."""
    from ..sources import readers

    return readers.read_parquet(spark, f"{_two_tag_schemes(spark, sf_dir)}/tag_set_dim", merge_schema=True)


@register(
    "cost_by_tag_set",
    f"{_TAG_SCHEMES}, f AS (SELECT {O.TAGS[0]}, '' AS {O.TAGS[1]}, amortized_cost, unblended_cost FROM v1 "
    "WHERE month::INT < 4 UNION ALL "
    f"SELECT {', '.join(O.TAGS)}, amortized_cost, unblended_cost FROM v) "
    f"SELECT {O.tag_set_key(O.TAGS)} AS tag_set_id, CAST(sum(amortized_cost) AS {O.MONEY}) AS amortized_cost, "
    f"CAST(sum(unblended_cost) AS {O.MONEY}) AS unblended_cost FROM f GROUP BY 1",
)
def q_cost_by_tag_set(spark, sf_dir):
    """Cost by tags over months that were written under different tag columns."""
    from ..sources import readers

    root = _two_tag_schemes(spark, sf_dir)
    measures = ["amortized_cost", "unblended_cost"]
    sums = dims.by_tag_set(
        readers.read_parquet(spark, f"{root}/cost_insights_fact"), readers.read_parquet(spark, f"{root}/tag_key_map"), measures
    )
    return money(sums, measures)


@register("summary_view_stored", ORACLE["summary_view"])
def q_summary_view_stored(spark, sf_dir):
    """The summary as a catalog view over a catalog table, read by another session."""
    from . import jobs

    db = _scratch_db(spark, "view")
    cur = _cur(spark, sf_dir, by_month=True)
    cur.write.partitionBy("year", "month").format("parquet").saveAsTable(f"{db}.cur")
    jobs.create_summary_view(spark, f"{db}.cur", f"{db}.summary_view", as_of=FX.AS_OF)
    other = configure(spark.newSession())
    return money(other.table(f"{db}.summary_view"), C.MEASURES)


# ------------------------------- roll-ups, lookups as of a day, rules as data
_PERIODS = {
    "all": "true",
    "summer": "year = '2001' AND month IN ('6', '7', '8')",
    "september": "year = '2001' AND month = '9'",
}


@register(
    "distinct_resource_rollup",
    O.with_view(
        " UNION ALL ".join(
            f"SELECT '{period}' AS period, product_servicename, CAST(count(DISTINCT line_item_resource_id) AS BIGINT) "
            f"AS resources, true AS within_bound FROM v WHERE {where} GROUP BY product_servicename"
            for period, where in _PERIODS.items()
        )
    ),
)
def q_distinct_resource_rollup(spark, sf_dir):
    """Distinct resources by service over sets of months: the estimates from stored monthly
    sketches lie within their stated error of the exact counts."""
    from ..operators import rollup
    from ..session import scratch_path
    from ..sinks import writers
    from ..sources import readers

    cur, path = _cur(spark, sf_dir), scratch_path(spark, "sketches")
    writers.write_partitioned(rollup.resource_sketches(cur, as_of=FX.AS_OF), path)
    stored = readers.read_parquet(spark, path)
    rows = summary.line_items(cur, FX.AS_OF)
    out = None
    for period, where in _PERIODS.items():
        estimate = rollup.distinct_resources(stored.where(where), C.SERVICE_NAME).alias("e")
        exact = rows.where(where).groupBy(C.SERVICE_NAME).agg(F.count_distinct(C.RESOURCE_ID).alias("exact")).alias("x")
        met = exact.join(estimate, F.col(f"x.{C.SERVICE_NAME}").eqNullSafe(F.col(f"e.{C.SERVICE_NAME}")), "left")
        within = F.abs(F.col("resources") - F.col("exact")) <= F.col("exact") * rollup.bound()
        part = met.select(
            F.lit(period).alias("period"), F.col(f"x.{C.SERVICE_NAME}").alias(C.SERVICE_NAME),
            F.col("exact").alias("resources"), F.coalesce(within, F.lit(False)).alias("within_bound"),
        )
        out = part if out is None else out.union(part)
    return out


@register(
    "instance_address_as_of",
    O.with_view(
        f", h AS ({FX.instance_history_sql()}), "
        "d AS (SELECT DISTINCT CAST(usage_date AS DATE) AS usage_day, product_servicename, "
        "regexp_extract(line_item_resource_id, '[^:]*$') AS resource_id FROM v) "
        "SELECT d.usage_day, d.product_servicename, d.resource_id, "
        f"CASE WHEN {_EC2_I} THEN coalesce(h.private_ip, '') END AS secondary_identifier "
        "FROM d LEFT JOIN h ON h.instance_id = d.resource_id AND d.usage_day >= h.valid_from "
        "AND (h.valid_to IS NULL OR d.usage_day < h.valid_to)"
    ),
)
def q_instance_address_as_of(spark, sf_dir):
    """The address each instance had on each day it was used, though addresses moved."""
    from ..functions import keys
    from ..operators import asof

    rows = summary.line_items(_cur(spark, sf_dir), FX.AS_OF)
    used = rows.select(
        F.to_date(C.USAGE_START).alias("usage_day"), C.SERVICE_NAME, keys.short_resource_id(F.col(C.RESOURCE_ID)).alias("resource_id")
    ).distinct()
    history = FX.instance_history_from_tables(spark, sf_dir)
    return asof.instance_addresses(used, history, "usage_day", dims.is_ec2_instance())


_NAME_ARGS = ("product_servicename", "line_item_product_code", "line_item_line_item_type", "bill_billing_entity", "product_product_name")


def _named_sql(case: str) -> str:
    return (
        f"WITH {O.cur_cte()} SELECT line_item_product_code AS product_code, {case} AS service_name, "
        f"count(*) AS line_items, CAST(sum(line_item_unblended_cost) AS {O.MONEY}) AS unblended_cost "
        f"FROM cur WHERE {O.window_predicate()} GROUP BY 1, 2"
    )


def _named(spark, sf_dir, rules: DataFrame) -> DataFrame:
    from ..operators import user_rules

    rows = summary.windowed(_cur(spark, sf_dir), FX.AS_OF, dates.DEFAULT_MONTHS_BACK)
    named = user_rules.with_service_names(rows, rules, out="service_name")
    return named.groupBy(F.col(C.PRODUCT_CODE).alias("product_code"), "service_name").agg(
        F.count("*").alias("line_items"), F.sum(C.UNBLENDED).cast(MONEY).alias("unblended_cost")
    )


@register("service_name_rules_as_data", _named_sql(O.service_name_case(*_NAME_ARGS)))
def q_service_name_rules_as_data(spark, sf_dir):
    """The built-in names from ordered rules that are rows of a table."""
    from ..operators import user_rules

    return _named(spark, sf_dir, user_rules.builtin_rules(spark))


USER_RULES = [
    (10, None, "AmazonEC", True, None, None, "Compute and containers"),
    (20, None, "Amazon", True, None, "AWS Marketplace", "Marketplace: {product_name}"),
    (30, "", "A", True, "Usage", None, "Nameless usage"),
    (30, "AWS Data Transfer", None, False, None, None, "Transfer"),
    (40, None, "AmazonS3", False, None, None, "Storage"),
    (50, None, "AmazonS3", True, None, None, "Storage, cold"),
    (90, None, None, False, "Tax", None, "Taxes"),
]


@register(
    "service_name_user_rules",
    _named_sql(
        "CASE WHEN starts_with(line_item_product_code, 'AmazonEC') THEN 'Compute and containers' "
        "WHEN starts_with(line_item_product_code, 'Amazon') AND bill_billing_entity = 'AWS Marketplace' "
        "THEN 'Marketplace: ' || product_product_name "
        "WHEN product_servicename = '' AND starts_with(line_item_product_code, 'A') AND line_item_line_item_type = 'Usage' "
        "THEN 'Nameless usage' WHEN product_servicename = 'AWS Data Transfer' THEN 'Transfer' "
        "WHEN line_item_product_code = 'AmazonS3' THEN 'Storage' "
        "WHEN starts_with(line_item_product_code, 'AmazonS3') THEN 'Storage, cold' "
        "WHEN line_item_line_item_type = 'Tax' THEN 'Taxes' ELSE product_servicename END"
    ),
)
def q_service_name_user_rules(spark, sf_dir):
    """A user's own rules: prefixes, other conditions, priorities."""
    from ..operators import user_rules

    return _named(spark, sf_dir, spark.createDataFrame(USER_RULES, user_rules.SCHEMA))
