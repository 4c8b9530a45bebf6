"""The cost fact: five cost sums per account x day x resource x charge type x
purchase option x tags x month, with hash surrogate keys to the tag and
resource dimensions.

``fact(summary_df)`` re-aggregates the summary (two aggregations, the shape
of the original pipeline). ``fact_direct(cur)`` groups the line items once at
fact grain: every measure is a sum, so sums of sums over the finer summary
grain equal sums over the rows, and one shuffle of fact-grain partial
aggregates replaces two. Both return the same rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import classify, dates, keys, measures
from . import summary as S

FACT_COLUMNS = [
    "aws_account_dim_id",
    "date_dim_id",
    "charge_type",
    "purchase_option",
    "charge_category",
    "product_code",
    *C.FACT_MEASURES,
    "tag_dim_id",
    "aws_product_dim_id",
    "year",
    "month",
]


def _finish(grouped: DataFrame, tags: list[str]) -> DataFrame:
    """Add the derived labels and the two surrogate keys (wide form: the tag
    and resource columns are kept so the dimensions can be cut from it).
    The usage day is grouped on as a date and formatted here, per group."""
    return grouped.withColumns(
        {
            "date_dim_id": F.date_format(F.col(_DAY), "yyyyMMdd"),
            "charge_category": classify.charge_category("charge_type"),
            "product_code": F.col(C.PRODUCT_CODE),
            "tag_dim_id": keys.surrogate_key(tags),
            "aws_product_dim_id": keys.surrogate_key(C.RESOURCE_DIM_COLUMNS),
        }
    )


_DAY = "__usage_day"
USAGE_DAY = _DAY


def _dealt(grouped: DataFrame, by_month: bool) -> DataFrame:
    """``grouped``, with ``by_month`` dealt to a write by month: before the two
    keys are made, which are most of a finished row's bytes and do not compress."""
    return grouped.hint("rebalance", C.YEAR, C.MONTH) if by_month else grouped


def narrow(wide: DataFrame) -> DataFrame:
    """The published fact columns of a wide fact."""
    return wide.select(*FACT_COLUMNS)


def fact_wide_from_summary(summary_df: DataFrame, tag_prefix: str = C.TAG_PREFIX) -> DataFrame:
    tags = C.tag_columns(summary_df, tag_prefix)
    grouped = summary_df.groupBy(
        F.col("linked_account_id").alias("aws_account_dim_id"),
        F.to_date(F.col("usage_date")).alias(_DAY),
        *[F.col(c) for c in C.RESOURCE_DIM_COLUMNS],
        "charge_type",
        "purchase_option",
        *[F.coalesce(F.col(t), F.lit("")).alias(t) for t in tags],
        "year",
        "month",
    ).agg(*[F.sum(m).alias(m) for m in C.FACT_MEASURES])
    return _finish(grouped, tags)


def fact(summary_df: DataFrame, tag_prefix: str = C.TAG_PREFIX) -> DataFrame:
    """Fact from the summary (two-level aggregation)."""
    return narrow(fact_wide_from_summary(summary_df, tag_prefix))


def fact_wide_direct(
    cur: DataFrame,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    rules: DataFrame | None = None,
    tag_prefix: str = C.TAG_PREFIX,
    service_names: str = "join",
    by_month: bool = False,
) -> DataFrame:
    grouped = _grouped(cur, as_of, months_back, rules, tag_prefix, service_names)
    return _finish(_dealt(grouped, by_month), C.tag_columns(cur, tag_prefix))


def _grouped(
    cur: DataFrame,
    as_of: _dt.date | str | None,
    months_back: int | None,
    rules: DataFrame | None,
    tag_prefix: str,
    service_names: str,
    further: tuple[str, ...] = (),
) -> DataFrame:
    """Line items summed at fact grain (and by the ``further`` columns)."""
    C.require_columns(cur, C.REQUIRED_CUR_COLUMNS)
    tags = C.tag_columns(cur, tag_prefix)
    # The service name is a group key here, so it is derived per row: a
    # broadcast hash join against the bounded rule table, pipelined in the
    # scan stage before the partial aggregation.
    rows, service_name = S.named_rows(cur, as_of, months_back, rules, service_names)
    resource_keys = [
        service_name.alias(c) if c == C.SERVICE_NAME else F.col(c) for c in C.RESOURCE_DIM_COLUMNS
    ]
    return rows.groupBy(
        *further,
        F.col(C.USAGE_ACCOUNT).alias("aws_account_dim_id"),
        F.to_date(F.col(C.USAGE_START)).alias(_DAY),
        *resource_keys,
        F.col(C.ITEM_TYPE).alias("charge_type"),
        classify.purchase_option().alias("purchase_option"),
        *[F.coalesce(F.col(t), F.lit("")).alias(t) for t in tags],
        F.col(C.YEAR).alias("year"),
        F.col(C.MONTH).alias("month"),
    ).agg(*measures.measure_aggs(C.FACT_MEASURES))


def partial_sums(
    cur: DataFrame, further: tuple[str, ...], rules: DataFrame | None = None, tag_prefix: str = C.TAG_PREFIX
) -> DataFrame:
    """Sums at fact grain and by the ``further`` columns of ``cur``, without
    window: ``wide_from_partials`` adds up those of any parts of a CUR."""
    return _grouped(cur, None, None, rules, tag_prefix, "join", further)


def wide_from_partials(sums: DataFrame, tags: list[str], by_month: bool = False) -> DataFrame:
    """The wide fact of the line items behind ``sums``. ``tags`` are the tag
    columns of the whole CUR, some of which the parts may lack."""
    kinds = dict(sums.dtypes)
    of = {t: F.coalesce(F.col(t), F.lit("")) if t in kinds else F.lit("") for t in tags}
    grouped = sums.groupBy(
        "aws_account_dim_id",
        F.col(_DAY).alias(_DAY),
        *C.RESOURCE_DIM_COLUMNS,
        "charge_type",
        "purchase_option",
        *[c.alias(t) for t, c in of.items()],
        "year",
        "month",
    ).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in C.FACT_MEASURES])
    return _finish(_dealt(grouped, by_month), tags)


def fact_direct(
    cur: DataFrame,
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    rules: DataFrame | None = None,
    tag_prefix: str = C.TAG_PREFIX,
    service_names: str = "join",
) -> DataFrame:
    """Fact straight from the line items (one aggregation)."""
    return narrow(fact_wide_direct(cur, as_of, months_back, rules, tag_prefix, service_names))
