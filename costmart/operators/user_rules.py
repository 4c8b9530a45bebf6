"""Service names by ordered rules that are data.

A rule is a row: it applies where all its conditions hold, and the rule of the
least priority that applies gives the name:

    priority      int     order of the rules (ties: the smaller name)
    raw_name      string  the raw service name is this; NULL: any
    code          string  the product code is this, or starts with it; NULL: any
    prefix        boolean whether ``code`` is a prefix
    item_type     string  the charge type is this; NULL: any
    entity        string  the billing entity is this; NULL: any
    service_name  string  the name; ``{product_name}`` in it stands for the product name

Rows that no rule applies to keep their raw name. A condition on a NULL value
does not hold, as in a CASE; a placeholder with a NULL product name gives NULL.

Rules are met by equality only: a code is looked up whole and cut to each
prefix length that the rules use, and rules without a code under one mark. They
are applied to the distinct combinations of the five columns, not to line
items, and each combination is reduced to its first rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import columns as C
from .. import rules as R

SCHEMA = (
    "priority int, raw_name string, code string, prefix boolean, item_type string, entity string, service_name string"
)
PLACEHOLDER = "{product_name}"
MOST_LENGTHS = 256  # prefix lengths in use; product codes are short


def builtin_rules(spark: SparkSession) -> DataFrame:
    """The built-in service names (data-transfer codes and rows without a name) as rules."""
    rows = [(R.DATA_TRANSFER, code, None, None, shown) for code, shown in R.DATA_TRANSFER_SERVICE_NAMES]
    rows += [("", code, None, None, shown) for code, shown in R.EMPTY_NAME_SERVICE_NAMES]
    rows.append(("", R.EMPTY_NAME_FEE_CODE, R.FEE, None, R.EMPTY_NAME_FEE_CODE))
    rows.append(("", None, None, R.MARKETPLACE, R.MARKETPLACE_PREFIX + PLACEHOLDER))
    return spark.createDataFrame(
        [(i, raw, code, False, kind, entity, shown) for i, (raw, code, kind, entity, shown) in enumerate(rows)], SCHEMA
    )


def first_match(combinations: DataFrame, rules: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``combinations`` with ``__matched`` and ``__name`` of the first rule that applies.

    ``columns`` names the combination's raw_name, code, item_type, entity and product_name."""
    code = F.col(columns["code"])
    by = F.when(F.col("code").isNull(), F.lit("*")).when(F.col("prefix"), F.length("code").cast("string")).otherwise("=")
    keyed = rules.withColumns({"__by": by, "__code": F.coalesce("code", F.lit(""))})
    # a row a length
    lengths = sorted(
        r[0] for r in rules.where("prefix AND code IS NOT NULL").select(F.length("code")).distinct().limit(MOST_LENGTHS + 1).collect()
    )
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"rules use more than {MOST_LENGTHS} prefix lengths")

    def probe(by: str, value):
        return F.struct(F.lit(by).alias("by"), value.alias("code"))

    looked_up = [probe("=", code), probe("*", F.lit(""))]
    looked_up += [probe(str(n), F.when(F.length(code) >= n, F.substring(code, 1, n))) for n in lengths]
    probes = combinations.withColumn("__probe", F.explode(F.array(*looked_up)))

    def holds(rule_column: str, column: str):
        return F.col(rule_column).isNull() | (F.col(rule_column) == F.col(column))

    met = probes.alias("p").join(
        keyed.select(*[F.col(c).alias(f"__r_{c}") for c in keyed.columns]).alias("r"),
        (F.col("__probe.by") == F.col("__r___by"))
        & (F.col("__probe.code") == F.col("__r___code"))
        & holds("__r_raw_name", columns["raw_name"])
        & holds("__r_item_type", columns["item_type"])
        & holds("__r_entity", columns["entity"]),
    )
    rule = F.struct(F.col("__r_priority"), F.col("__r_service_name"))
    # grouped by the columns themselves (NULL is a value of its own there)
    best = met.groupBy(*combinations.columns).agg(F.min(rule).alias("__rule"))
    shown = F.col("__rule.__r_service_name")
    name = F.when(shown.contains(PLACEHOLDER), F.replace(shown, F.lit(PLACEHOLDER), F.col(columns["product_name"])))
    return best.select(*combinations.columns, F.lit(True).alias("__matched"), name.otherwise(shown).alias("__name"))


def with_service_names(
    df: DataFrame,
    rules: DataFrame,
    out: str = C.SERVICE_NAME,
    raw: str = C.SERVICE_NAME,
    item_type: str = C.ITEM_TYPE,
    entity: str = C.BILLING_ENTITY,
    product_name: str = C.PRODUCT_NAME,
    code: str = C.PRODUCT_CODE,
) -> DataFrame:
    """``df`` with ``out``: the name of the first rule that applies, else the raw name."""
    columns = {"raw_name": raw, "code": code, "item_type": item_type, "entity": entity, "product_name": product_name}
    used = list(dict.fromkeys(columns.values()))
    named = first_match(df.select(*used).distinct(), rules, columns)
    named = named.select(*[F.col(c).alias(f"__k_{i}") for i, c in enumerate(used)], "__matched", "__name")
    same = F.lit(True)
    for i, c in enumerate(used):
        same = same & F.col(c).eqNullSafe(F.col(f"__k_{i}"))
    met = df.join(named, same, "left")
    shown = F.when(F.col("__matched"), F.col("__name")).otherwise(F.col(raw))
    return met.withColumn(out, shown).drop("__matched", "__name", *[f"__k_{i}" for i in range(len(used))])
