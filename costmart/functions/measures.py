"""The cost measures as aggregate expressions.

Each measure is ``sum`` over a per-row CASE; the CASE is a built-in ``when``
chain so partial (map-side) aggregation and codegen apply. A NULL operand in
the chosen arm makes that row NULL, which ``sum`` skips; a group whose rows
are all NULL sums to NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import columns as C
from .cache import per_session


def _t() -> Column:
    return F.col(C.ITEM_TYPE)


def _zero() -> Column:
    return F.lit(0)


@per_session
def usage_quantity_row() -> Column:
    return F.when(
        _t().isin("SavingsPlanCoveredUsage", "DiscountedUsage", "Usage"), F.col(C.USAGE_AMOUNT)
    ).otherwise(_zero())


@per_session
def unblended_cost_row() -> Column:
    return F.col(C.UNBLENDED)


@per_session
def amortized_cost_row() -> Column:
    return (
        F.when(_t() == "SavingsPlanCoveredUsage", F.col(C.SP_EFFECTIVE))
        .when(_t() == "SavingsPlanRecurringFee", F.col(C.SP_COMMITMENT) - F.col(C.SP_USED))
        .when(_t() == "SavingsPlanNegation", _zero())
        .when(_t() == "SavingsPlanUpfrontFee", _zero())
        .when(_t() == "DiscountedUsage", F.col(C.RI_EFFECTIVE))
        .when(_t() == "RIFee", F.col(C.RI_UNUSED_UPFRONT) + F.col(C.RI_UNUSED_RECURRING))
        .when((_t() == "Fee") & (F.col(C.RI_ARN) != ""), _zero())
        .otherwise(F.col(C.UNBLENDED))
    )


@per_session
def ri_sp_trueup_row() -> Column:
    return (
        F.when(_t() == "SavingsPlanRecurringFee", -F.col(C.SP_AMORTIZED_UPFRONT))
        .when(_t() == "RIFee", -F.col(C.RI_AMORTIZED_UPFRONT))
        .otherwise(_zero())
    )


@per_session
def ri_sp_upfront_fees_row() -> Column:
    return (
        F.when(_t() == "SavingsPlanUpfrontFee", F.col(C.UNBLENDED))
        .when((_t() == "Fee") & (F.col(C.RI_ARN) != ""), F.col(C.UNBLENDED))
        .otherwise(_zero())
    )


@per_session
def public_cost_row() -> Column:
    return F.when(_t() != "SavingsPlanNegation", F.col(C.PUBLIC_ON_DEMAND)).otherwise(_zero())


ROW_EXPRESSIONS = {
    "usage_quantity": usage_quantity_row,
    "unblended_cost": unblended_cost_row,
    "amortized_cost": amortized_cost_row,
    "ri_sp_trueup": ri_sp_trueup_row,
    "ri_sp_upfront_fees": ri_sp_upfront_fees_row,
    "public_cost": public_cost_row,
}


def measure_aggs(names: list[str] | None = None) -> list[Column]:
    """``sum`` of each row expression, aliased to the measure name."""
    return list(_measure_aggs(tuple(names or C.MEASURES)))


@per_session
def _measure_aggs(names: tuple[str, ...]) -> tuple[Column, ...]:
    return tuple(F.sum(ROW_EXPRESSIONS[n]()).alias(n) for n in names)
