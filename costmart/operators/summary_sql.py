"""The summary as SQL text, for a view that outlives the session.

``view_text`` renders the same labels, measures, grouping and rolling window as
``summary.summary`` over a catalog table. The window ends at ``current_date()``
unless a day is given, so the stored view moves with the calendar. Labels that
are functions of group keys are outside the grouping, as in the DataFrame form;
the service name is one CASE over the grouped rows, with all rules inlined, as
a stored view cannot refer to a session's rule table.
"""

from __future__ import annotations

import datetime as _dt

from .. import columns as C
from .. import rules as R
from ..functions import classify, dates
from . import summary as S


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(identifier: str) -> str:
    """A quoted column name."""
    return "`" + identifier.replace("`", "``") + "`"


def qualified(table: str) -> str:
    """A table or view name, each part quoted (parts may come quoted)."""
    if "`" in table:
        return table
    return ".".join(name(p) for p in table.split("."))


def _case(arms: list[tuple[str, str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {condition} THEN {value}" for condition, value in arms) + f" ELSE {other} END"


_SPOT = f"contains({C.USAGE_TYPE}, 'Spot') AND {C.PRODUCT_CODE} = 'AmazonEC2' AND {C.ITEM_TYPE} = 'Usage'"
_RI_FEE = f"{C.ITEM_TYPE} = 'Fee' AND {C.RI_ARN} <> ''"


def _types(*kinds: str) -> str:
    return f"{C.ITEM_TYPE} IN ({', '.join(text(k) for k in kinds)})"


# Group keys that are computed from raw columns.
COMPUTED = {
    "usage_date": f"date_trunc('day', {C.USAGE_START})",
    "purchase_option": _case(
        [
            (f"{C.SP_ARN} <> ''", "'SavingsPlan'"),
            (f"{C.RI_ARN} <> ''", "'Reserved'"),
            (f"contains({C.USAGE_TYPE}, 'Spot')", "'Spot'"),
        ],
        "'OnDemand'",
    ),
    "ri_sp_arn": _case([(f"{C.SP_ARN} <> ''", C.SP_ARN), (f"{C.RI_ARN} <> ''", C.RI_ARN)], "''"),
    "instance_type_family": _case([(_SPOT, f"get(split({C.DESCRIPTION}, '[.]'), 0)")], C.INSTANCE_FAMILY),
    "instance_type": _case([(_SPOT, f"get(split({C.DESCRIPTION}, ' '), 0)")], C.INSTANCE_TYPE),
    "platform": _case(
        [(_SPOT, f"get(split(get(split({C.DESCRIPTION}, ' '), 1), '/'), 0)")], C.OPERATING_SYSTEM
    ),
}

# What a line item adds to each measure.
MEASURE_ROWS = {
    "usage_quantity": _case([(_types("SavingsPlanCoveredUsage", "DiscountedUsage", "Usage"), C.USAGE_AMOUNT)], "0"),
    "unblended_cost": C.UNBLENDED,
    "amortized_cost": _case(
        [
            (_types("SavingsPlanCoveredUsage"), C.SP_EFFECTIVE),
            (_types("SavingsPlanRecurringFee"), f"{C.SP_COMMITMENT} - {C.SP_USED}"),
            (_types("SavingsPlanNegation", "SavingsPlanUpfrontFee"), "0"),
            (_types("DiscountedUsage"), C.RI_EFFECTIVE),
            (_types("RIFee"), f"{C.RI_UNUSED_UPFRONT} + {C.RI_UNUSED_RECURRING}"),
            (_RI_FEE, "0"),
        ],
        C.UNBLENDED,
    ),
    "ri_sp_trueup": _case(
        [
            (_types("SavingsPlanRecurringFee"), f"-{C.SP_AMORTIZED_UPFRONT}"),
            (_types("RIFee"), f"-{C.RI_AMORTIZED_UPFRONT}"),
        ],
        "0",
    ),
    "ri_sp_upfront_fees": _case([(_types("SavingsPlanUpfrontFee"), C.UNBLENDED), (_RI_FEE, C.UNBLENDED)], "0"),
    "public_cost": _case([(f"{C.ITEM_TYPE} <> 'SavingsPlanNegation'", C.PUBLIC_ON_DEMAND)], "0"),
}

# Labels over the grouped rows (summary column names).
LABELS = {
    "charge_category": _case(
        [(f"charge_type IN ({', '.join(text(t) for t in classify.USAGE_TYPES)})", "'Running_Usage'")], "'non_usage'"
    ),
    "service": _case(
        [
            (f"billing_entity = {text(R.MARKETPLACE)} AND NOT contains(charge_type, 'Discount')", "product_name"),
            (f"{C.SERVICE_CODE} = ''", C.PRODUCT_CODE),
        ],
        C.SERVICE_CODE,
    ),
}


def service_name(rules: list[tuple[str, str]] | None = None) -> str:
    """The display service name over the grouped rows."""
    raw = name(S.RAW_SERVICE_NAME)
    pairs = R.DATA_TRANSFER_SERVICE_NAMES if rules is None else rules
    transfer = f"{raw} = {text(R.DATA_TRANSFER)} AND {C.PRODUCT_CODE} = "
    arms = [(transfer + text(code), text(shown)) for code, shown in pairs]
    arms += [(f"{raw} = '' AND {C.PRODUCT_CODE} = {text(c)}", text(n)) for c, n in R.EMPTY_NAME_SERVICE_NAMES]
    fee = text(R.EMPTY_NAME_FEE_CODE)
    arms.append((f"{raw} = '' AND {C.PRODUCT_CODE} = {fee} AND charge_type = {text(R.FEE)}", fee))
    marketplace = f"{raw} = '' AND billing_entity = {text(R.MARKETPLACE)}"
    arms.append((marketplace, f"concat({text(R.MARKETPLACE_PREFIX)}, product_name)"))
    return _case(arms, raw)


def window(as_of: _dt.date | str | None, months_back: int | None) -> str:
    """The rolling window as a predicate on the billing period and on the partition columns."""
    if months_back is None:
        return "true"
    if as_of is None:
        start = f"add_months(trunc(current_date(), 'MM'), -{int(months_back)})"
    else:
        start = f"DATE '{dates.window_start(dates.as_date(as_of), months_back).isoformat()}'"
    period = f"make_date(CAST({C.YEAR} AS INT), CAST({C.MONTH} AS INT), 1)"
    return f"{C.BILLING_PERIOD_START} >= CAST({start} AS TIMESTAMP) AND {period} >= {start}"


def query_text(
    table: str,
    tags: list[str],
    as_of: _dt.date | str | None = None,
    months_back: int | None = dates.DEFAULT_MONTHS_BACK,
    rules: list[tuple[str, str]] | None = None,
) -> str:
    """The summary of catalog table ``table`` with the tag columns ``tags`` as a SELECT."""
    raw = S.RAW_SERVICE_NAME
    # keys that copy a resource column are grouped once, under the resource column's name
    copies = dict(S.ALIASES_OF_RESOURCE)
    renamed = [(column, key) for column, key in C.RENAMED_KEYS if key not in copies]
    keys = [f"{name(column)} AS {name(key)}" for column, key in renamed]
    keys += [f"{expression} AS {name(key)}" for key, expression in COMPUTED.items()]
    keys += [f"{name(C.SERVICE_NAME)} AS {name(raw)}"]
    keys += [name(c) for c in (*tags, *C.RESOURCE_COLUMNS)]
    sums = [f"sum({MEASURE_ROWS[m]}) AS {name(m)}" for m in C.MEASURES]
    shown = {key: name(key) for _, key in renamed} | {key: name(key) for key in COMPUTED}
    shown |= {key: name(column) for key, column in copies.items()} | LABELS
    outer = [f"{shown[key]} AS {name(key)}" for key in S.SUMMARY_KEY_ORDER]
    outer += [f"CAST(if({name(C.RESOURCE_ID)} IS NULL, 0, 1) AS BIGINT) AS resource_id_count"]
    outer += [name(m) for m in C.MEASURES]
    outer += [f"{service_name(rules)} AS {name(C.SERVICE_NAME)}"]
    outer += [f"coalesce({name(t)}, '') AS {name(t)}" for t in tags]
    outer += [name(c) for c in C.RESOURCE_COLUMNS]
    grouped = f"SELECT {', '.join(keys + sums)} FROM {qualified(table)} WHERE {window(as_of, months_back)} GROUP BY ALL"
    return f"SELECT {', '.join(outer)} FROM ({grouped}) AS grouped"


def view_text(view: str, table: str, tags: list[str], *args, **kw) -> str:
    """``CREATE OR REPLACE VIEW`` for the summary of ``table``; arguments as for ``query_text``."""
    return f"CREATE OR REPLACE VIEW {qualified(view)} AS {query_text(table, tags, *args, **kw)}"
