"""Mixing sources to target weights by iterative proportional fitting.

The documents' tokens form a table of cells (source, language, topic). Raking
scales the cells by each marginal in turn, so that the weighted tokens of each
source, of each language and of each topic come to their target shares of the
budget. Documents are then sampled with the probability that belongs to their
cell, by a hash of their id: the same document gets the same draw in any run.

Only DataFrame and SQL functions are used. The text is read once for its token
count and topic, summed by cell before any shuffle; the raking moves cells
only. A marginal is a sum by key with partial sums, joined back by key, so a
source that holds a third of the rows is one row here.

Targets: shares by value for each marginal; values without one keep their
natural share raised to the power ``temper`` (then all are scaled to 1), so
large sources lose weight and small ones gain it. A cell's weight is its raked
tokens over its tokens; the probability is the weight scaled so that the
expected tokens are ``budget`` of all, as far as no probability passes 1.

Defined results: null source, language and topic are values of their own; null
and empty texts have no tokens, weight 0 by no raking and are never sampled;
equal ids draw alike, so repeated rows stay or go together; a null id draws as
the empty text; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

ROUNDS = 8  # at least
MOST_ROUNDS = 200
TOLERANCE = 1e-3  # of all tokens, by which a marginal may miss its target
TEMPER = 0.7
BUDGET = 0.6  # of all tokens
DIMENSIONS = ["source", "lang", "topic"]
DRAW_DIGITS = 12  # hex digits of the draw


def topic_of(text: Column) -> Column:
    """A document's topic, by the form of its text: the first that holds."""
    return (
        F.when(text.contains(" | "), "table")
        .when(text.contains("License") | text.contains("Licensed under"), "licensed")
        .when(text.contains("@") | text.contains("+1 ("), "contact")
        .when(F.length(text) < 400, "note")
        .when(F.length(text) >= 8000, "long")
        .otherwise("prose")
    )


def n_tokens(text: Column) -> Column:
    """Number of words between white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")), F.lit(0)).cast("long")


def draw(id_: Column, seed: str) -> Column:
    """A number in [0, 1) from the md5 of seed and id."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary")), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**DRAW_DIGITS)


def _share(cells: DataFrame, dim: str, wanted: dict[str, float] | None, temper: float) -> DataFrame:
    """Target share of each value of a dimension."""
    own = cells.groupBy(dim).agg(F.sum("tokens").alias("t"))
    raised = F.pow(F.col("t").cast("double"), F.lit(temper))
    given = F.lit(None).cast("double")
    if wanted:
        named = F.create_map(*[x for k, v in wanted.items() for x in (F.lit(k), F.lit(float(v)))])
        given = named[F.col(dim)]
    own = own.withColumn("given", given).withColumn("raised", F.when(F.col("given").isNull(), raised))
    given_sum, raised_sum = own.agg(F.sum("given"), F.sum("raised")).first()
    rest = max(0.0, 1 - (given_sum or 0.0))
    natural = F.col("raised") * rest / F.lit(float(raised_sum or 1.0))
    return own.select(dim, F.coalesce("given", natural).alias(f"{dim}_share"))


def _miss(cells: DataFrame, total: float) -> float:
    """Largest distance of a marginal's share of all tokens from its target."""
    misses = [
        cells.groupBy(dim).agg((F.sum("raked") / float(total or 1) - F.max(f"{dim}_share")).alias("miss")).select("miss")
        for dim in DIMENSIONS
    ]
    return reduce(DataFrame.union, misses).agg(F.max(F.abs("miss"))).first()[0] or 0.0


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER,
         rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with weight: raked tokens over tokens.

    After ``rounds`` rounds, further ones follow until every marginal is within
    TOLERANCE of its target. Targets that no weights meet (a round brings them
    less than a thousandth nearer, or MOST_ROUNDS have passed) give a warning
    with the largest miss; the last marginal raked holds then.
    """
    targets = targets or {}
    cells = cells.withColumn("raked", F.col("tokens").cast("double"))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    for dim in DIMENSIONS:
        share = _share(cells, dim, targets.get(dim), temper).withColumnRenamed(dim, "k")
        cells = cells.join(share, F.col(dim).eqNullSafe(F.col("k")), "left").drop("k")
    cells = written(cells, "mix-cells")
    done, miss = 0, float("inf")
    while True:
        if done >= rounds:
            before, miss = miss, _miss(cells, total)
            if miss <= TOLERANCE or not total:
                break
            if miss > 0.999 * before or done >= MOST_ROUNDS:
                warnings.warn(f"mixing: after {done} rounds a marginal misses its target by {miss:.4f} of all tokens", stacklevel=2)
                break
        done += 1
        for dim in DIMENSIONS:
            now = cells.groupBy(dim).agg(F.sum("raked").alias("now")).withColumnRenamed(dim, "k")
            factor = F.col(f"{dim}_share") * float(total) / F.col("now")
            cells = (
                cells.join(now, F.col(dim).eqNullSafe(F.col("k")), "left")
                .withColumn("raked", F.when(F.col("now") > 0, F.col("raked") * factor).otherwise(F.lit(0.0)))
                .drop("k", "now")
            )
        cells = written(cells, "mix-cells")
    return cells.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(F.lit(0.0)))


def calibrated(cells: DataFrame, budget: float) -> DataFrame:
    """``cells`` with the probability min(1, scale * weight) whose expected tokens are ``budget`` of all.

    The scale is found by filling up: cells that it brings to 1 give all their
    tokens, the others share the rest of the budget, which raises the scale,
    until no further cell comes to 1. Each turn is one sum over the cells.
    """
    total, raked = cells.agg(F.sum("tokens"), F.sum("raked")).first()
    total, raked = float(total or 0), float(raked or 0.0)
    scale, before = (budget * total / raked if raked else 0.0), -1.0
    while scale > before:
        full = F.col("weight") * F.lit(scale) >= 1
        given, rest = cells.agg(
            F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("raked")))
        ).first()
        before = scale
        if rest:
            scale = max(scale, (budget * total - float(given or 0)) / float(rest))
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float = BUDGET,
        temper: float = TEMPER, rounds: int = ROUNDS, seed: str = "mix", id_col: str = "doc_id",
        text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """(row, source, lang, topic, tokens, weight, probability, sampled) of every document.

    row is a struct of all columns of ``docs``.
    """
    text = F.col(f"`{text_col}`").cast("string")
    based = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        (topic_of(text) if topic is None else topic).alias("topic"),
        n_tokens(text).alias("tokens"),
        draw(F.col(f"`{id_col}`"), seed).alias("draw"),
    )
    cells = based.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    cells = calibrated(rake(written(cells, "mix-tokens"), targets, temper, rounds), budget)
    cells = written(cells.select(*DIMENSIONS, "weight", "probability"), "mix-weights")
    of_cell = cells.select(*[F.col(c).alias(f"c_{c}") for c in DIMENSIONS], "weight", "probability")
    same = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in DIMENSIONS]
    weighted = based.join(of_cell, same[0] & same[1] & same[2])
    # a text without tokens has nothing to give
    probability = F.when(F.col("tokens") > 0, F.col("probability")).otherwise(F.lit(0.0))
    return weighted.select(
        "row", *DIMENSIONS, "tokens", "weight", probability.alias("probability"), (F.col("draw") < probability).alias("sampled")
    )
