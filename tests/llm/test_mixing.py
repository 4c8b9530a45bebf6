import hashlib
import warnings

import pytest
from costmart.llm import mixing
from pyspark.sql import functions as F


def test_marginals_meet_their_targets(spark, docs_of):
    rows = [(i, "w " * (i % 13 + 1), ["en", "de", "fr"][i % 3], f"s{min(i % 7, 3)}") for i in range(900)]
    targets = {"source": {"s0": 0.5}, "lang": {"en": 0.2, "de": 0.5, "fr": 0.3}}
    topic = F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    found = mixing.mix(docs_of(rows), targets, budget=0.4, rounds=5, topic=topic).toPandas()
    found["raked"] = found.weight * found.tokens
    total = found.tokens.sum()
    lang = (found.groupby("lang").raked.sum() / total).to_dict()
    assert lang == pytest.approx({"en": 0.2, "de": 0.5, "fr": 0.3}, abs=1e-3)
    assert found[found.source == "s0"].raked.sum() / total == pytest.approx(0.5, abs=1e-3)
    natural = found.groupby("topic").tokens.sum() ** mixing.TEMPER
    want = (natural / natural.sum()).to_dict()
    assert (found.groupby("topic").raked.sum() / total).to_dict() == pytest.approx(want, abs=1e-3)
    assert (found.probability * found.tokens).sum() / total == pytest.approx(0.4, abs=1e-6)
    assert found.probability.max() <= 1 and len(found) == 900
    draws = [int(hashlib.md5(f"mix{r.doc_id}".encode()).hexdigest()[:12], 16) / 16**12 for r in found.row]
    assert [a < b for a, b in zip(draws, found.probability)] == found.sampled.tolist()


def _table(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def test_slow_tables_are_raked_until_they_meet_their_targets(spark):
    cells = _table(spark, [("a", "x", "t", 1000), ("a", "y", "t", 30), ("b", "x", "t", 30), ("b", "y", "t", 1)])
    cells = cells.union(_table(spark, [("c", "y", "t", 1000), ("c", "x", "t", 1)]))
    targets = {"source": {"a": 0.2, "b": 0.1, "c": 0.7}, "lang": {"x": 0.7, "y": 0.3}, "topic": {"t": 1.0}}
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        found = mixing.rake(cells, targets, rounds=1).toPandas()
    total = found.tokens.sum()
    for dim, wanted in targets.items():
        assert (found.groupby(dim).raked.sum() / total).to_dict() == pytest.approx(wanted, abs=mixing.TOLERANCE)


def test_later_rounds_against_a_second_implementation(spark):
    """Raked cells are those of plain proportional fitting with as many rounds as the tolerance takes."""
    rows = [("a", "x", "t", 1000), ("a", "y", "u", 30), ("b", "x", "t", 30), ("b", "y", "u", 1), ("c", "y", "t", 1000),
            ("c", "x", "u", 1), ("c", "x", "t", 7), ("a", "x", "u", 4)]
    targets = [{"a": 0.2, "b": 0.1, "c": 0.7}, {"x": 0.7, "y": 0.3}, {"t": 0.6, "u": 0.4}]
    total = sum(r[3] for r in rows)
    raked, rounds = [float(r[3]) for r in rows], 0

    def marginal(d, key):
        return sum(w for r, w in zip(rows, raked) if r[d] == key)

    while rounds < 2 or any(abs(marginal(d, k) / total - share) > mixing.TOLERANCE for d in range(3) for k, share in targets[d].items()):
        rounds += 1
        for d in range(3):
            now = {k: marginal(d, k) for k in targets[d]}
            raked = [w * targets[d][r[d]] * total / now[r[d]] for r, w in zip(rows, raked)]
    assert rounds > 3
    found = mixing.rake(_table(spark, rows), dict(zip(mixing.DIMENSIONS, targets)), rounds=2).collect()
    got = {(r.source, r.lang, r.topic): r.raked for r in found}
    assert got == pytest.approx({r[:3]: w for r, w in zip(rows, raked)}, rel=1e-9)


def test_targets_that_cannot_be_met_are_reported(spark):
    cells = _table(spark, [("a", "x", "t", 10), ("b", "y", "t", 10)])
    with pytest.warns(UserWarning, match="misses its target by 0.6"):
        mixing.rake(cells, {"source": {"a": 0.8, "b": 0.2}, "lang": {"x": 0.2, "y": 0.8}}, rounds=2)


def test_probabilities_saturate(spark):
    """Cells brought to 1 give the rest of the budget to the others."""
    rows = [("a", "x", "t", 10, 100.0), ("b", "x", "t", 1000, 910.0), ("c", "x", "t", 0, 0.0)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long, raked double")
    cells = cells.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(0.0))
    found = {r.source: r.probability for r in mixing.calibrated(cells, 0.5).collect()}
    assert found["a"] == 1 and found["b"] * 1000 + 10 == pytest.approx(505) and found["c"] == 0
    full = {r.source: r.probability for r in mixing.calibrated(cells, 1.0).collect()}
    assert full["a"] == 1 and full["b"] == pytest.approx(1)


def test_plan_is_native(spark, docs_of):
    found = mixing.mix(docs_of([(1, "a b", "en", "s"), (2, "c", "de", None)]), rounds=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_odd_rows(odd_docs):
    rows = mixing.mix(odd_docs, rounds=2).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.row.doc_id: r for r in rows}
    assert by_id[1].tokens == by_id[2].tokens == by_id[3].tokens == 0 and not by_id[1].sampled
    assert by_id[4].tokens == 90000 and by_id[1].source is None
    assert len({r.sampled for r in rows if r.row.doc_id == 6}) == 1
    assert mixing.mix(odd_docs.limit(0), rounds=1).count() == 0
