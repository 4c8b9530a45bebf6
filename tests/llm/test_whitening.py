import numpy as np
import pytest
from costmart.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def brute(vectors, k=8):
    """(n, deviations, eigenvalues, whitened up to sign, trace) of vectors of one length, by numpy's solver."""
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    value, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-value)[:k]
    return n, deviation, value[order], centred @ axes[:, order] / np.sqrt(np.abs(value[order])), value.sum()


def check(rows, vectors, k=8):
    n, deviation, value, white, trace = brute([v for _, v in vectors], k)
    got = {}
    for r in rows:
        got.setdefault(r["row"]["vec_id"], {})[r["component"]] = r
    assert sorted(got, key=str) == sorted({i for i, _ in vectors}, key=str)
    sign = np.sign([got[vectors[0][0]][c + 1]["whitened"] / white[0, c] for c in range(len(value))])
    for j, (i, _) in enumerate(vectors):
        for c in range(len(value)):
            r = got[i][c + 1]
            assert (r["n"], r["deviation"]) == (n, deviation[j])
            assert r["whitened"] == pytest.approx(sign[c] * white[j, c], abs=1e-6)
            assert r["explained"] == pytest.approx(value[c] / trace, rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.op11_whitening(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    full = whitening.whiten(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()
    check(full, [(r[0], r[1]) for r in rows if usable(r[1])])
    assert got.count() == 8 * len({r[0] for r in rows if usable(r[1])})


@pytest.mark.parametrize("partitions, fan, block", [(1, 16, 4096), (9, 2, 7), (40, 3, 4096)])
def test_many_blocks_and_tree_levels(spark, monkeypatch, partitions, fan, block):
    monkeypatch.setattr(whitening, "FAN", fan)
    monkeypatch.setattr(whitening, "BLOCK", block)
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.normal(size=6) * [5, 4, 3, 2, 1, 0.1] + 100).tolist()) for i in range(200)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(partitions)
    check(whitening.whiten(df).collect(), vectors, 6)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=3).tolist()) for i in range(20)]
    short = [(100 + i, rng.normal(size=2).tolist()) for i in range(10)]
    bad = [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan")] * 3), (203, [float("inf"), 0.0, 0.0]), (204, []),
           (205, [1e300, 0.0, 0.0]), (206, [1e305, 1.0, 1.0])]
    rows = [(i, v, "a", 1) for i, v in good + short + bad]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string, n int")
    got = whitening.whiten(df).collect()
    check([r for r in got if r["row"]["vec_id"] < 100], good, 3)
    check([r for r in got if 100 <= r["row"]["vec_id"] < 200], short, 2)
    assert {r["row"]["row"] for r in got} == {"a"} and max(r["row"]["vec_id"] for r in got) < 200


def test_repeated_rows_and_null_ids(spark):
    vectors = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, 0.0]), (3, [1.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 8 and {r["n"] for r in got} == {4}
    assert sum(r["row"]["vec_id"] is None for r in got) == 2


def test_no_variance_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, schema)).collect() == []
    line = [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)]  # one direction only
    assert {r["component"] for r in whitening.whiten(spark.createDataFrame(line, schema)).collect()} == {1}


def test_deviation_beyond_a_long():
    fit = whitening.Whitening(2, np.array([0, 0]), np.eye(2), 2)
    assert fit.deviations(np.array([[1 << 40, 0], [3, 4]])) == [None, 100]
    assert fit.deviations(np.array([[3, 4]])) == [100]


MATRICES = {
    "random": lambda g: g.normal(size=(90, 64)) * g.uniform(0.1, 10, 64),
    "one": lambda g: g.normal(size=(5, 1)),
    "two": lambda g: g.normal(size=(5, 2)),
    "wide": lambda g: g.normal(size=(3, 10)),
    "equal values": lambda g: np.eye(20),
    "groups of equal values": lambda g: np.linalg.qr(g.normal(size=(60, 20)))[0] * np.repeat([9.0, 9, 4, 1], 5) @ np.linalg.qr(g.normal(size=(20, 20)))[0],
    "close pairs": lambda g: np.diag(np.abs(np.arange(-10, 11)).astype(float)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
    "graded": lambda g: g.normal(size=(40, 25)) * 10.0 ** -np.arange(25),
    "graded upwards": lambda g: g.normal(size=(40, 25)) * 10.0 ** (np.arange(25) - 12),
    "low rank": lambda g: g.normal(size=(40, 2)) @ g.normal(size=(2, 12)),
    "copied columns": lambda g: np.hstack([g.normal(size=(50, 5))] * 3),
    "zero": lambda g: np.zeros((5, 4)),
    "zero column between": lambda g: np.diag([3.0, 0.0, 2.0, 0.0, 1.0]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver(name):
    x = MATRICES[name](np.random.default_rng(1))
    r = whitening._triangle(x)
    diagonal, above, right = whitening.bidiagonal(r)
    exact = np.linalg.svd(x, compute_uv=False)
    exact = np.concatenate((exact, np.zeros(x.shape[1] - len(exact))))
    assert np.abs(right.T @ right - np.eye(x.shape[1])).max() < 1e-13
    assert whitening.singular_values(diagonal, above) == pytest.approx(exact, abs=1e-13 * max(exact[0], 1))
    value, axes, trace = whitening.components_of(r, len(x), x.shape[1])
    v = x.T @ x / len(x)
    assert trace == pytest.approx(np.trace(v))
    assert len(value) == (exact > 1e-12 * exact[0]).sum()
    if len(value):
        assert np.abs(v @ axes - axes * value).max() < 1e-13 * np.abs(v).max() * len(v)
        assert np.abs(axes.T @ axes - np.eye(len(value))).max() < 1e-10


def test_small_values_are_relatively_right():
    """dqds keeps the digits of tiny singular values of a bidiagonal matrix."""
    diagonal, above = 10.0 ** -np.arange(12), 10.0 ** -np.arange(11) * 0.5
    got = whitening.singular_values(diagonal, above)
    # the product of all values is the determinant
    assert np.prod(got) == pytest.approx(np.prod(diagonal), rel=1e-11)
    assert whitening.singular_values(diagonal[::-1], above[::-1]) == pytest.approx(got, rel=1e-12)
