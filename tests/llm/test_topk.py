import numpy as np
import pytest
from costmart.llm import queries, topk
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute(rows, k):
    rows = [(i, np.floor(256 * np.array(v, float))) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, x in rows:
        if q % 50:
            continue
        near = sorted((-int(x @ y), i) for i, y in rows if i != q and len(x) == len(y))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    return sorted(out)


def found(vectors, k=5):
    rows = topk.top_k(vectors, F.col("vec_id") % 50 == 0, k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in rows)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in queries.op6_topk(spark, SF).collect())
    assert got == brute([tuple(r) for r in rows], 5) and got


@pytest.mark.parametrize("block", [1 << 25, 100])
def test_ties_repeats_and_odd_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BYTES", block)
    monkeypatch.setattr(topk, "CANDIDATES", 7)
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 40).astype(float).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 330)]  # equal vectors: ties
    rows += [(331, rows[5][1]), (331, rows[5][1])]  # a repeated row
    rows += [(400, None), (401, [None] * 40), (402, [float("nan")] * 40), (403, [float("inf")] + [0.0] * 39)]
    rows += [(404, []), (450, []), (405, [1.0, 2.0]), (500, [3.0, 1.0]), (None, rows[0][1]), (550, [None] + [1.0] * 39)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(vectors) == brute(rows, 5)


def test_a_repeated_query_answers_for_itself(spark):
    rows = [(0, [1.0]), (0, [1.0]), (1, [2.0])]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == brute(rows, 5)


def test_empty(spark):
    assert found(spark.createDataFrame([], "vec_id long, embedding array<float>")) == []
    assert found(spark.createDataFrame([(0, None)], "vec_id long, embedding array<float>")) == []


def test_a_block_is_as_large_as_stated(spark, monkeypatch):
    """Queries are sent at most QUERY_BYTES at a time, and one block after the other."""
    monkeypatch.setattr(topk, "QUERY_BYTES", 2000)
    rows = [(i, [float(i), 1.0, 2.0]) for i in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    blocks = list(topk._blocks(vectors.select(F.col("vec_id").alias("id"), "embedding"), 256.0))
    assert len(blocks) > 5 and all(topk.block_bytes(b) <= 2000 for b in blocks)
    live, most = set(), []
    plain = type(spark.sparkContext).broadcast

    def watched(self, value):
        sent = plain(self, value)
        live.add(id(sent))
        most.append(len(live))
        destroy = sent.destroy
        sent.destroy = lambda *a: (live.discard(id(sent)), destroy(*a))
        return sent

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", watched)
    got = topk.top_k(vectors, F.col("vec_id") < 200, 5)
    assert most and max(most) == 1 and not live
    assert got.count() == 1000


def test_bounds_leave_few_candidates():
    rng = np.random.default_rng(0)
    rows = np.floor(256 * rng.normal(0, 1, (4000, 64)) / 8)
    searcher = topk.Searcher(np.array([0]), rows[:1], 5)
    searcher.add(np.arange(4000), rows)
    scores = rows @ rows[0]
    scores[0] = -np.inf
    assert searcher.score[0].tolist() == np.sort(scores)[::-1][:5].tolist()
