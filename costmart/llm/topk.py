"""Exact top-k inner products by columnar branch and bound.

The queries are a stated part of the rows; they go to the tasks in blocks of at
most QUERY_BYTES, one pass over the vectors a block; a block's result is written
before the next block is read, so one block is held at a time. A task holds a batch of
candidates in vertical layout (one row per dimension), accumulates the scores
a block of dimensions at a time and, after each block, keeps only candidates
whose partial score plus the product of the remaining norms reaches the k-th
best score known for the query (Cauchy-Schwarz: the remaining mass bounds the
rest). Each task gives its k best per query; a window picks the k best of those.

Defined results: components become floor(scale * x); vectors that are null or
hold null or non-finite components, and rows without id, take no part; vectors
are compared with those of the same length only; rows with the query's own id
are left out; repeated rows count each for itself, as candidates and as
queries; ties go to the smaller id; with fewer candidates all are returned; an
empty table gives an empty result. Scores are exact while they stay below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

DIM_BLOCK = 16
CANDIDATES = 2048  # of a batch that are scored at a time
QUERY_BYTES = 32 << 20  # of query vectors that one pass carries


def quantized(ids: pa.Array, vectors: pa.Array, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix of floor(scale * x)) of the usable rows, by vector length."""
    if pa.types.is_fixed_size_list(vectors.type):
        vectors = vectors.cast(pa.list_(vectors.type.value_type))
    usable = ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
    bounds = vectors.offsets.to_numpy().astype(np.int64)
    flat = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
    size = np.diff(bounds)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    usable &= bad[bounds[1:]] == bad[bounds[:-1]]
    number = ids.fill_null(0).to_numpy(zero_copy_only=False)
    found = {}
    for d in np.unique(size[usable]).tolist():
        rows = np.flatnonzero(usable & (size == d))
        values = flat[bounds[rows][:, None] + np.arange(d)[None, :]]
        found[d] = (number[rows], np.floor(scale * values))
    return found


class Searcher:
    """The k best candidates so far for a block of queries of one length."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.blocks = [(i, min(i + DIM_BLOCK, queries.shape[1])) for i in range(0, queries.shape[1], DIM_BLOCK)]
        self.rest = self._rest(queries.T)
        self.score = np.full((len(ids), k), -np.inf)
        self.best = np.zeros((len(ids), k), np.int64)

    def _rest(self, columns: np.ndarray) -> list[np.ndarray]:
        """Norm of the dimensions that follow each block."""
        mass, found = np.zeros(columns.shape[1]), []
        for a, b in reversed(self.blocks):
            found.append(np.sqrt(mass))
            mass = mass + np.einsum("ij,ij->j", columns[a:b], columns[a:b])
        return found[::-1]

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        for i in range(0, len(ids), CANDIDATES):
            self._add(ids[i : i + CANDIDATES], np.ascontiguousarray(rows[i : i + CANDIDATES].T))

    def _add(self, ids: np.ndarray, columns: np.ndarray) -> None:
        rest = self._rest(columns)
        if self.blocks:
            a, b = self.blocks[0]
            opening = self.queries[:, a:b] @ columns[a:b]
        else:
            opening = np.zeros((len(self.ids), len(ids)))
        for q, own in enumerate(self.ids.tolist()):
            least = self.score[q, -1]
            partial, alive = opening[q], None
            for n, (a, b) in enumerate(self.blocks):
                if n:
                    partial = partial + self.queries[q, a:b] @ columns[a:b, alive]
                others = rest[n] if alive is None else rest[n][alive]
                bound = partial + self.rest[n][q] * others * (1 + 1e-9) + 1e-6
                on = np.flatnonzero(bound >= least)
                alive = on if alive is None else alive[on]
                partial = partial[on]
                if not len(alive):
                    break
            alive = np.arange(len(ids)) if alive is None else alive
            not_own = ids[alive] != own
            if not not_own.any():
                continue
            score = np.concatenate((self.score[q], partial[not_own]))
            number = np.concatenate((self.best[q], ids[alive[not_own]]))
            if len(score) > 4 * self.k:  # all that can be among the k best, ties included
                kth = np.partition(score, len(score) - self.k)[len(score) - self.k]
                some = score >= kth
                score, number = score[some], number[some]
            order = np.lexsort((number, -score))[: self.k]
            self.score[q], self.best[q] = score[order], number[order]


def block_bytes(block: dict[int, tuple[np.ndarray, np.ndarray]]) -> int:
    """Bytes of a block as it is sent."""
    return sum(ids.nbytes + rows.nbytes for ids, rows in block.values())


def _blocks(queries: DataFrame, scale: float) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The queries in blocks of at most QUERY_BYTES (or one query), by vector length."""
    rows, size = [], 0

    def packed():
        ids = pa.array([r[0] for r in rows], pa.int64())
        return quantized(ids, pa.array([r[1] for r in rows], pa.list_(pa.float64())), scale)

    for row in queries.toLocalIterator():
        one = 8 * (1 + len(row[1]))
        if rows and size + one > QUERY_BYTES:
            yield packed()
            rows, size = [], 0
        rows.append(row)
        size += one
    if rows:
        yield packed()


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of each row where ``is_query``."""
    spark = vectors.sparkSession
    columns = [F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")]
    queries = vectors.filter(is_query).select(*columns).filter("id is not null and vector is not null")
    rows = vectors.select(*columns)
    out = "query long, query_id long, vec_id long, score long"
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first = 0
    for block in _blocks(queries, scale):
        sent = spark.sparkContext.broadcast((first, block))
        ranked = rows.mapInArrow(_scan(sent, k, scale), out).withColumn("rank", F.row_number().over(order))
        best = ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found = found.union(written(best, "topk-block"))
        sent.destroy()
        first += sum(len(ids) for ids, _ in block.values())
    return found


def _scan(sent, k: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, block = sent.value
        searchers = {d: Searcher(ids, queries, k) for d, (ids, queries) in block.items()}
        for batch in batches:
            for d, (ids, rows) in quantized(batch.column(0), batch.column(1), scale).items():
                if d in searchers:
                    searchers[d].add(ids, rows)
        for searcher in searchers.values():
            q, place = np.nonzero(np.isfinite(searcher.score))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(q + first),
                    pa.array(searcher.ids[q]),
                    pa.array(searcher.best[q, place]),
                    pa.array(searcher.score[q, place].astype(np.int64)),
                ],
                names=["query", "query_id", "vec_id", "score"],
            )
            first += len(searcher.ids)

    return run
