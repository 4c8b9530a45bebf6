"""Distributed prefix doubling: where strings of a given length repeat in a corpus.

Every byte position of every distinct text has a rank, at first its first eight
bytes as a number. A round pairs a position's rank with that of the position
one offset further on in the same text, sorts the pairs over the cluster and
numbers their groups: the new ranks stand for prefixes of twice the length
(the last round's offset is shorter, to end at ``length``). Positions that are
alone in their group start no repeated string and are dropped, and so is every
position whose partner is gone; what is left after the last round repeats.

Ranks are exact, as they come from comparisons only. A group, however large, is
numbered as it streams by in sorted order. Each round joins and sorts all
positions that are left, so the shuffled volume is some 40 bytes a position and
round: on texts whose short strings repeat this is many times the input
(README), which is why ``suffix_dedup`` cuts positions by samples instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8, written

FIRST = 8  # bytes of the first rank
PIECE = 1 << 20  # positions of one Arrow batch
POSITION = "text long, at long, r1 long, r2 long"


def _positions(texts: DataFrame, length: int) -> DataFrame:
    """(text, at, r1, r2) of every position of ``texts`` (text, raw) that has FIRST bytes; r2 is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.arange(8 * (FIRST - 1), -1, -8, dtype=np.uint64)
        for batch in batches:
            data, offsets, _ = utf8(batch.column(1))
            for row in range(batch.num_rows):
                raw = data[offsets[row] : offsets[row + 1]]
                for a in range(0, len(raw) - FIRST + 1, PIECE):
                    part = raw[a : a + PIECE + FIRST - 1].astype(np.uint64)
                    n = len(part) - FIRST + 1
                    rank = np.zeros(n, np.uint64)
                    for k in range(FIRST):
                        rank |= part[k : k + n] << shift[k]
                    text = np.full(n, batch.column(0)[row].as_py(), np.int64)
                    columns = [text, np.arange(a, a + n), rank.view(np.int64), np.zeros(n, np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["text", "at", "r1", "r2"])

    return texts.select("text", "raw").filter(F.octet_length("raw") >= length).mapInArrow(run, POSITION)


def _ranked(pairs: DataFrame) -> DataFrame:
    """(text, at, rank) of the positions that share their pair (r1, r2) with another one.

    The pairs are sorted over the cluster; equal ones lie in one partition, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, group = TaskContext.get().partitionId() << 40, 0
        last = None  # the last row so far: its pair, text, at, and whether its group has an earlier row
        for batch in batches:
            if not batch.num_rows:
                continue
            text, at, r1, r2 = (batch.column(c).to_numpy() for c in range(4))
            if last is not None:
                text, at, r1, r2 = (np.concatenate(([x], y)) for x, y in zip(last[:4], (text, at, r1, r2)))
            same = (r1[1:] == r1[:-1]) & (r2[1:] == r2[:-1])
            number = group + np.concatenate(([0], np.cumsum(~same)))
            shared = np.zeros(len(text), bool)
            shared[1:] |= same
            shared[:-1] |= same
            shared[0] |= last is not None and last[4]
            out = shared.copy()
            out[-1] = False  # the last row waits for its successor
            yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in (text, at, base + number)], names=["text", "at", "rank"])
            last = (text[-1], at[-1], r1[-1], r2[-1], bool(shared[-1]))
            group = int(number[-1])
        if last is not None and last[4]:
            yield pa.RecordBatch.from_arrays([pa.array([int(v)]) for v in (*last[:2], base + group)], names=["text", "at", "rank"])

    near = pairs.repartitionByRange("r1", "r2").sortWithinPartitions("r1", "r2")
    return near.select("text", "at", "r1", "r2").mapInArrow(run, "text long, at long, rank long")


def repeated_positions(texts: DataFrame, length: int, watch=None) -> DataFrame:
    """(text, at) of the positions whose ``length`` bytes (at least FIRST) also start elsewhere.

    ``texts`` (text, raw): a number and the bytes of each distinct text. ``watch``
    is called after each round with the prefix length and its positions."""
    if length < FIRST:
        raise ValueError(f"strings of {FIRST} bytes or more only")
    ranked = written(_ranked(_positions(texts, length)), "doubling")
    reach = FIRST
    while True:
        if watch is not None:
            watch(reach, ranked)
        if reach == length:
            return ranked.select("text", "at")
        offset = min(reach, length - reach)
        further = ranked.select("text", (F.col("at") - offset).alias("at"), F.col("rank").alias("r2"))
        pairs = ranked.withColumnRenamed("rank", "r1").join(further.hint("merge"), ["text", "at"])
        ranked = written(_ranked(pairs), "doubling")
        reach += offset
