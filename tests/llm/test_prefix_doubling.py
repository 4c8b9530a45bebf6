import collections

import pytest
from costmart.llm import prefix_doubling

from test_suffix_dedup import made


def brute(texts, length):
    raws = [t.encode() for t in texts]
    seen = collections.Counter(b[p : p + length] for b in raws for p in range(len(b) - length + 1))
    return {(i, p) for i, b in enumerate(raws) for p in range(len(b) - length + 1) if seen[b[p : p + length]] > 1}


@pytest.mark.parametrize(("length", "partitions"), [(8, 3), (9, 1), (16, 8), (64, 8), (100, 2)])
def test_brute_force(spark, monkeypatch, length, partitions):
    monkeypatch.setattr(prefix_doubling, "PIECE", 50)
    texts = [t for t in dict.fromkeys(made(length, max(length, 20))) if t is not None]
    rows = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "text long, raw binary")
    rounds = []
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = prefix_doubling.repeated_positions(rows, length, watch=lambda reach, p: rounds.append((reach, p.count())))
        got = {(r.text, r["at"]) for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == brute(texts, length) and got
    assert rounds[0][0] == 8 and rounds[-1] == (length, len(got))


def test_small_batches_and_hot_groups(spark):
    """Groups that run over many Arrow batches keep one rank."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        texts = ["ab" * 60, "ab" * 50 + "c", "x" * 90, "unique text of no repeats at all, 123"]
        rows = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "text long, raw binary")
        got = {(r.text, r["at"]) for r in prefix_doubling.repeated_positions(rows, 40).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == brute(texts, 40)


def test_nothing_to_find(spark):
    empty = spark.createDataFrame([], "text long, raw binary")
    assert prefix_doubling.repeated_positions(empty, 40).collect() == []
    short = spark.createDataFrame([(1, b"short"), (2, b"short")], "text long, raw binary")
    assert prefix_doubling.repeated_positions(short, 40).collect() == []
    with pytest.raises(ValueError):
        prefix_doubling.repeated_positions(empty, 4)
