import collections
import hashlib
import random

import numpy as np
import pytest
from costmart.llm import queries, suffix_dedup
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    seen = collections.Counter()
    raws = [(t or "").encode() for t in texts]
    for b in raws:
        seen.update(b[p : p + length] for p in range(len(b) - length + 1))
    out = []
    for b in raws:
        hit = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                hit[p] += 1
                hit[p + length] -= 1
        gone = np.cumsum(hit)[: len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def digest(rows):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    return rows.select("id", "n_bytes", removed.alias("r"), F.size("spans").alias("n"), F.sha2("kept", 256).alias("k"))


def made(seed, length):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefé", k=5)) for _ in range(30)]
    base = [" ".join(rng.choices(words, k=rng.randint(5, 90))) for _ in range(12)]
    texts = [*base, None, "", "y" * (length - 1), "y" * length, "z" * (length + 1), "ab" * length, base[0], base[0]]
    for _ in range(60):
        a, b = rng.choice(base), rng.choice(base)
        at = rng.randrange(max(1, len(a) - 20))
        size = rng.choice([length - 1, length, length + 1, 2 * length])
        texts.append(b[: rng.randrange(60)] + a[at : at + size] + "ü" * rng.randrange(3) + b[-rng.randrange(1, 90) :])
    return texts


@pytest.mark.parametrize(("group_runs", "piece"), [(64, 1 << 19), (1, 150), (3, 90)])
def test_brute_force(spark, monkeypatch, group_runs, piece):
    monkeypatch.setattr(suffix_dedup, "GROUP_RUNS", group_runs)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    texts, length = made(group_runs, 64), 64
    rows = [*enumerate(texts), (0, texts[0]), (None, "q" * 99)]  # a repeated row, a null id
    want = collections.Counter(zip([r[0] for r in rows], brute([r[1] for r in rows], length)))
    found = digest(suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), length)).collect()
    assert collections.Counter((r.id, (r.n_bytes, r.r, r.n, r.k)) for r in found) == want
    assert any(w[1][1] for w in want)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([d.doc_id for d in docs], brute([d.text for d in docs], 400)))
    got = queries.op5_suffix_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_odd_rows(odd_docs):
    rows = suffix_dedup.dedup(odd_docs, 400).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.id: r for r in rows}
    assert by_id[4].kept == by_id[5].kept == b"" and by_id[1].kept == b""
    assert by_id[None].kept == b"no id here but words"
    assert suffix_dedup.dedup(odd_docs.limit(0)).count() == 0


def test_names_and_sliding_minimum():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    names = suffix_dedup.Names(np.concatenate((data, data)))
    a, b = np.arange(0, 4000), np.arange(0, 4000) + 777
    assert (names.wide(a, b) == names.wide(a + 5000, b + 5000)).all()
    assert (names.narrow(a, b) == names.narrow(a + 5000, b + 5000)).all()
    assert len(np.unique(names.wide(a, b))) == 4000
    key = rng.integers(0, 1000, 500).astype(np.uint64)
    for width in (1, 7, 499, 500):
        want = [key[i : i + width].min() for i in range(len(key) - width + 1)]
        assert suffix_dedup._sliding_min(key, width).tolist() == want
