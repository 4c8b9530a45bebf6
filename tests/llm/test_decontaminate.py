import hashlib
import random
import re

import numpy as np
import pytest
from costmart.llm import decontaminate, queries
from costmart.llm.fmindex import FMIndex, suffix_ranks

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(k) for k in windows}
    found = {}
    for key, text in docs:
        w = words(text)
        hit, names = [False] * len(w), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if at := windows.get(tuple(w[i : i + n])):
                    names |= at
                    hit[i : i + n] = [True] * n
        found[key] = (len(w), sum(hit), sorted(str(x) for x in names if x is not None))
    return found


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    want = brute([(d.doc_id, d.text) for d in docs], [tuple(i) for i in items])
    got = queries.op3_decontaminate(spark, SF).collect()
    assert len(got) == len(docs) and any(w[1] for w in want.values())
    for r in got:
        n_words, n_hit, names = want[r.doc_id]
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n_words, n_hit, len(names), digest)
        assert r.contaminated == (n_hit > 0)


def made(seed):
    """Few words, so that windows overlap, nest and repeat; items of any length."""
    rng = random.Random(seed)
    vocabulary = ["a", "b", "The", "é", "x1", "WORD", "ü"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", " _ "]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 120))) for i in range(80)] + [(900, None), (901, ""), (902, "...")]
    items = [(i, text(rng.choice([0, 1, 2, 4, 5, 8]))) for i in range(12)] + [(3, None), (None, "zz WORD")]
    items += [(77, docs[5][1]), (77, docs[5][1]), (78, "zz WORD")]
    return docs + [(903, "ZZ word")], items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block", [1 << 20, 600])
def test_brute_force_and_blocks(spark, monkeypatch, seed, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 300)
    docs, items = made(seed)
    found = decontaminate.find(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=4,
    ).collect()
    got = {r.row.doc_id: (r.n_words, sum(s.last - s.first for s in r.spans), sorted(r.items)) for r in found}
    assert got == brute(docs, items, 4)


def test_a_block_is_as_large_as_stated(spark, monkeypatch):
    """What is sent of a block stays below BLOCK_BYTES, one long item included, and all windows are in some block."""
    import pickle

    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40_000)
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(1, 9)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(0, 200)))) for i in range(60)]
    items += [(100, " ".join(word() for _ in range(9000))), (101, None), (102, "")]
    blocks = list(decontaminate._blocks(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 10))
    assert len(blocks) > 10
    found = set()
    for block in blocks:
        phrases = decontaminate.Phrases(block, 10)
        assert phrases.nbytes <= 40_000 and len(pickle.dumps(vars(phrases), -1)) <= 44_000
        for p in range(len(phrases.symbols)):
            found |= {(phrases.bytes_of(p), item) for item in phrases.items(p)}
    want = set()
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        want |= {("".join(w[i : i + n]).encode(), str(item)) for i in range(len(w) - n + 1 if n else 0)}
    assert found == want


def test_clean_cuts_until_nothing_is_left(spark):
    docs = [
        (1, "keep one two three four five end"),
        (2, "one two one two three four three four tail"),  # the cut brings new neighbours together
        (3, "One, two; THREE four"),
        (4, "nothing here"),
        (5, None),
    ]
    items = [(1, "one two three four")]
    cleaned = decontaminate.clean(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=4,
    )
    got = {r.doc_id: r.text for r in cleaned.collect()}
    assert got == {1: "keep \n five end", 2: "\n tail", 4: "nothing here", 5: None} or got[2].split() == ["tail"]
    assert 3 not in got and cleaned.columns == ["doc_id", "text"]


def test_odd_rows(odd_docs, spark):
    items = spark.createDataFrame([(1, "word5 the 5")], "item_id long, text string")
    rows = decontaminate.find(odd_docs, items).collect()
    assert len(rows) == odd_docs.count()
    assert {r.row.doc_id for r in rows if r.spans} == {4, 5}
    assert decontaminate.find(odd_docs, items.limit(0)).filter("size(spans) > 0").count() == 0
    assert decontaminate.find(odd_docs.limit(0), items).count() == 0
    assert decontaminate.clean(odd_docs, items).columns == odd_docs.columns


def test_suffix_ranks_and_index():
    rng = np.random.default_rng(0)
    for _ in range(40):
        seq = np.append(rng.integers(0, 4, rng.integers(0, 60)), 0)
        # each separator is a symbol of its own
        order = [[(0, j) if s == 0 else (1, s) for j, s in enumerate(seq)][i:] for i in range(len(seq))]
        want = np.argsort(sorted(range(len(seq)), key=lambda i: order[i]))
        assert suffix_ranks(seq).tolist() == want.tolist()
        index = FMIndex(seq, 3)
        phrases = rng.integers(1, 4, (12, 3))
        lengths = rng.integers(1, 4, 12)
        got = {}
        for p, lo, hi in zip(*index.search(phrases, lengths)):
            got[int(p)] = sorted(index.locate(np.arange(lo, hi)).tolist())
        for p in range(12):
            phrase = phrases[p, : lengths[p]].tolist()
            places = [i for i in range(len(seq)) if seq[i : i + len(phrase)].tolist() == phrase]
            assert got.get(p, []) == places
