"""The pipeline's stages against what brute force keeps, and on odd rows."""

import corpus_pipeline
from costmart.llm import language_id, mixing, simhash
from costmart.llm.common import table, written

from test_decontaminate import brute as hits
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "identify_language", "drop_near_duplicates", "cut_benchmark", "sample_mixture", "place_in_shards",
    ]


def test_each_stage_takes_effect(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROUNDS", 2)
    docs = table(spark, SF, "documents")
    columns = docs.columns
    source = {r.doc_id: r for r in docs.collect()}

    docs = written(corpus_pipeline.identify_language(spark, docs, SF), "t1")
    assert docs.columns == columns
    letters = {i for i, r in source.items() if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in docs.collect()} == letters

    docs = written(corpus_pipeline.drop_near_duplicates(spark, docs, SF), "t2")
    fps = {i: brute_fingerprint(source[i].text) for i in letters}
    root = brute_components(sorted(set(fps.values())), 3)
    first = {}
    for i in sorted(letters):
        first.setdefault(root[fps[i]], i)
    kept = {r.doc_id for r in docs.collect()}
    assert docs.columns == columns and kept == set(first.values())

    docs = written(corpus_pipeline.cut_benchmark(spark, docs, SF), "t3")
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    before = hits([(i, source[i].text) for i in kept], items)
    rows = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and any(b[1] for b in before.values())
    assert set(rows) == {i for i, b in before.items() if b[1] < b[0] or not b[0]}
    for i, r in rows.items():
        assert r.n_chars == len(r.text)
        assert (r.text == source[i].text) == (before[i][1] == 0)
    assert not any(h[1] for h in hits([(i, r.text) for i, r in rows.items()], items).values())

    mixed = written(corpus_pipeline.sample_mixture(spark, docs, SF), "t4")
    assert mixed.columns == columns
    sampled = {r.doc_id for r in mixed.collect()}
    assert 0 < len(sampled) < len(rows) and sampled <= set(rows)

    last = written(corpus_pipeline.place_in_shards(spark, mixed, SF), "t5")
    assert {r.doc_id for r in last.collect()} == sampled
    assert set(columns) < set(last.columns) and {"shard", "slot"} <= set(last.columns)


def test_the_language_takes_effect(spark, docs_of, monkeypatch):
    """Null languages are filled from the prediction, given ones stay, and guesses go."""
    source = table(spark, SF, "documents").select("text", "lang").where("length(text) > 400").limit(120).collect()
    rows = [(i, r.text, None if i % 4 == 0 else r.lang, "s") for i, r in enumerate(source)]
    rows += [(900, "12 34 !!", "en", "s"), (901, None, "en", "s")]
    docs = docs_of(rows)
    got = {r.doc_id: r for r in corpus_pipeline.identify_language(spark, docs, SF).collect()}
    assert set(got) == set(range(len(source))) and got[1].shard == "h"
    right = [got[i].lang == source[i].lang for i in range(0, len(source), 4)]
    assert sum(right) >= 0.8 * len(right) and all(got[i].lang == source[i].lang for i in got if i % 4)
    found = language_id.identify(docs)
    scores = {r.row.doc_id: r.score for r in found.collect()}
    low = sorted(scores.values())[len(scores) // 2]
    monkeypatch.setattr(corpus_pipeline, "MIN_SCORE", low)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, SF).collect()}
    assert kept == {i for i, s in scores.items() if s >= low and i < 900}


def test_odd_rows(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(language_id.train, "__defaults__", (5, 5))
    monkeypatch.setattr(corpus_pipeline, "MIN_SCORE", 0.0)
    for rows in (odd_docs, odd_docs.limit(0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:4]:
            if stage.__name__ == "sample_mixture":
                continue  # its own tests
            docs = written(stage(spark, docs, SF), "odd")
            assert docs.columns == rows.columns
        last = corpus_pipeline.place_in_shards(spark, docs, SF)
        assert last.columns.count("shard") == last.columns.count("size") == 1
        ids = sorted(str(r.doc_id) for r in last.collect())
        assert ids == (["4", "6", "8", "None"] if rows is odd_docs else [])


def test_one_row_of_each_repeated_row(spark, docs_of):
    rows = docs_of([(1, "some words here that repeat", "en", "s")] * 5 + [(None, "other words now", "en", "s")] * 3)
    assert simhash.one_of_each(rows).count() == 2
