import zlib

import numpy as np
import pytest
from costmart.llm import language_id as lid

SF = "/root/testdata/sf0.001"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in lid.start_weights(3).items()}
    frames = rng.integers(0, 256, (5, 4, lid.FRAME)).astype(np.uint8)
    labels = np.array([0, 2, 1, 2])
    _, grad = lid._gradients(w, frames, labels)
    for name in w:
        flat = np.argsort(-np.abs(grad[name].ravel()))[:4]
        for i in flat:
            place = np.unravel_index(i, w[name].shape)
            kept, step = w[name][place], 1e-5
            loss = []
            for x in (kept + step, kept - step):
                w[name][place] = x
                loss.append(lid._gradients(w, frames, labels)[0])
            w[name][place] = kept
            assert (loss[0] - loss[1]) / (2 * step) == pytest.approx(grad[name][place], rel=2e-3, abs=1e-6)


def test_segments_and_order_do_not_matter(monkeypatch):
    """Prediction side by side equals reading each segment alone, position by position."""
    rng = np.random.default_rng(1)
    w = lid.start_weights(3, seed=4)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 1, 3, 4, 5, 1024, 1025, 2500, 60)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    monkeypatch.setattr(lid, "LANES", 3)
    got = lid.predict(w, data, offsets)
    for k, text in enumerate(texts):
        total = np.zeros(3)
        for a in range(0, len(text), lid.SEGMENT * lid.FRAME):
            part = text[a : a + lid.SEGMENT * lid.FRAME]
            steps = -(-len(part) // lid.FRAME)
            frames = np.frombuffer(part.ljust(steps * lid.FRAME, b"\0"), np.uint8).reshape(steps, 1, lid.FRAME)
            state, forward, backward = np.zeros((2, 1, lid.HIDDEN), np.float32), [], []
            for t in range(steps):
                state = lid._step(w, lid._inputs(w, np.stack((frames[t], frames[steps - 1 - t]))), state)[0]
                forward.append(state[0, 0])
                backward.insert(0, state[1, 0])
            for t in range(steps):
                for j in range(min(lid.FRAME, len(part) - t * lid.FRAME)):  # every byte has a label of its own
                    columns = slice(3 * j, 3 * j + 3)
                    z = forward[t] @ w["out"][0][:, columns] + backward[t] @ w["out"][1][:, columns] + w["out_bias"][j]
                    total += lid._softmax(z)
        assert got[k] == pytest.approx(total / max(1, len(text)), abs=1e-4)


def test_held_out_accuracy(spark):
    """Learned from documents that are not held out, right on at least 95 % of those that are."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lid.identify(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.row.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.row.lang]
    assert sum(r.lang_pred == r.row.lang for r in held) / len(held) >= 0.95


def test_held_out_labels_are_not_learned(spark, docs_of):
    """Changing them changes no sample."""
    rows = [(i, f"text number {i} of these", "en" if i % 2 else "de", "s") for i in range(60)]
    other = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else la, s) for i, t, la, s in rows]
    args = ("doc_id", "text", "lang", 40)
    assert lid.sample(docs_of(rows), *args) == lid.sample(docs_of(other), *args)


def test_sample_is_bounded_and_distinct(spark, docs_of):
    rows = [(i, "the same text" if i % 3 else f"text {i}", "en", "s") for i in range(300)]
    found = lid.sample(docs_of(rows), "doc_id", "text", "lang", 20)
    assert len(found) == 20 and len(set(found)) == 20


def test_a_hot_language_is_not_ranked_whole(spark, docs_of, monkeypatch):
    """A window over a language's hashes meets a bounded number of them."""
    rows = [(i, f"text {i}", "de" if i % 20 == 0 else "en", "s") for i in range(4000)]
    seen = []
    plain = lid.Window.partitionBy

    def watched(*keys):
        seen.append(keys)
        return plain(*keys)

    monkeypatch.setattr(lid.Window, "partitionBy", staticmethod(watched))
    found = lid.sample(docs_of(rows), "doc_id", "text", "lang", 40)
    assert seen == [("lang",)] and len(found) == 40 and sum(la == "de" for la, _ in found) == 20
    hashes = {la: [r.h for r in spark.createDataFrame([(t,) for _, t, x, _ in rows if x == la], "t string").selectExpr(
        "pmod(xxhash64(t), 1073741824) h").collect()] for la in ("en", "de")}
    for la, n in (("en", 3800), ("de", 200)):
        below = min(1.0, 1.25 * 20 / n + 16 / n) * (1 << 30)
        assert sum(h < below for h in hashes[la]) < 120


def test_odd_rows(odd_docs, docs_of, monkeypatch):
    monkeypatch.setattr(lid.train, "__defaults__", (20, 5))
    rows = lid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.row.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by_id[2].score == 0
    assert by_id[8].lang_pred != "und" and not by_id[None].held_out
    assert lid.identify(odd_docs.limit(0)).count() == 0
    unlabelled = lid.identify(docs_of([(1, "some text", None, None)])).collect()
    assert unlabelled[0].lang_pred == "und" and unlabelled[0].score == 0
