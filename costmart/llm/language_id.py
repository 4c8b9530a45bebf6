"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read four a step, forward and backward, by two gated
recurrent layers; at every step their states label each of the step's four byte
positions by an output layer of its own, and the probabilities of all
positions are averaged over the whole text. Texts are cut
into segments of SEGMENT steps so that many run side by side; every byte of
every text is read.

Training is backpropagation through time in numpy on the driver, on at most
``sample_rows`` distinct labelled texts (the same number for each language,
chosen by hash), of each a stretch of at most PIECE characters. Prediction
runs in the tasks with the weights (some 200 KB) broadcast.

Defined results: null texts and texts without a letter are ``und`` with score
0, as is everything if nothing is labelled; repeated rows repeat their result;
an empty table gives an empty result. Only the text enters a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, utf8

FRAME = 4  # bytes a step
HIDDEN = 8
SEGMENT = 256  # steps
LANES = 512  # segments side by side
PIECE = 800  # characters
TRAIN_STEPS = 64
BATCH = 96
UPDATES = 350
RATE = 0.03
SAMPLE_ROWS = 4096
UNDETERMINED = "und"


def start_weights(classes: int, seed: int = 11) -> dict[str, np.ndarray]:
    """Both directions share each array's first axis."""
    rng = np.random.default_rng(seed)
    h = HIDDEN
    return {
        "bytes": rng.normal(0, 0.3, (2, FRAME, 256, 3 * h)).astype(np.float32),
        "gates": rng.normal(0, h**-0.5, (2, h, 2 * h)).astype(np.float32),
        "state": rng.normal(0, h**-0.5, (2, h, h)).astype(np.float32),
        "bias": np.zeros((2, 1, 3 * h), np.float32),
        "out": rng.normal(0, h**-0.5, (2, h, FRAME * classes)).astype(np.float32),
        "out_bias": np.zeros((FRAME, classes), np.float32),
    }


def _inputs(w: dict, frames: np.ndarray) -> np.ndarray:
    """Input part of the gates for frames (2, lanes, FRAME)."""
    both = []
    for d in (0, 1):
        x = w["bytes"][d, 0].take(frames[d, :, 0], axis=0)
        for j in range(1, FRAME):
            x += w["bytes"][d, j].take(frames[d, :, j], axis=0)
        both.append(x)
    return np.stack(both) + w["bias"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def _step(w: dict, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """(new state, update gate, reset gate, candidate, recurrent part of the candidate)."""
    h = HIDDEN
    gates = _sigmoid(x[..., : 2 * h] + state @ w["gates"])
    update, reset = gates[..., :h], gates[..., h:]
    inner = state @ w["state"]
    candidate = np.tanh(x[..., 2 * h :] + reset * inner)
    return candidate + update * (state - candidate), update, reset, candidate, inner


def _softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    return x / x.sum(axis=-1, keepdims=True)


def _labels(w: dict, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """(steps, lanes, FRAME, classes): class probabilities of every byte position."""
    both = forward @ w["out"][0] + backward @ w["out"][1]
    return _softmax(both.reshape(*both.shape[:-1], *w["out_bias"].shape) + w["out_bias"])


def _gradients(w: dict, frames: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean loss over all positions of ``frames`` (steps, lanes, FRAME), and its gradients."""
    steps, lanes, _ = frames.shape
    h = HIDDEN
    turned = np.stack((frames, frames[::-1]), axis=1)  # (steps, 2, lanes, FRAME)
    states = [np.zeros((2, lanes, h), np.float32)]
    kept = []
    for t in range(steps):
        new, *rest = _step(w, _inputs(w, turned[t]), states[-1])
        states.append(new)
        kept.append(rest)
    forward = np.stack([s[0] for s in states[1:]])
    backward = np.stack([s[1] for s in states[1:]])[::-1]
    p = _labels(w, forward, backward)
    rows = np.arange(lanes)
    loss = float(-np.log(p[:, rows, :, labels] + 1e-9).mean())
    p[:, rows, :, labels] -= 1
    p /= steps * lanes * FRAME
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["out_bias"] = p.sum(axis=(0, 1))
    p = p.reshape(steps, lanes, -1)
    grad["out"][0] = np.einsum("tbh,tbc->hc", forward, p)
    grad["out"][1] = np.einsum("tbh,tbc->hc", backward, p)
    to_forward, to_backward = p @ w["out"][0].T, (p @ w["out"][1].T)[::-1]
    carry = np.zeros((2, lanes, h), np.float32)
    gates_t, state_t = w["gates"].transpose(0, 2, 1), w["state"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        update, reset, candidate, inner = kept[t]
        before = states[t]
        d = carry + np.stack((to_forward[t], to_backward[t]))
        d_candidate = d * (1 - update) * (1 - candidate**2)
        d_update = d * (before - candidate) * update * (1 - update)
        d_reset = d_candidate * inner * reset * (1 - reset)
        d_inner = d_candidate * reset
        d_gates = np.concatenate((d_update, d_reset), axis=-1)
        past = before.transpose(0, 2, 1)
        grad["gates"] += past @ d_gates
        grad["state"] += past @ d_inner
        d_x = np.concatenate((d_gates, d_candidate), axis=-1)
        grad["bias"] += d_x.sum(axis=1, keepdims=True)
        for way in (0, 1):
            for j in range(FRAME):
                np.add.at(grad["bytes"][way, j], turned[t, way, :, j], d_x[way])
        carry = d * update + d_gates @ gates_t + d_inner @ state_t
    return loss, grad


def train(texts: list[bytes], labels: list[int], classes: int, updates: int = UPDATES, seed: int = 5) -> dict:
    """Weights fitted to labelled texts by Adam on random stretches; every class is drawn alike."""
    rng = np.random.default_rng(seed)
    w = start_weights(classes)
    by_class = [[t for t, y in zip(texts, labels) if y == c and t] for c in range(classes)]
    usable = [c for c in range(classes) if by_class[c]]
    if len(usable) < 2:
        return w
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    size = TRAIN_STEPS * FRAME
    for n in range(1, updates + 1):
        y = np.array([usable[i] for i in rng.integers(0, len(usable), BATCH)])
        lanes = np.zeros((BATCH, size), np.uint8)
        for lane, c in zip(lanes, y):
            text = by_class[c][rng.integers(len(by_class[c]))]
            at = int(rng.integers(0, max(1, len(text) - size + 1)))
            part = np.frombuffer(text[at : at + size], np.uint8)
            lane[:] = np.resize(part, size)  # short texts repeat
        _, grad = _gradients(w, lanes.reshape(BATCH, TRAIN_STEPS, FRAME).transpose(1, 0, 2), y)
        rate = RATE * min(1.0, 3 * (1 - n / (updates + 1)))
        for k in w:
            first[k] += 0.1 * (grad[k] - first[k])
            second[k] += 0.01 * (grad[k] ** 2 - second[k])
            move = first[k] / (1 - 0.9**n) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-7)
            w[k] -= (rate * move).astype(np.float32)
    return w


def _label(w: dict, frames: np.ndarray, steps: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Sum of the positions' probabilities for each lane.

    frames (lanes, SEGMENT, FRAME); steps: used ones of each lane, falling;
    used (lanes, SEGMENT, FRAME): whether a position holds a byte.
    """
    lanes, longest = len(frames), int(steps[0])
    order = np.arange(longest)
    turned = np.maximum(steps[:, None] - 1 - order[None, :], 0)  # step that the backward layer reads at a time
    rows = np.arange(lanes)[:, None]
    both = np.stack((frames[:, :longest], frames[rows, turned])).transpose(2, 0, 1, 3).copy()
    alive = np.searchsorted(-steps, -order, "left")
    state = np.zeros((2, lanes, HIDDEN), np.float32)
    forward = np.zeros((longest, lanes, HIDDEN), np.float32)
    backward = np.zeros((longest, lanes, HIDDEN), np.float32)
    for t in range(longest):
        n = int(alive[t])
        state = _step(w, _inputs(w, both[t, :, :n]), state[:, :n])[0]
        forward[t, :n], backward[t, :n] = state[0], state[1]
    aligned = backward[turned.T, np.arange(lanes)[None, :]]
    p = _labels(w, forward, aligned)
    return np.einsum("tlfc,ltf->lc", p, used[:, :longest].astype(np.float32))


def predict(w: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Class probabilities of each text, averaged over its bytes (zero for empty texts)."""
    classes = w["out_bias"].shape[1]
    size = np.diff(offsets)
    total = np.zeros((len(size), classes))
    width = SEGMENT * FRAME
    pieces = -(-size // width)
    owner = np.repeat(np.arange(len(size)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = offsets[owner] + nth * width
    count = np.minimum(width, offsets[owner + 1] - start)
    order = np.argsort(-count, kind="stable")
    padded = np.concatenate((data, np.zeros(width, np.uint8)))
    for i in range(0, len(order), LANES):
        lot = order[i : i + LANES]
        longest = -(-int(count[lot[0]]) // FRAME) * FRAME
        at = start[lot][:, None] + np.arange(longest)[None, :]
        used = np.arange(longest)[None, :] < count[lot][:, None]
        frames = np.where(used, padded[at], 0).reshape(len(lot), -1, FRAME)
        np.add.at(total, owner[lot], _label(w, frames, -(-count[lot] // FRAME), used.reshape(frames.shape)))
    return total / np.maximum(size, 1)[:, None]


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: the id's checksum leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int) -> list[tuple[str, bytes]]:
    """At most ``rows`` labelled texts to learn from: as many distinct ones of each language, by hash."""
    text = F.col(f"`{text_col}`").cast("string")
    labelled = docs.filter(F.col(f"`{id_col}`").isNotNull() & ~held_out(id_col)).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), text.alias("text"), F.xxhash64(text).alias("h")
    )
    labelled = labelled.filter("lang is not null and text is not null and text rlike '\\\\p{L}'")
    # equal texts count once; a row a language comes back
    hashes = labelled.select("lang", "h").distinct()
    counts = hashes.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(rows).collect()
    if not counts:
        return []
    each = max(1, rows // len(counts))
    # of each language the share of hashes that leaves a few more than ``each``, then the smallest
    # of those: what the window ranks is bounded, however many texts a language has
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(1.0, 1.25 * each / r["n"] + 16 / r["n"]) * (1 << 30))) for r in counts], "lang string, below long"
    )
    some = hashes.join(F.broadcast(shares), "lang").filter(F.pmod("h", F.lit(1 << 30)) < F.col("below")).select("lang", "h")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))
    chosen = some.withColumn("nth", nth).filter(F.col("nth") <= each).select("lang", "h").limit(rows)
    at = F.pmod(F.col("h"), F.greatest(F.length("text") - PIECE, F.lit(1)).cast("long")).cast("int") + 1
    piece = F.col("text").substr(at, F.lit(PIECE))
    # broadcast: at most ``rows`` rows
    found = labelled.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", piece.alias("piece"))
    found = found.groupBy("lang", "h").agg(F.min("piece").alias("piece")).orderBy("lang", "h")
    return [(r["lang"], r["piece"].encode()) for r in found.collect()]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(row, held_out, lang_pred, score) of every row; row is a struct of all columns."""
    spark = docs.sparkSession
    learned = sample(docs, id_col, text_col, lang_col, sample_rows)
    names = sorted({lang for lang, _ in learned})
    weights = train([t for _, t in learned], [names.index(lang) for lang, _ in learned], len(names))
    sent = spark.sparkContext.broadcast((weights, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, langs = sent.value
        for batch in chunks(batches, "text"):
            readable = batch.column(2).to_numpy(zero_copy_only=False)
            text = batch.column(3)
            if langs and readable.any():
                p = predict(w, *utf8(text)[:2])
                best = p.argmax(axis=1)
                score = np.where(readable, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
                lang = [langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), readable.tolist())]
            else:
                score, lang = np.zeros(batch.num_rows), [UNDETERMINED] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)],
                names=["row", "held_out", "lang_pred", "score"],
            )

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        held_out(id_col).alias("held_out"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("readable"),
        text.alias("text"),
    )
    schema = rows.select("row", "held_out").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)
