"""Quality scores from random-indexing word vectors and a small network.

Words are runs of letters (bytes above 0x7F count as letters), runs of digits,
and runs of one punctuation byte, as written. Every word has an index vector:
NONZERO entries of +1 or -1 at places its hash gives. A word's own vector is the
sum of the index vectors of the words within WINDOW places of it, over all
occurrences in the whole table: one pass adds them up in each task, and the
sums meet by word slot. Words share ``slots`` rows by hash, so the vectors take
``slots * DIMS`` numbers however large the corpus is (broadcast: 4 MB); every
occurrence of every word counts. Expected contexts are taken off the sums and
the rows brought to unit length.

A text is pooled to the mean and the standard deviation of its words' vectors.
A network of two layers, trained in numpy on the driver on at most
``sample_rows`` labelled texts (by hash; pooled numbers come to the driver, not
texts), turns these into a number, and a temperature fitted on labelled texts
that training left out turns it into a probability.

Defined results: null, empty and blank texts pool to zeros and are scored like
any other; labelled rows without id, text or label do not teach; an id labelled
both ways teaches both; labels other than 0 and 1 do not teach; without
labels of two kinds every score is the share of label 1 (0.5 without any);
repeated rows repeat their result; of rows that share a labelled id the least
text teaches; texts of more than PIECE bytes are read in pieces of that size,
cut between words where there are any, and windows do not cross the cuts; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import chunks, utf8

DIMS = 32
NONZERO = 4
WINDOW = 2
SLOTS = 1 << 15
PIECE = 1 << 20  # bytes read at a time
SAMPLE_ROWS = 8192
HIDDEN = 24
UPDATES = 600
BATCH = 256
RATE = 0.02
PRIOR = 8.0  # weight decay times training rows
THRESHOLD = 0.7

# byte kinds: 0 space, 1 letter, 2 digit, 3 and up one kind for each punctuation byte
KINDS = np.array(
    [0 if b in b" \t\n\v\f\r" else 1 if chr(b).isalpha() or b > 127 else 2 if 48 <= b < 58 else 3 + b for b in range(256)],
    np.int16,
)
STEP = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(2 * PIECE, base, np.uint64))))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of STEP and of its inverse (modulo 2^64), once a worker."""
    return _powers(int(STEP)), _powers(pow(int(STEP), -1, 1 << 64))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of each word of at most 2 * PIECE bytes."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    kind = KINDS[data]
    edge = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])))
    stop = np.append(edge[1:], len(data))
    keep = kind[edge] != 0
    start, stop = edge[keep], stop[keep]
    # running sums of (byte + 1) * STEP^place; a word's part of them is brought back to place 0
    power, inverse = _tables()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    h = (sums[stop] - sums[start]) * inverse[start]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return start, h ^ (h >> np.uint64(31))


def pieces(text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hash) of the words of texts that end in white space, some at a time."""
    data, offsets, _ = utf8(text)
    first = 0
    while first < len(data):
        stop = min(len(data), first + PIECE)
        if stop < len(data):
            kind = KINDS[data[first : stop + 1]]
            change = np.flatnonzero(kind[1:] != kind[:-1])
            stop = first + int(change[-1]) + 1 if len(change) else stop
        start, h = words(data[first:stop])
        yield np.searchsorted(offsets, start + first, "right") - 1, h
        first = stop


def slots_of(h: np.ndarray, slots: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(slots)).astype(np.int64)


def index_vector(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs), each (words, NONZERO), of the words' index vectors."""
    j = np.arange(NONZERO, dtype=np.uint64)
    place = (h[:, None] >> (j * np.uint64(5))) % np.uint64(DIMS)
    sign = 1 - 2 * ((h[:, None] >> (np.uint64(32) + j)) & np.uint64(1)).astype(np.int64)
    return place.astype(np.int64), sign


def add_contexts(total: np.ndarray, owner: np.ndarray, h: np.ndarray) -> None:
    """Add to each word's row of ``total`` (slots, DIMS) the index vectors of its neighbours."""
    slot = slots_of(h, len(total)) * DIMS
    place, sign = index_vector(h)
    at, what = [], []
    for k in range(1, WINDOW + 1):
        near = np.flatnonzero(owner[k:] == owner[:-k])
        for word, other in ((near, near + k), (near + k, near)):
            at.append((slot[word][:, None] + place[other]).ravel())
            what.append(sign[other].ravel())
    if at and sum(map(len, at)):
        sums = np.bincount(np.concatenate(at), np.concatenate(what), minlength=total.size)
        total += sums.astype(np.int64).reshape(total.shape)


def word_vectors(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Rows of unit length: the contexts less those expected of a word that often."""
    expected = counts[:, None] * (total.sum(axis=0) / max(1, counts.sum()))
    rows = total - expected
    return (rows / (np.linalg.norm(rows, axis=1, keepdims=True) + 1.0)).astype(np.float32)


def pool(vectors: np.ndarray, text: pa.Array) -> np.ndarray:
    """(texts, 2 * DIMS): mean and standard deviation of each text's word vectors."""
    n = np.zeros(len(text))
    sums = np.zeros((len(text), 2 * DIMS))
    for owner, h in pieces(text):
        if not len(owner):
            continue
        rows = vectors[slots_of(h, len(vectors))]
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        n[owner[first]] += np.diff(np.append(first, len(owner)))
        sums[owner[first], :DIMS] += np.add.reduceat(rows, first, axis=0, dtype=np.float64)
        sums[owner[first], DIMS:] += np.add.reduceat(rows * rows, first, axis=0, dtype=np.float64)
    sums /= np.maximum(n, 1)[:, None]
    sums[:, DIMS:] = np.sqrt(np.maximum(sums[:, DIMS:] - sums[:, :DIMS] ** 2, 0))
    return sums


class Network:
    """Pooled vectors to a calibrated probability of label 1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7, updates: int = UPDATES):
        """Four of five rows teach the network, the fifth its temperature."""
        self.share = float(y.mean()) if len(y) else 0.5
        self.temperature = 1.0
        if len(set(y.tolist())) < 2:
            self.weights = None
            return
        kept = np.arange(len(y)) % 5 == 4
        if len(set(y[~kept].tolist())) < 2:
            kept[:] = False
        self.middle, self.width = x[~kept].mean(axis=0), x[~kept].std(axis=0) + 1e-6
        self._fit((x[~kept] - self.middle) / self.width, y[~kept], np.random.default_rng(seed), updates)
        if len(set(y[kept].tolist())) == 2:
            z = self._outputs((x[kept] - self.middle) / self.width)[1]
            # few rows may all be right: their labels count as a little less than certain
            positive, negative = y[kept].sum(), (1 - y[kept]).sum()
            target = np.where(y[kept] == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
            ladder = np.exp(np.linspace(np.log(0.2), np.log(20), 200))
            self.temperature = float(min(ladder, key=lambda t: _loss(z / t, target)))

    def _outputs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights
        hidden = np.tanh(x @ w["in"] + w["in_bias"])
        return hidden, hidden @ w["out"] + w["out_bias"][0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        hidden, z = self._outputs(x)
        d = (_sigmoid(z) - y) / len(y)
        back = np.outer(d, w["out"]) * (1 - hidden**2)
        return {"in": x.T @ back, "in_bias": back.sum(axis=0), "out": hidden.T @ d, "out_bias": np.array([d.sum()])}

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, updates: int) -> None:
        self.weights = w = {
            "in": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
            "in_bias": np.zeros(HIDDEN),
            "out": rng.normal(0, HIDDEN**-0.5, HIDDEN),
            "out_bias": np.zeros(1),
        }
        first = {k: np.zeros_like(v) for k, v in w.items()}
        second = {k: np.zeros_like(v) for k, v in w.items()}
        for n in range(1, updates + 1):
            rows = rng.integers(0, len(y), min(BATCH, len(y)))
            grad = self.gradients(x[rows], y[rows])
            rate = RATE * (1 - (n - 1) / updates)
            for k in w:
                g = grad[k] + PRIOR / len(y) * w[k]
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                w[k] -= rate * first[k] / (1 - 0.9**n) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-8)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.share)
        return _sigmoid(self._outputs((x - self.middle) / self.width)[1] / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float((np.logaddexp(0, z) - y * z).mean())


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: the id's checksum leaves 2 modulo 4 (a null id: no)."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ended(text_col: str) -> Column:
    """The text with a line end, so that words of neighbouring texts do not touch; null: that alone."""
    return F.concat(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit("\n")).alias("text")


def learn_words(docs: DataFrame, text_col: str = "text", slots: int = SLOTS) -> np.ndarray:
    """Word vectors (slots, DIMS) from the contexts of all words of all texts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(slots, np.int64), np.zeros((slots, DIMS), np.int64)
        for batch in chunks(batches, "text", PIECE):
            for owner, h in pieces(batch.column(0)):
                counts += np.bincount(slots_of(h, slots), minlength=slots)
                add_contexts(total, owner, h)
        used = np.flatnonzero(counts)
        for i in range(0, len(used), 4096):
            rows = used[i : i + 4096]
            columns = [rows, counts[rows], *np.ascontiguousarray(total[rows].T)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "n", *sums])

    sums = [f"c{i}" for i in range(DIMS)]
    schema = "slot long, n long, " + ", ".join(f"{c} long" for c in sums)
    parts = docs.select(ended(text_col)).mapInArrow(add, schema)
    found = parts.groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("n", *sums)])
    # at most ``slots`` rows come to the driver
    table = found.toArrow()
    at = table.column("slot").to_numpy()
    counts, total = np.zeros(slots, np.int64), np.zeros((slots, DIMS), np.int64)
    counts[at] = table.column("n").to_numpy()
    for i, c in enumerate(sums):
        total[at, i] = table.column(c).to_numpy()
    return word_vectors(counts, total)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(id, label, text) of at most ``rows`` labelled texts that are not held out, by hash of the id."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"), held_out(id_col).alias("out"))
    known = known.filter("id is not null and label in (0, 1) and not out").select("id", "label").distinct()
    known = known.withColumn("h", F.xxhash64("id", F.lit(13)))
    # a share of the hashes that leaves a few more than ``rows``, then the least of those
    share = min(1.0, 1.25 * rows / max(1, known.count()))
    chosen = known.filter(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("h", "label").limit(rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).filter("text is not null")
    # broadcast: at most ``rows`` rows
    taught = texts.join(F.broadcast(chosen), "id")
    return taught.groupBy("id", "label").agg(F.min("text").alias("text"))


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = THRESHOLD,
    slots: int = SLOTS,
) -> DataFrame:
    """(row, held_out, score, predicted) of every row; row is a struct of all columns."""
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(learn_words(docs, text_col, slots))

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", PIECE):
            x = pool(vectors.value, batch.column(2))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 2 * DIMS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows], names=["id", "label", "x"])

    taught = sample(docs, labels, id_col, text_col, label_col, sample_rows).select("id", "label", ended("text"))
    schema = taught.select("id", "label").schema.add("x", ArrayType(DoubleType()))
    learned = taught.mapInArrow(pooled, schema).orderBy("id", "label").collect()
    x = np.array([r["x"] for r in learned], float).reshape(-1, 2 * DIMS)
    network = spark.sparkContext.broadcast(Network(x, np.array([r["label"] for r in learned], float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", PIECE):
            p = np.clip(network.value.probability(pool(vectors.value, batch.column(2))), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["row", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), held_out(id_col).alias("held_out"), ended(text_col)
    )
    schema = rows.select("row", "held_out").schema.add("score", "double").add("predicted", "integer")
    return rows.mapInArrow(run, schema)
