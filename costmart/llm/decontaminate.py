"""Benchmark decontamination by an FM-index over each training shard.

A shard is a run of documents of a scan task (a few MB of text, or one longer
document), so building needs no shuffle and memory is bounded by the shard and
not by the table. The benchmark's windows are the stated query set: they go to
the tasks in blocks of bounded size, one pass over the documents a block.

In each shard the windows are searched backward through wavelet-tree ranks,
occurrences are located by sampled suffix positions, verified byte by byte and
merged to removal spans.

Defined results: null and empty texts have no words and no spans; an item
without words has no window; repeated items and rows count each for itself
(equal ids of items once); an item with null id marks words but is not listed;
an empty benchmark finds nothing; an empty table gives an empty result. Other
columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, utf8, written
from .fmindex import FMIndex

BLOCK_BYTES = 32 << 20  # of windows that one pass searches, as sent to the tasks
WORD_BYTES = 34  # of a block for each word, beside the symbols of its window and its text
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SHARD_BYTES = 3 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_byte = np.arange(256)
IS_WORD = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
IS_WORD |= (_byte >= 0x41) & (_byte <= 0x5A)
LOWER = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte).astype(np.uint8)


class Words:
    """The words of several texts: byte bounds, hash, owner; A-Z lower-cased."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n_texts = len(offsets) - 1
        text = LOWER[np.insert(data, offsets, 0)]  # a zero before each text and at the end
        begin = offsets + np.arange(n_texts + 1)  # of that zero
        inside = IS_WORD[text]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = edge[0::2], edge[1::2]
        power = np.full(len(text), BASE)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        sums = np.empty(len(text) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power, out=sums[1:])
        back = np.full(len(text), BASE_INVERSE)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        self.hash = (sums[end] - sums[start]) * back[start]
        self.length = end - start
        self.owner = np.searchsorted(begin, start, "right") - 1
        self.bounds = np.searchsorted(self.owner, np.arange(n_texts + 1))  # first word of each text
        self.start = start - begin[self.owner] - 1  # byte places inside the own text
        self.end = end - begin[self.owner] - 1
        self.packed = text[inside].tobytes()
        self.packed_at = np.concatenate(([0], np.cumsum(self.length)))

    def run(self, first: int, last: int) -> bytes:
        """The bytes of words first to last - 1, without what stands between."""
        return self.packed[self.packed_at[first] : self.packed_at[last]]


class Phrases:
    """The distinct windows of a block of benchmark items, in flat arrays.

    ``symbols`` (windows, words): vocabulary numbers from 1; ``vocabulary``: the
    words' bytes one after the other, in the order of their numbers; ``item_of``:
    places in ``names`` of the items of each window.
    """

    def __init__(self, items: list[tuple], window: int):
        raw = [(text or "").encode() for _, text in items]
        data = np.frombuffer(b"".join(raw), np.uint8)
        words = Words(data, np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64))
        ids: dict[bytes, int] = {}
        numbers = np.array([ids.setdefault(words.run(w, w + 1), len(ids)) for w in range(len(words.hash))], np.int64)
        hashes = np.zeros(len(ids), np.uint64)
        hashes[numbers] = words.hash
        order = np.argsort(hashes)
        spelled = list(ids)
        self.hash = hashes[order]
        self.vocabulary = b"".join(spelled[i] for i in order.tolist())
        self.word_at = np.concatenate(([0], np.cumsum([len(spelled[i]) for i in order.tolist()]))).astype(np.int64)
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(1, len(ids) + 1)
        text = place[numbers] if len(numbers) else np.zeros(0, np.int32)
        # all windows of all items, short ones padded with zeros
        size = np.diff(words.bounds)
        width = np.minimum(size, window)
        count = np.where(size > 0, size - width + 1, 0)
        item = np.repeat(np.arange(len(items)), count)
        first = words.bounds[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        at = first[:, None] + np.arange(window)
        used = np.arange(window) < width[item][:, None]
        rows = np.where(used, text[np.minimum(at, max(0, len(text) - 1))] if len(text) else 0, 0).astype(np.int32)
        self.symbols, of = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        self.lengths = (self.symbols > 0).sum(axis=1)
        self.names = sorted({str(i) for i, _ in items if i is not None})
        number = {name: k for k, name in enumerate(self.names)}
        named = np.array([-1 if i is None else number[str(i)] for i, _ in items], np.int64)[item] if len(item) else item
        pairs = np.unique(np.stack((of.ravel(), named), axis=1), axis=0) if len(item) else np.zeros((0, 2), np.int64)
        pairs = pairs[pairs[:, 1] >= 0]
        self.item_of = pairs[:, 1].astype(np.int32)
        self.item_at = np.searchsorted(pairs[:, 0], np.arange(len(self.symbols) + 1)).astype(np.int32)

    @classmethod
    def of(cls, fields: dict) -> "Phrases":
        """From the plain fields that a broadcast carries."""
        self = cls.__new__(cls)
        self.__dict__.update(fields)
        return self

    @property
    def nbytes(self) -> int:
        arrays = (self.hash, self.word_at, self.symbols, self.lengths, self.item_of, self.item_at)
        return sum(a.nbytes for a in arrays) + len(self.vocabulary) + sum(len(n) for n in self.names)

    def bytes_of(self, phrase: int) -> bytes:
        """The words of a window, without what stands between."""
        spans = [(self.word_at[s - 1], self.word_at[s]) for s in self.symbols[phrase, : self.lengths[phrase]].tolist()]
        return b"".join(self.vocabulary[a:b] for a, b in spans)

    def items(self, phrase: int) -> list[str]:
        return [self.names[i] for i in self.item_of[self.item_at[phrase] : self.item_at[phrase + 1]].tolist()]

    def numbers(self, words: Words) -> np.ndarray:
        """Vocabulary numbers of words, 0 for unknown ones."""
        if not len(self.hash):
            return np.zeros(len(words.hash), np.int64)
        at = np.minimum(np.searchsorted(self.hash, words.hash), len(self.hash) - 1)
        known = (self.hash[at] == words.hash) & (np.diff(self.word_at)[at] == words.length)
        return np.where(known, at + 1, 0)


def occurrences(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase number, first word) of every occurrence of a phrase in the shard."""
    none = np.zeros(0, np.int64)
    number = phrases.numbers(words)
    known = np.flatnonzero(number)
    if not len(known):
        return none, none
    opens = np.ones(len(known), np.int64)  # a separator stands before it
    opens[1:] = (known[1:] != known[:-1] + 1) | (words.owner[known[1:]] != words.owner[known[:-1]])
    place = np.cumsum(opens + 1) - 1
    seq = np.zeros(int(place[-1]) + 2, np.int64)
    seq[place] = number[known]
    word = np.full(len(seq), -1, np.int64)
    word[place] = known
    index = FMIndex(seq, len(phrases.hash))
    phrase, lo, hi = index.search(phrases.symbols, phrases.lengths)
    if not len(phrase):
        return none, none
    count = hi - lo
    each = np.repeat(phrase, count)
    rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    first = word[index.locate(rows)]
    spelled = {p: phrases.bytes_of(p) for p in phrase.tolist()}
    same = [
        words.run(f, f + n) == spelled[p]
        for p, f, n in zip(each.tolist(), first.tolist(), phrases.lengths[each].tolist())
    ]
    same = np.array(same, bool)
    return each[same], first[same]


def _shard(words: Words, phrases: Phrases) -> tuple[np.ndarray, dict[int, set]]:
    """Which words are hit, and the items found by text."""
    phrase, first = occurrences(words, phrases)
    turn = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(turn, first, 1)
    np.add.at(turn, first + phrases.lengths[phrase], -1)
    items: dict[int, set] = {}
    if len(first):
        pairs = np.unique(np.stack((words.owner[first], phrase), axis=1), axis=0)
        for text, p in pairs.tolist():
            items.setdefault(text, set()).update(phrases.items(p))
    return np.cumsum(turn[:-1]) > 0, items


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return list(zip(edge[0::2].tolist(), edge[1::2].tolist()))


def _parts(item, text: str, window: int) -> Iterator[tuple]:
    """(item, text, size in a block) of an item, cut where it alone would fill a block."""
    of_word = 4 * window + WORD_BYTES
    words = WORD.findall(text)
    room = max(1, BLOCK_BYTES // (2 * of_word))  # windows of a part
    count = max(1, len(words) - window + 1)
    if count <= room or of_word * len(words) + len(text.encode()) <= BLOCK_BYTES:
        yield item, text, of_word * len(words) + len(text.encode())
        return
    for i in range(0, count, room):
        part = " ".join(words[i : min(i + room, count) + window - 1])
        yield item, part, of_word * (min(i + room, count) - i + window) + len(part.encode())


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[list[tuple]]:
    """The benchmark in blocks of at most BLOCK_BYTES as sent; at least one, maybe empty."""
    block, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    for row, text in rows.filter(F.col(text_col).isNotNull()).toLocalIterator():
        for item, part, part_size in _parts(row, text, window):
            if block and size + part_size > BLOCK_BYTES:
                yield block
                block, size = [], 0
            block.append((item, part))
            size += part_size
    yield block


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", carry_text: bool = False) -> DataFrame:
    """One row per document: (row, text, n_words, spans, items).

    row: struct of the document's other columns. text: the text, null unless
    ``carry_text``. spans: merged (first, last + 1) of hit words with their byte
    bounds. items: ids, as strings, of the items with occurring windows.
    """
    others = [c for c in docs.columns if c != text_col]
    empty_spans = F.array().cast("array<struct<first:long,last:long,byte_first:long,byte_last:long>>")
    state = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.col(text_col).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        empty_spans.alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    blocks = _blocks(benchmark, item_id, item_text, window)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        phrases = docs.sparkSession.sparkContext.broadcast(vars(Phrases(block, window)))
        state = state.mapInArrow(_pass(phrases, carry_text or following is not None), state.schema)
        if following is not None:  # one block is held at a time
            state = written(state, "decontaminate")
            phrases.destroy()
        block = following
    return state


def _pass(phrases, carry_text: bool):
    span_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "byte_first", "byte_last")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Phrases.of(phrases.value)
        for batch in chunks(batches, "text", SHARD_BYTES):
            data, offsets, _ = utf8(batch.column(1))
            words = Words(data, offsets)
            hit, items = _shard(words, known)
            spans, names = [], []
            for k, (old, old_items) in enumerate(zip(batch.column(3), batch.column(4))):
                a, b = words.bounds[k], words.bounds[k + 1]
                here = hit[a:b].copy()
                for s in old.as_py() if len(old) else ():
                    here[s["first"] : s["last"]] = True
                ends = _spans(here) if here.any() else []
                spans.append([
                    {"first": f, "last": n, "byte_first": int(words.start[a + f]), "byte_last": int(words.end[a + n - 1])}
                    for f, n in ends
                ])
                names.append(sorted(items.get(k, set()).union(old_items.as_py() if len(old_items) else ())))
            text = batch.column(1) if carry_text else pa.nulls(batch.num_rows, batch.schema.field(1).type)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    text,
                    pa.array(np.diff(words.bounds)),
                    pa.array(spans, span_type),
                    pa.array(names, pa.list_(pa.string())),
                ],
                names=["row", "text", "n_words", "spans", "items"],
            )

    return run


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with the hit spans cut out of the text, each replaced by a line break.

    Documents all of whose words are hit go. Cutting is repeated on the cut
    documents until no window is left, as a cut may bring new neighbours
    together. Clean documents are returned as they are.
    """
    columns = docs.columns

    def unpacked(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`")) for c in columns])

    found = written(
        find(docs, benchmark, window, text_col, item_id, item_text, carry_text=True), "decontaminate-found"
    )
    keep = unpacked(found.filter(F.size("spans") == 0))
    hit_words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    while True:
        cut = found.filter((F.size("spans") > 0) & (hit_words < F.col("n_words")))
        if cut.isEmpty():
            return keep
        found = written(
            find(unpacked(cut.withColumn("text", _without_spans())), benchmark, window, text_col, item_id, item_text,
                 carry_text=True),
            "decontaminate-found",
        )
        keep = keep.union(unpacked(found.filter(F.size("spans") == 0)))


def _without_spans():
    """The text's bytes outside the spans, as text, with a line break for each span."""
    raw = F.col("text").cast("binary")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["byte_last"]))
    ends = F.concat(F.transform("spans", lambda s: s["byte_first"]), F.array(F.octet_length("text").cast("long")))
    parts = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda p: F.substring(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")).cast("string"),
    )
    return F.array_join(parts, "\n")
