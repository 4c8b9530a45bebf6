"""Removal of repeated byte strings by sampled window hashing.

A position is repeated if the ``length`` bytes from it also start elsewhere.
Prefix doubling (``prefix_doubling``) ranks every position at growing offsets and
moves all of them through a sort each time, far more than the input (README).
Here positions are stood for by samples: each window of ``length`` bytes by the
smallest-hash gram of ``length / 4`` bytes in it, so equal windows have equal
samples, at equal places. Positions in a row with the same sample form a run.

1. Spark groups samples by their gram; samples that are unique are done.
2. It groups them by the gram and the whole run: runs that repeat are repeated
   throughout, and grams with one run only are done.
3. What is left (runs at the edges of copies) is compared position by position,
   by the names of both halves of its window, within the group of their gram; a
   group with many runs is not brought to one task but dealt out by those names.

Ranks are names (hashes of the bytes ranked), as only equality counts: 64 bits
where a chance match costs work, 95 bits or more where it would decide.

Every text row is named by 128 bits of its bytes, so equal texts share their
result. Defined results: null and empty texts, and those shorter than
``length``, keep all; repeated rows repeat each other and lose everything from
``length`` bytes on; an empty table gives an empty result; a very long text is
read in pieces that overlap by a window. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8, written

PIECE = 1 << 19  # bytes of text expanded at a time
GROUP_RUNS = 64  # a group of more runs is dealt out by position
RESOLVE_BYTES = 2 << 20

ODD = 0x9E3779B97F4A7C15
PRIME = (1 << 31) - 1
RADIX = 1_000_003


class Names:
    """Names of any stretch of a byte buffer: 64 bits and 31 bits, by prefix sums."""

    _table: dict[int, tuple] = {}
    _bytes = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

    def __init__(self, data: np.ndarray, second: bool = True):
        n = len(data)
        self.power, self.back, self.mod, self.mod_back = self._powers(n)
        self.sums = np.empty(n + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(self._bytes[data] * self.power[:n], out=self.sums[1:])
        if second:
            self.small = np.empty(n + 1, np.int64)
            self.small[0] = 0
            np.cumsum((data.astype(np.int64) + 1) * self.mod[:n], out=self.small[1:])

    @classmethod
    def _powers(cls, n: int) -> tuple:
        size = 1 << max(16, int(n).bit_length())
        if size not in cls._table:
            found = []
            for base in (ODD, pow(ODD, -1, 1 << 64)):
                power = np.full(size, base, np.uint64)
                power[0] = 1
                found.append(np.multiply.accumulate(power))
            for base in (RADIX, pow(RADIX, -1, PRIME)):
                # doubling, as products modulo a prime do not accumulate
                power = np.ones(1, np.int64)
                while len(power) < size:
                    power = np.concatenate((power, power * pow(base, len(power), PRIME) % PRIME))
                found.append(power[:size])
            cls._table = {size: tuple(found)}
        return cls._table[size]

    def wide(self, start, end) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def narrow(self, start, end) -> np.ndarray:
        return (self.small[end] - self.small[start]) % PRIME * self.mod_back[start] % PRIME

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:-size]) * self.back[:n]


def _mixed(name: np.ndarray) -> np.ndarray:
    name = name * np.uint64(0xD6E8FEB86659FD93)
    name ^= name >> np.uint64(32)
    return name * np.uint64(0xD6E8FEB86659FD93)


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    pad = -len(key) % width
    rows = np.concatenate((key, np.full(pad, np.iinfo(key.dtype).max, key.dtype))).reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(key) - width + 1
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def runs(data: np.ndarray, bounds: np.ndarray, length: int, names: Names) -> tuple[np.ndarray, ...]:
    """(start, positions, sample) of the runs of all windows inside ``bounds`` (starts of texts, and the end)."""
    gram = length // 4
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none
    hashes = _mixed(names.grams(gram))
    key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    sample = _sliding_min(key, length - gram + 1) & np.uint64(0xFFFFFFFF)
    change = np.flatnonzero(sample[1:] != sample[:-1]) + 1
    cuts = np.unique(np.concatenate((change, bounds, np.maximum(bounds[1:] - length + 1, bounds[:-1]))))
    cuts = cuts[cuts <= len(sample)]
    start, end = cuts[:-1], cuts[1:]
    if len(cuts) and cuts[-1] < len(sample):
        start, end = cuts, np.append(cuts[1:], len(sample))
    owner = np.searchsorted(bounds, start, "right") - 1
    inside = (owner < len(bounds) - 1) & (start + length <= bounds[np.minimum(owner + 1, len(bounds) - 1)])
    start, end = start[inside], end[inside]
    return start, end - start, sample[start].astype(np.int64)


def _pieces(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lots of (row, first byte, last byte + 1) of about PIECE bytes; longer texts in overlapping pieces."""
    lot, size = [], 0
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if b - a < length:
            continue
        for s in range(a, b - length + 1, PIECE):
            e = min(b, s + PIECE + length - 1)
            if lot and size + e - s > PIECE + length:
                yield lot
                lot, size = [], 0
            lot.append((row, s, e))
            size += e - s
    if lot:
        yield lot


def _lots(batches: Iterator[pa.RecordBatch], column: str, length: int):
    """(batch, rows, first bytes, buffer, bounds) of each lot of pieces."""
    for batch in batches:
        data, offsets, _ = utf8(batch.column(batch.schema.get_field_index(column)))
        for lot in _pieces(offsets, length):
            rows = np.array([p[0] for p in lot])
            first = np.array([p[1] for p in lot]) - offsets[rows]
            bounds = np.concatenate(([0], np.cumsum([e - s for _, s, e in lot])))
            yield batch, rows, first, np.concatenate([data[s:e] for _, s, e in lot]), bounds


def _sampled(texts: DataFrame, length: int, whole: bool) -> DataFrame:
    """The runs of all texts: gram; with ``whole`` also text name, place, positions and run name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = length // 4
        for batch, rows, first, data, bounds in _lots(batches, "text", length):
            names = Names(data, second=whole)
            start, count, sample = runs(data, bounds, length, names)
            columns = {"gram": names.wide(sample, sample + gram).view(np.int64)}
            if whole:
                piece = np.searchsorted(bounds, start, "right") - 1
                end = start + count - 1 + length
                columns["h1"] = batch.column(0).to_numpy()[rows[piece]]
                columns["h2"] = batch.column(1).to_numpy()[rows[piece]]
                columns["place"] = start - bounds[piece] + first[piece]
                columns["positions"] = count
                columns["run1"] = names.wide(start, end).view(np.int64)
                columns["run2"] = names.narrow(start, end)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))

    more = ", h1 long, h2 long, place long, positions long, run1 long, run2 long" if whole else ""
    return texts.select("h1", "h2", "text").mapInArrow(run, "gram long" + more)


def _position_names(names: Names, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The paired rank of each position: names of its two halves, combined."""
    half = length // 2
    wide = _mixed(names.wide(start, start + half)) * np.uint64(ODD)
    wide = wide + names.wide(start + half, start + length)
    small = names.narrow(start, start + half) * RADIX + names.narrow(start + half, start + length)
    return wide, small % PRIME


def _expanded(contexts: pa.Array, length: int) -> tuple[Names, np.ndarray, np.ndarray, np.ndarray]:
    """(names, positions in the buffer, run of each, first position of each run)."""
    data, offsets, _ = utf8(contexts)
    count = np.diff(offsets) - length + 1
    run = np.repeat(np.arange(len(count)), count)
    opens = np.cumsum(count) - count
    position = np.arange(int(count.sum())) - opens[run] + offsets[:-1][run]
    return Names(data), position, run, offsets[:-1]


def _stretches(flags: np.ndarray, run: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, first place, last place) of maximal rows of flagged positions of one run."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(run[at]) != 0))
    first, last = at[np.concatenate(([0], breaks + 1))], at[np.concatenate((breaks, [len(at) - 1]))]
    return run[first], place[first], place[last]


SPAN = "h1 long, h2 long, first long, stop long"


def _resolve(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of the runs whose windows repeat inside their group (sorted by gram in each partition)."""

    def lots(batches):
        held, size = [], 0
        for batch in batches:
            gram = batch.column(0).to_numpy()
            cut = np.concatenate(([0], np.flatnonzero(gram[1:] != gram[:-1]) + 1, [len(gram)]))
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if size >= RESOLVE_BYTES and held[-1].column(0)[-1].as_py() != gram[a]:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, size = [], 0
                part = batch.slice(a, b - a)
                held.append(part)
                size += int(np.diff(utf8(part.column(5))[1]).sum())
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in lots(b for b in batches if b.num_rows):
            key = np.stack([lot.column(i).to_numpy() for i in (1, 2, 3)], axis=1)
            _, once = np.unique(key, axis=0, return_index=True)  # a repeated row brings the same run again
            lot = lot.take(pa.array(np.sort(once)))
            names, position, of_run, begin = _expanded(lot.column(5), length)
            wide, small = _position_names(names, position, length)
            order = np.lexsort((small, wide))
            same = (wide[order][1:] == wide[order][:-1]) & (small[order][1:] == small[order][:-1])
            flags = np.zeros(len(order), bool)
            flags[order[1:][same]] = True
            flags[order[:-1][same]] = True
            flags &= ~lot.column(4).to_numpy(zero_copy_only=False)[of_run]  # repeated runs are settled
            place = position - begin[of_run] + lot.column(3).to_numpy()[of_run]
            found, first, last = _stretches(flags, of_run, place)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lot.column(1).to_numpy()[found]),
                    pa.array(lot.column(2).to_numpy()[found]),
                    pa.array(first),
                    pa.array(last + length),
                ],
                names=["h1", "h2", "first", "stop"],
            )

    near = contexts.repartition("gram").sortWithinPartitions("gram")
    return near.select("gram", "h1", "h2", "place", "settled", "context").mapInArrow(run, SPAN)


def _dealt(contexts: DataFrame, length: int) -> DataFrame:
    """Spans of the runs of crowded groups: their positions are ranked by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                names, position, of_run, begin = _expanded(part.column(4), length)
                wide, small = _position_names(names, position, length)
                columns = [wide.view(np.int64), small]
                columns += [part.column(c).to_numpy()[of_run] for c in (0, 1)]
                columns += [position - begin[of_run] + part.column(2).to_numpy()[of_run]]
                columns += [part.column(3).to_numpy(zero_copy_only=False)[of_run]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["rank1", "rank2", "h1", "h2", "place", "settled"]
                )

    once = contexts.dropDuplicates(["h1", "h2", "place"]).select("h1", "h2", "place", "settled", "context")
    positions = written(
        once.mapInArrow(run, "rank1 long, rank2 long, h1 long, h2 long, place long, settled boolean"), "suffix-positions"
    )
    ranks = positions.groupBy("rank1", "rank2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return (
        positions.filter(~F.col("settled"))
        .join(written(ranks, "suffix-ranks"), ["rank1", "rank2"])
        .select("h1", "h2", F.col("place").alias("first"), (F.col("place") + length).alias("stop"))
    )


def _contexts(texts: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """The bytes of the chosen runs (array ``picks`` by text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8(batch.column(2))
            for row in range(batch.num_rows):
                picks = batch.column(3)[row].values
                gram, place, count, settled, crowded = (picks.field(i) for i in range(5))
                start = place.to_numpy() + offsets[row]
                end = start + count.to_numpy() - 1 + length
                n = len(start)
                h1, h2 = (pa.array(np.full(n, batch.column(i)[row].as_py(), np.int64)) for i in (0, 1))
                context = pa.array([data[a:b].tobytes() for a, b in zip(start.tolist(), end.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [gram, h1, h2, place, settled, crowded, context],
                    names=["gram", "h1", "h2", "place", "settled", "crowded", "context"],
                )

    named = ["h1", "h2"]
    by_text = chosen.groupBy(*named).agg(
        F.collect_list(F.struct("gram", "place", "positions", "settled", "crowded")).alias("picks")
    )
    one = texts.groupBy(*named).agg(F.min("id").alias("one"))  # one row of each text brings its runs
    picked = written(by_text.join(one, named), "suffix-picks")
    same = (texts.h1 == picked.h1) & (texts.h2 == picked.h2) & texts.id.eqNullSafe(picked.one)
    rows = texts.join(picked, same).select(texts.h1, texts.h2, texts.text, "picks")
    return rows.mapInArrow(
        run, "gram long, h1 long, h2 long, place long, settled boolean, crowded boolean, context binary"
    )


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """(h1, h2, first, stop): stretches of repeated bytes by text name; they may overlap.

    ``texts``: id, h1, h2, text.
    """
    long_enough = texts.filter(F.octet_length("text") >= length)
    # 1. samples by gram
    grams = _sampled(long_enough, length, whole=False).groupBy("gram").agg(F.count("*").alias("n"))
    shared = written(grams.filter("n > 1").select("gram"), "suffix-grams")
    alive = written(_sampled(long_enough, length, whole=True).join(shared, "gram"), "suffix-alive")
    # 2. (gram, run)
    key = ["gram", "run1", "run2"]
    kinds = alive.groupBy(*key).agg(
        F.count("*").alias("n"), F.min(F.struct("h1", "h2", "place", "positions")).alias("first")
    )
    kinds = written(kinds, "suffix-runs")
    whole = kinds.filter("n > 1").select("run1", "run2").distinct()
    spans = alive.join(written(whole, "suffix-whole"), ["run1", "run2"]).select(
        "h1", "h2", F.col("place").alias("first"), (F.col("place") + F.col("positions") - 1 + length).alias("stop")
    )
    spans = spans.distinct()
    # 3. runs that share their gram with other runs
    groups = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    chosen = kinds.join(written(groups, "suffix-groups"), "gram").select(
        "first.h1", "first.h2", "gram", "first.place", "first.positions",
        (F.col("n") > 1).alias("settled"), (F.col("kinds") > GROUP_RUNS).alias("crowded"),
    )
    contexts = written(_contexts(long_enough, chosen, length), "suffix-contexts")
    spans = spans.union(_resolve(contexts.filter("not crowded"), length))
    return spans.union(_dealt(contexts.filter("crowded"), length))


def _named(text: Column) -> list[Column]:
    """128 bits that name a text: its hash by two seeds."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def dedup(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept): every row's text without its repeated bytes.

    spans: maximal removed runs (first byte, byte after the last). kept: the
    remaining bytes, concatenated (binary: a cut may fall inside a character).
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), *_named(text), text.alias("text"))
    spans = repeated_spans(texts, length)
    by_text = spans.groupBy("h1", "h2").agg(F.collect_list(F.struct("first", "stop")).alias("found"))
    by_text = written(by_text, "suffix-spans")
    rows = texts.join(by_text, ["h1", "h2"], "left").select("id", "text", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("first", pa.int64()), ("stop", pa.int64())])
        for batch in batches:
            data, offsets, _ = utf8(batch.column(1))
            removed, kept = [], []
            for row in range(batch.num_rows):
                raw = data[offsets[row] : offsets[row + 1]]
                cell = batch.column(2)[row]
                cuts = []
                if cell.is_valid and len(cell):
                    first, stop = cell.values.field(0).to_numpy(), cell.values.field(1).to_numpy()
                    order = np.argsort(first, kind="stable")
                    first, stop = first[order], np.maximum.accumulate(stop[order])
                    opens = np.concatenate(([True], first[1:] > stop[:-1]))
                    last = np.concatenate((np.flatnonzero(opens)[1:] - 1, [len(first) - 1]))
                    cuts = list(zip(first[opens].tolist(), stop[last].tolist()))
                at, parts = 0, []
                for a, b in cuts:
                    parts.append(raw[at:a].tobytes())
                    at = b
                parts.append(raw[at:].tobytes())
                kept.append(b"".join(parts))
                removed.append([{"first": a, "stop": b} for a, b in cuts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.list_(span)), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    return rows.mapInArrow(run, "id long, n_bytes long, spans array<struct<first:long,stop:long>>, kept binary")
