"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every fingerprint emits its variants within half the radius; two fingerprints
that are close enough share a variant, so they meet in one shuffle group. For
an odd radius 2m+1 the two halves are m and m+1 bits. Fingerprints an odd
number of bits apart differ in parity, so only those of even parity emit the
outer shell of m+1 flipped bits. For m = 1 the shell needs only pairs of bits
of the same 32-bit half: of any three differing bits two lie in one half.

In a group all fingerprints within m bits of the variant are within 2m bits of
each other, and those of the shell within 2m+1 of them. One edge from the
smallest of the inner ones to each member therefore joins all that is linked;
each edge is verified by its bit distance. No pairs within a group are made,
and a group has at most as many rows as one ball has points.

Defined results: a text without words, or null, has fingerprint zero and is
linked like any other; fewer words than a shingle give one shingle; repeated
rows give repeated result rows; a null doc_id is kept but never becomes a
component id unless all of its component are null; an empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8, written
from .graph import components

BITS = 64
BLOCK = 1 << 16  # shingles whose bits are expanded at a time
EMIT_FPS = 20_000  # fingerprints whose variants one task emits
SORT_ROWS = 4_096  # whole rows that one task sorts


def fingerprint(raw: bytes, shingle: int, seed: int = 42) -> int:
    """64-bit SimHash of UTF-8 bytes: words between ASCII white space, A-Z lower-cased."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size).tolist()
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[s:e], seed) for s, e in zip(starts, ends[k - 1 :].tolist())],
        dtype="<u8",
    )
    set_bits = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = np.packbits(set_bits * 2 > len(hashes), bitorder="little")
    return int(over.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp): the fingerprint of every row as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8(batch.column(2))
            view = memoryview(np.ascontiguousarray(data))
            bounds = offsets.tolist()
            fps = [fingerprint(bytes(view[s:e]), shingle) for s, e in zip(bounds, bounds[1:])]
            column = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], names=["id", "text_hash", "fp"])
        pa.default_memory_pool().release_unused()  # the worker stays, idle beside the joins that follow

    id_, text = _keys(id_col, text_col)
    return docs.select(id_, F.xxhash64(text).alias("text_hash"), text).mapInArrow(
        run, "id long, text_hash long, fp long"
    )


def _keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    return F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")


def _masks(bits: int, shell_of_halves: bool = False) -> list[int]:
    """The numbers with exactly ``bits`` of 64 bits set (for two: of one half, if asked), signed."""
    halves = [range(0, 32), range(32, 64)] if shell_of_halves else [range(BITS)]
    found = [sum(1 << b for b in some) for half in halves for some in combinations(half, bits)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def _flips(masks: list[int]) -> Column:
    return F.array(*[F.lit(m).cast("long") for m in masks])


def _key(variant: Column, bits: int) -> Column:
    """Group of a variant: its hash without the lowest ``bits`` bits."""
    return F.shiftright(F.xxhash64(variant), bits)


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges (u, v) that connect exactly what fingerprints at ``max_bits`` or fewer bits connect.

    ``fps``: distinct fingerprints, column fp. The outer shell is most of the
    shuffle, so one number carries both the variant's group and which bits were
    flipped; its fingerprint is got back from the variant that it meets. Two
    variants of one group (equal hash bits) give a fingerprint that may not
    exist, so those met are verified against ``fps``. The joins are merge joins
    by hint: what is exploded is far larger than its size estimate, and
    fingerprints never go through the driver.
    """
    inner = max_bits // 2
    shell_masks = _masks(inner + 1, shell_of_halves=inner == 1)
    bits = max(1, (len(shell_masks) - 1).bit_length())
    near_masks = [m for r in range(inner + 1) for m in _masks(r)]
    near = (
        fps.select("fp", F.posexplode(_flips(near_masks)).alias("flip", "mask"))
        .select(_key(F.col("fp").bitwiseXOR(F.col("mask")), bits).alias("grp"), "fp", F.col("flip").cast("short"))
        .repartition("grp")
        .select("grp", "fp", F.col("fp").bitwiseXOR(F.get(_flips(near_masks), F.col("flip"))).alias("variant"))
    )
    smallest = F.min("fp").over(Window.partitionBy("grp", "variant"))
    met = near.select("fp", smallest.alias("u")).select("u", F.col("fp").alias("v")).filter("u != v")
    if max_bits % 2:
        seeds = near.groupBy("grp", "variant").agg(F.min("fp").alias("u"))
        even = fps.filter(F.bit_count("fp") % 2 == 0)
        shell = even.select("fp", F.posexplode(_flips(shell_masks)).alias("flip", "mask")).select(
            F.shiftleft(_key(F.col("fp").bitwiseXOR(F.col("mask")), bits), bits)
            .bitwiseOR(F.col("flip").cast("long"))
            .alias("packed")
        )
        flip = F.col("packed").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
        outer = (
            shell.join(seeds.hint("merge"), F.shiftright("packed", bits) == F.col("grp"))
            .select("u", F.col("variant").bitwiseXOR(F.get(_flips(shell_masks), flip)).alias("v"))
            .distinct()
        )
        met = met.union(outer.join(fps.hint("merge"), outer.v == fps.fp, "left_semi"))
    return met.filter(F.col("u") != F.col("v")).filter(_distance("u", "v") <= max_bits).distinct()


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text_hash, fp, root, component_id) for every row of ``docs``.

    component_id is the smallest id reachable over fingerprints that differ in
    ``max_bits`` or fewer bits, the row itself included; root is the smallest
    fingerprint.
    """
    rows = written(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    tasks = -(-distinct.count() // EMIT_FPS) or 1
    roots = written(components(links(distinct.select("fp").repartition(tasks), max_bits)), "simhash-roots")
    rooted = written(
        distinct.join(roots.hint("merge"), distinct.fp == roots.node, "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "simhash-rooted",
    )
    smallest = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-smallest")
    of_fp = written(rooted.join(smallest.hint("merge"), "root").select("fp", "root", "component_id"), "simhash-classes")
    return rows.join(of_fp.hint("merge"), "fp").select(
        "id", "text_hash", "fp", "root", "component_id"
    )


def one_of_each(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (a null id comes last).

    Of rows with the kept id and text that differ in other columns, the one with
    the least hash of its columns stays, so a repeated task keeps the same."""
    found = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id"), "text_hash"))
    kept = found.groupBy("root").agg(first.alias("k")).select("k.none", "k.id", "k.text_hash")
    kept = written(kept.select(*[F.col(c).alias(f"__{c}") for c in ("none", "id", "text_hash")]), "simhash-kept")
    id_, text = _keys(id_col, text_col)
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        id_.isNull().alias("__none"),
        F.coalesce(id_, F.lit(0)).alias("__id"),
        F.xxhash64(text).alias("__text_hash"),
    )
    keys = ["__none", "__id", "__text_hash"]
    # Texts are sorted in memory: tasks are cut by rows, as shuffled bytes are several
    # times smaller than the rows and would be put together to few large tasks.
    keyed = keyed.repartition(-(-docs.count() // SORT_ROWS) or 1, *keys)
    # rows that repeat the kept one have its keys: one of them stays
    whole = F.xxhash64(*[F.col(f"row.`{c}`").cast("string") for c in docs.columns])
    one = keyed.join(kept.hint("merge"), keys, "left_semi").groupBy(*keys).agg(F.min_by("row", whole).alias("row"))
    return one.select("row.*")


def hex_digits(fp: Column) -> Column:
    """Sixteen lower-case hex digits of a signed 64-bit number."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
