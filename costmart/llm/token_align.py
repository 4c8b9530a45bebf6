"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled by their full text (partial counts first, so a text that
holds a third of the rows arrives as one row a task); every distinct text is
tokenised by A (byte-level merges, a space put before the text) and by B
(pieces with byte fallback, which puts that space itself) and aligned by byte
offsets. Where both tokenizations end a token, a group ends; an A and a B token
whose bytes overlap are linked. A pair's count is the number of documents that
hold it linked: a text's pairs count as often as the text occurs. Measures go
back to the documents by the text's SHA-256.

Work inside a task is bounded: long texts are cut at single spaces between
ASCII letters, where both tokenizers always end a token (``Tokenizers`` checks
that no piece of B crosses such a place), and cut parts are tokenised and
aligned on their own, BYTES at a time. Tokenizer files are read by the driver
and broadcast (some 2 MB, a fixed size).

Counts are looked up in the table of all pairs, which grows with the corpus;
it is taken in blocks of at most ``block_pairs`` pairs, one broadcast and one
pass over the written links a block, so no task holds more than a block.

Defined results: null and empty texts, and texts whose joined token bytes
under A or B differ from space + text, have no tokens: zero measures and an
empty group text. Special tokens' strings are plain text. Repeated rows and
rows without id each count as a document and are returned each for itself; an
empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, written

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BYTES = 1 << 20  # text bytes tokenised side by side
PART = 1 << 16  # characters after which a long text may be cut
BLOCK_PAIRS = 2 << 20  # pairs of one lookup table: some 26 MB in a Python worker
MERGE = 1 << 22  # counted pairs that a task holds before it adds equal ones
HOT = 1000  # texts of more than 1 / HOT of the rows (fewer than HOT of them) are joined by broadcast
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
# Fixed value: the public split pattern of byte-level vocabularies of this kind.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def _byte_of_symbol() -> dict[str, int]:
    """The byte each symbol of a byte-level vocabulary stands for: printable bytes are
    themselves, the others follow 255 in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _merges_follow_ids(definition: dict) -> bool:
    """Whether the file is plain byte-level BPE whose merges are in the order of the ids they
    make: then a token's id is its merge rank, and an encoder by ranks gives the same ids."""
    model, split = definition["model"], definition.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    plain = plain and definition.get("normalizer") is None and split.get("type") == "ByteLevel"
    plain = plain and not split.get("add_prefix_space") and split.get("use_regex", True)
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model.get("merges", ())]
    vocab = model.get("vocab", {})
    return plain and len(vocab) == 256 + len(merged) and all(vocab.get(m) == 256 + i for i, m in enumerate(merged))


class Tokenizers:
    """Both tokenizers of one worker, and the bytes of their tokens."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        symbols = _byte_of_symbol()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in symbols for c in token)
            self.a_bytes[i] = bytes(symbols[c] for c in token) if known else token.encode()
        self.ranked = None
        definition = json.loads(a_json)
        if _merges_follow_ids(definition):
            import tiktoken

            ranks = {self.a_bytes[i]: i for i in definition["model"]["vocab"].values()}
            self.ranked = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        # a space is only ever met at the start of a piece, or among spaces
        self.cuts = not any(" " in p.decode(errors="replace").lstrip(" ") for p in self.b_bytes)
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_flat, self.b_flat = _Flat(self.a_bytes, self.a_size), _Flat(self.b_bytes, self.b_size)
        self.a_text, self.b_text = _decimal(len(self.a_bytes)), _decimal(len(self.b_bytes))

    def parts(self, text: str) -> Iterator[str]:
        """The text cut at single spaces, which are left out: both tokenizers see one before each part."""
        first = 0
        while self.cuts and len(text) - first > PART:
            place = CUT.search(text, first + PART)
            if place is None:
                break
            yield text[first : place.start()]
            first = place.end()
        yield text[first:] if first else text

    def encode(self, parts: list[str]) -> tuple[list, list]:
        """Ids of each part under A and B."""
        spaced = [" " + p for p in parts]
        if self.ranked is not None:
            a = [self._by_rank(p) for p in spaced]
        else:
            a = [e.ids for e in self.a.encode_batch(spaced, add_special_tokens=False)]
        return a, self.b.encode(parts, num_threads=1)

    def _by_rank(self, part: str) -> np.ndarray:
        try:
            return self.ranked.encode_to_numpy(part, disallowed_special=())
        except ValueError:  # its splitter gives up on very long runs of white space; the other one does not
            return np.array(self.a.encode(part, add_special_tokens=False).ids, np.uint32)

    def faithful(self, parts: list[str], a: list, b: list) -> list[bool]:
        """Whether the joined token bytes of both are those of each part after a space."""
        whole = [(" " + p).encode() for p in parts]
        good = [True] * len(parts)
        for flat, ids in ((self.a_flat, a), (self.b_flat, b)):
            all_ids = _flat(ids)
            stop = np.concatenate(([0], np.cumsum(flat.size[all_ids])))[np.cumsum([0, *map(len, ids)])].tolist()
            joined = flat.joined(all_ids)
            good = [ok and joined[i:j] == w for ok, w, i, j in zip(good, whole, stop, stop[1:])]
        return good


def _flat(ids: list) -> np.ndarray:
    """The ids of all parts in one array."""
    if ids and isinstance(ids[0], np.ndarray):
        return np.concatenate(ids).astype(np.int64)
    return np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))


class _Flat:
    """The bytes of a vocabulary's tokens, joined without a loop over tokens."""

    def __init__(self, tokens: list[bytes], size: np.ndarray):
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.size, self.start = size, np.cumsum(size) - size

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        stop = np.cumsum(size)
        at = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.start[ids] - (stop - size), size)
        return self.data[at].tobytes()


def _decimal(size: int) -> np.ndarray:
    """(3, ids) of the id in decimal after ',', ';' and '|'."""
    return np.array([[f"{c}{i}".encode() for i in range(size)] for c in ",;|"])


COMMA, SEMICOLON, BAR = 0, 1, 2


class Aligner:
    """Measures of the texts of one chunk, part by part."""

    def __init__(self, tok: Tokenizers, texts: list[str | None]):
        n = len(texts)
        self.tok = tok
        self.width = len(tok.b_bytes)
        self.good = np.array([bool(t) for t in texts], bool)
        self.counts = np.zeros((4, n), np.int64)  # n_a, n_b, n_groups, n_links
        self.hashes: list = [None] * n
        self.found: list[tuple[np.ndarray, np.ndarray]] = []  # (text * pairs + pair, occurrences)
        lot, size = [], 0
        for k, text in enumerate(texts):
            for part in tok.parts(text or "") if text else ():
                lot.append((k, part))
                size += len(part)
                if size >= BYTES:
                    self._add(lot)
                    lot, size = [], 0
        if lot:
            self._add(lot)
        self._join()

    @property
    def pairs(self) -> int:
        return len(self.tok.a_bytes) * self.width

    def _add(self, lot: list[tuple[int, str]]) -> None:
        parts = [part for _, part in lot]
        a, b = self.tok.encode(parts)
        for (k, _), ok in zip(lot, self.tok.faithful(parts, a, b)):
            self.good[k] &= ok
        kept = [i for i, (k, _) in enumerate(lot) if self.good[k]]
        if not kept:
            return
        owner = np.array([lot[i][0] for i in kept])
        a, b = [a[i] for i in kept], [b[i] for i in kept]
        a_count, b_count = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        a_ids, b_ids = _flat(a), _flat(b)
        a_stop, b_stop = np.cumsum(self.tok.a_size[a_ids]), np.cumsum(self.tok.b_size[b_ids])
        ends = np.zeros(int(a_stop[-1]) + 1, np.uint8)
        ends[a_stop] |= 1
        ends[b_stop] |= 2
        place = np.flatnonzero(ends)
        kind = ends[place]
        # between two ends lies one A and one B token: a link, and each pair of tokens has one such stretch
        is_a, is_b, both = kind & 1 == 1, kind & 2 == 2, kind == 3
        pair = a_ids[np.cumsum(is_a) - is_a] * self.width + b_ids[np.cumsum(is_b) - is_b]
        part_stop = a_stop[np.cumsum(a_count) - 1]
        part_of = np.searchsorted(part_stop, place)
        text_of = owner[part_of]
        np.add.at(self.counts[0], owner, a_count)
        np.add.at(self.counts[1], owner, b_count)
        np.add.at(self.counts[2], text_of[both], 1)
        np.add.at(self.counts[3], text_of, 1)
        self.found.append(np.unique(text_of * self.pairs + pair, return_counts=True))
        self._listed(owner, a_ids, b_ids, a_count + b_count, (np.cumsum(both) - both)[is_a], (np.cumsum(both) - both)[is_b])

    def _listed(self, owner, a_ids, b_ids, count, a_group, b_group) -> None:
        """Feed each text's hash with its groups: A ids, a bar, B ids, a semicolon."""
        groups = int(a_group[-1]) + 1
        a_before = np.cumsum(np.bincount(a_group, minlength=groups))  # A tokens of the groups up to each
        b_before = np.cumsum(np.bincount(b_group, minlength=groups))
        listed = np.zeros(len(a_ids) + len(b_ids), self.tok.a_text.dtype)
        opens = np.concatenate(([True], a_group[1:] != a_group[:-1]))
        at = np.arange(len(a_ids)) + np.concatenate(([0], b_before))[a_group]
        listed[at] = self.tok.a_text[np.where(opens, SEMICOLON, COMMA), a_ids]
        opens = np.concatenate(([True], b_group[1:] != b_group[:-1]))
        at = np.arange(len(b_ids)) + a_before[b_group]
        listed[at] = self.tok.b_text[np.where(opens, BAR, COMMA), b_ids]
        stops = np.cumsum(count).tolist()
        first = 0
        for k, stop in zip(owner.tolist(), stops):
            text = listed[first:stop].tobytes().replace(b"\0", b"")
            if self.hashes[k] is None:
                self.hashes[k] = hashlib.sha256()
                text = text[1:]
            self.hashes[k].update(text)
            first = stop

    def _join(self) -> None:
        """Pairs of each text, sorted, equal ones of its parts added; texts not faithful have none."""
        keys = np.concatenate([k for k, _ in self.found]) if self.found else np.zeros(0, np.int64)
        times = np.concatenate([t for _, t in self.found]) if self.found else np.zeros(0, np.int64)
        if len(self.found) > 1:
            keys, times = _added(keys, times)
        text_of = keys // self.pairs
        kept = self.good[text_of] if len(keys) else np.zeros(0, bool)
        text_of = text_of[kept]
        self.pair, self.times = keys[kept] % self.pairs, times[kept]
        self.offsets = np.concatenate(([0], np.cumsum(np.bincount(text_of, minlength=len(self.good)))))
        self.counts[:, ~self.good] = 0
        self.sha = [h.hexdigest() if h is not None and ok else "" for h, ok in zip(self.hashes, self.good)]


def _added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their numbers."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(times, first)


@dataclass
class Alignment:
    """``documents``: (row, measures, groups_sha256) of every row; ``pairs``: (a, b, n, best) of every linked pair."""

    documents: DataFrame
    pairs: DataFrame


LINKS = "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<long>, times array<long>"


def _links(texts: DataFrame, sent) -> DataFrame:
    """Alignment of each distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizers(*sent.value)
        for batch in chunks(batches, "text", BYTES):
            done = Aligner(tok, batch.column(2).to_pylist())
            offsets = pa.array(done.offsets.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (done.pair, done.times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, done.counts), pa.array(done.sha, pa.string()), *lists],
                names=["digest", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "times"],
            )

    return texts.mapInArrow(run, LINKS)


def _pair_counts(links: DataFrame, width: int) -> DataFrame:
    """(pair, a, n, best): how many documents hold each pair linked, and whether no pair of its A id has more."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            lists = batch.column(1)
            size = np.diff(lists.offsets.to_numpy())
            keys.append(lists.flatten().to_numpy())
            counts.append(np.repeat(batch.column(0).to_numpy(), size))
            held += len(keys[-1])
            if held > MERGE:
                k, c = _added(np.concatenate(keys), np.concatenate(counts))
                if len(k) > MERGE // 2:  # hand on what is added up
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["pair", "n"])
                    k, c = k[:0], c[:0]
                keys, counts, held = [k], [c], len(k)
        if held:
            k, c = _added(np.concatenate(keys), np.concatenate(counts))
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["pair", "n"])

    parts = links.filter("n_links > 0").select("copies", "pair").mapInArrow(add, "pair long, n long")
    counted = parts.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.floor(F.col("pair") / width))
    counted = written(counted, "pair-counts")
    # broadcast: at most one row an id of vocabulary A
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(F.broadcast(most), "a").select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best"))


def _looked_up(links: DataFrame, pairs: DataFrame, block_pairs: int) -> DataFrame:
    """(digest, n_best, count_sum) of each distinct text, a block of the pairs at a time."""
    spark = links.sparkSession
    blocks = max(1, -(-pairs.count() // block_pairs))
    # hashed blocks are uneven: cut them finer than the bound asks
    blocks = blocks if blocks == 1 else -(-blocks * 5 // 4)

    def measure(table) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, count, best = table.value
            for batch in batches:
                lists, times = batch.column(1), batch.column(2).flatten().to_numpy()
                bounds = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
                pair = lists.flatten().to_numpy()
                at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
                hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                at = at[hit]
                score = np.zeros((2, len(pair) + 1), np.int64)
                score[0, 1:][hit] = times[hit] * best[at]
                score[1, 1:][hit] = times[hit] * count[at]
                sums = np.cumsum(score, axis=1)[:, bounds]
                sums = sums[:, 1:] - sums[:, :-1]
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, sums)], names=["digest", "n_best", "count_sum"])

        return links.select("digest", "pair", "times").mapInArrow(run, "digest binary, n_best long, count_sum long")

    found = []
    for i in range(blocks):
        block = pairs if blocks == 1 else pairs.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == i)
        rows = block.select("pair", "n", "best").toArrow().sort_by("pair")  # at most a block of pairs
        sent = spark.sparkContext.broadcast(
            (rows.column("pair").to_numpy(), rows.column("n").to_numpy(), rows.column("best").to_numpy().astype(np.int64))
        )
        found.append(written(measure(sent), "pair-lookup"))
        sent.unpersist()
    if blocks == 1:
        return found[0]
    sums = [F.sum(c).alias(c) for c in ("n_best", "count_sum")]
    return reduce(DataFrame.union, found).groupBy("digest").agg(*sums)


def align(
    docs: DataFrame,
    text_col: str = "text",
    tokenizers: str = TOKENIZERS,
    a_file: str = A_FILE,
    b_file: str = B_FILE,
    block_pairs: int = BLOCK_PAIRS,
) -> Alignment:
    """Align both tokenizations of every document. ``row`` is a struct of all columns but the text."""
    spark = docs.sparkSession
    with open(f"{tokenizers}/{a_file}", encoding="utf-8") as a, open(f"{tokenizers}/{b_file}", "rb") as b:
        files = a.read(), b.read()
    width = len(Tokenizers(*files).b_bytes)
    sent = spark.sparkContext.broadcast(files)
    text = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(text.alias("text")).filter("text != ''").groupBy("text").agg(F.count("*").alias("copies"))
    digest = F.unhex(F.sha2(F.col("text"), 256)).alias("digest")
    links = written(_links(texts.select(digest, "copies", "text"), sent), "token-links")
    pairs = written(_pair_counts(links, width), "token-pairs")
    measures = links.drop("pair", "times").join(_looked_up(links, pairs, block_pairs).hint("merge"), "digest")
    measures = written(measures.select("digest", "copies", *MEASURES, "groups_sha256"), "token-measures")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    row = (F.struct(*others) if others else F.struct(F.lit(None).cast("long").alias("doc_id"))).alias("row")
    keyed = written(docs.select(row, F.when(text != "", F.unhex(F.sha2(text, 256))).alias("digest")), "token-docs")
    total = keyed.count()
    hot = F.broadcast(measures.filter(F.col("copies") * HOT > total))  # fewer than HOT rows
    rest = keyed.join(hot.select("digest"), "digest", "left_anti").filter("digest is not null")
    zero = [F.lit(0).cast("long").alias(c) for c in MEASURES]
    columns = ["row", *MEASURES, "groups_sha256"]
    documents = (
        keyed.join(hot, "digest").select(*columns)
        .union(rest.join(measures.hint("merge"), "digest").select(*columns))
        .union(keyed.filter("digest is null").select("row", *zero, F.lit("").alias("groups_sha256")))
    )
    return Alignment(documents, pairs.select("a", (F.col("pair") % width).alias("b"), "n", "best"))
