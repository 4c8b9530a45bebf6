"""Registered queries of the operators: each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_text, language_id, mixing, pii, quality, sharding, simhash, suffix_dedup
from . import token_align, topk, warc, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return rows.select(
        F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return placed.select("row.doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"), min_revisit=0, payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup(table(spark, sf_dir, "documents"), length=400)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    return kept.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        n_removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return mixed.select(
        "row.doc_id",
        "source",
        "lang",
        "topic",
        "tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        "sampled",
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("row.doc_id", "held_out", "lang_pred", "score")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.spans(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(name).alias(f"n_{name}") for name in pii.KINDS]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "added")).alias("spans"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8, scale=1024.0, shift=100000)
    return found.select(
        "row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_align.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.documents.select("row.doc_id", *token_align.MEASURES, "groups_sha256")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return found.select("row.doc_id", "held_out", "score", "predicted")


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_sharding": op2_sharding,
    "op3_decontaminate": op3_decontaminate,
    "op4_warc": op4_warc,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_topk": op6_topk,
    "op7_mixing": op7_mixing,
    "op8_language": op8_language,
    "op9_html": op9_html,
    "op10_pii": op10_pii,
    "op11_whitening": op11_whitening,
    "op12_token_align": op12_token_align,
    "op13_quality": op13_quality,
}
