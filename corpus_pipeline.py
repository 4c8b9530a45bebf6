"""Corpus pipeline: operators of ``costmart.llm`` applied to ``documents`` in turn.

Each stage takes all that its predecessor kept, written as parquet and reread,
and its decisions take effect: documents that language identification rejects
go and those without a given language get the predicted one (mixing weighs by
it), one document of each near-duplicate group stays, benchmark passages are
cut out (documents of nothing else go), documents are sampled to the target
mixture, and the rest is placed in shards. All but the last stage return the
columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costmart.llm import decontaminate, language_id, mixing, sharding, simhash
from costmart.llm.common import table, written

SHARDS = 8
MIN_SCORE = 0.3  # pooled probability of the best language below which a text is rejected: near a guess among four


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language could be told; a null ``lang`` becomes the predicted one.

    Rejected are ``und`` (null texts and those without a letter) and texts whose
    best language has a pooled probability below MIN_SCORE: no better than a
    guess. Short plain texts of a known language lie above it.
    """
    found = language_id.identify(docs)
    told = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    kind = dict(docs.dtypes).get("lang", "string")
    lang = F.coalesce(F.col("row.lang"), F.col("lang_pred").cast(kind)).alias("lang")
    return found.filter(told).select(*[lang if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: that of the smallest doc_id."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of ``benchmark``; n_chars follows the text."""
    cleaned = decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)
    if "n_chars" in cleaned.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind))
    return cleaned


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the raked source, language and topic weights."""
    return mixing.mix(docs).filter("sampled").select("row.*")


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard, slot and size; a column of that name is replaced."""
    placed = sharding.assign(docs, SHARDS)
    own = [c for c in placed.columns if c != "row"]
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in own]
    return placed.select(*kept, *own)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", cut_benchmark),
    ("mixing to target weights", sample_mixture),
    ("sharding", place_in_shards),
]

# SQL cannot express the stages (a trained network, bit-ball joins, suffix
# indexes); tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns for the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
