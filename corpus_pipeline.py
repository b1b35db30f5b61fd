"""Stages that turn raw documents into packed training sequences, each by an operator of revloom.llm."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm import line_dedup, mixing, ngram_join, packing, quality
from revloom.llm.shared import folder, known_to_workers, own_name, stored

#: Distinct sources from which on a line is boilerplate.
MIN_SITES = 10
#: How often the smallest source may come where the largest comes once.
MAX_REPEATS = 2.0


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the quality model rejects go."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: lines on many sites go but for their first place; a document that loses all its lines goes too."""
    left = line_dedup.without_spread_lines(docs, MIN_SITES)
    left = left.where((F.col(own_name("n_removed", docs.columns)) == 0) | (F.trim("text") != "")).withColumn("n_chars", F.length("text").cast("long"))
    return left.select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each group stays; shingles of five words, similarity 0.8 or more."""
    return ngram_join.one_per_group(docs, width=5, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: small sources are repeated up to MAX_REPEATS times; no document is lost."""
    return mixing.mixed(docs, max_repeats=MAX_REPEATS).select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: pieces in sequences of at most 1024 tokens."""
    pieces = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _stage(function):
    """A stage whose Python workers find the library where the driver has it."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        known_to_workers(spark)
        return function(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _stage(function)) for name, function in [
    ("quality_classifier", good_documents),
    ("line_dedup", without_boilerplate),
    ("ngram_jaccard_join", without_near_copies),
    ("source_mixing", mixed_sources),
    ("packing", packed_sequences),
]]

#: A learned classifier and tokenization have no SQL form; tests/llm checks the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of sf_dir, each over the stored rows of the one before."""
    place = folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{place}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
