"""A training corpus from the table documents: language, exact copies, near copies, source mix, packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgrain.llm import exact_dedup, language_id, mixing, packing, simhash
from opsgrain.llm.shared import store


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go: no language can be told."""
    return language_id.known_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(docs, shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The language model, the fingerprints, the sample and the packing have no SQL form; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before it is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
