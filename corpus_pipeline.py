"""A training corpus from ``documents``: five stages, each one operator of ``wattline.llm``.

Every stage takes all rows that the one before kept and returns the columns of
``documents``; the last returns token ids. Between stages the rows are written
as Parquet and read again, so a lost executor repeats only its own stage.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bag_minhash, exact_dedup, language_mix, mixing, piece_lattice
from wattline.llm.common import apply_decisions, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that no language holds; models and floors are learned from all of the documents' own labels."""
    return language_mix.keep_identified(docs, language_mix.fit(docs, sample_docs=None))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts."""
    return apply_decisions(docs, exact_dedup.exact_dedup(docs).where("kept").select("mark", F.lit(1).alias("repeats")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return apply_decisions(docs, bag_minhash.near_dedup(docs).where("kept").select("mark", F.lit(1).alias("repeats")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that each source's words meet its target."""
    return apply_decisions(docs, mixing.mix(docs).select("mark", "repeats"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with a check that they decode to its text."""
    model = piece_lattice.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    return piece_lattice.encode_and_check(docs, model, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_texts),
]

#: Language models, sketches and tokenizers have no SQL form; tests/llm holds the brute-force comparison.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
