"""A training corpus from raw documents: filter, remove copies, mix sources, pack."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import exact_dedup, mixing, packing, quality, simhash_dedup
from fareloom.llm.common import documents, labels, remainder, stored
from fareloom.llm.registered import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from labels outside the held-out quarter.

    Rows with null or empty texts are scored like any other; without labels nothing is rejected.
    """
    model = quality.learn(docs, labels(spark, sf_dir), remainder(F.col("doc_id"), 4) != 2)
    return quality.accepted(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, also one of the empty ones."""
    return exact_dedup.without_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the longest, then the smallest id."""
    return simhash_dedup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; ``n_chars`` follows texts that the mix cuts. Empty texts go."""
    mixed = mixing.mixture(docs)
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else mixed


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids."""
    return packing.packed(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", reject_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: A trained classifier, 64-bit hashes and a tokenizer are beyond SQL; tests/llm compares with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written before the next stage reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
