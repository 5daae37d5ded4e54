"""The corpus pipeline: rules, quality, near-duplicates, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns what it keeps; a stage
is written as Parquet and read again before the next one. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import mixing, packing, quality_ranking, quality_rules, simhash
from corvane.llm.common import DOCUMENT_COLUMNS, load, stored
from corvane.llm.encoder import tokenizer_path

#: Near-duplicates of this stage share 0.8 or more of their five-word shingles. Two such sets differ in 39 of 256
#: fingerprint bits on average, which no block scheme covers; seeded bit choices do. The radius leaves room for the
#: spread of that number, and the exact similarity decides.
NEAR_WORDS, NEAR_BITS, NEAR_RADIUS, NEAR_TABLES, NEAR_WIDTH, NEAR_SIMILAR = 5, 256, 54, 64, 18, 0.8


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without boilerplate lines."""
    return quality_rules.cleaned(docs.select(*DOCUMENT_COLUMNS))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut; learned from the labels of ``sf_dir`` and its documents."""
    ranker = quality_ranking.fit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return quality_ranking.scored(docs, ranker).filter("predicted = 1").select(*DOCUMENT_COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the lowest id, then the lowest text hash; equal rows once."""
    masks = simhash.drawn_masks(NEAR_TABLES, NEAR_WIDTH, NEAR_BITS)
    found = simhash.near_duplicates(docs, NEAR_WORDS, NEAR_BITS, NEAR_RADIUS, masks, NEAR_SIMILAR)
    return simhash.representatives(docs, found).select(*DOCUMENT_COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and sampled to the target weights of their sources."""
    return mixing.repeated(mixing.mix(docs.select(*DOCUMENT_COLUMNS)), DOCUMENT_COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences, with their ids."""
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return pieces.withColumn("ids_crc32", packing.crc32(F.col("ids"), F.col("width")))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: SimHash, the learned ranking and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
