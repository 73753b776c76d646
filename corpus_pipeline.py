"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last return
the columns of ``documents``. SQL cannot express the fitted classifier, nor the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazeline.llm import decontamination, exact_dedup, jaccard_join, packing, queries, quality
from hazeline.llm.common import ship, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    ship(spark)
    return quality.keep_good(docs, queries.quality_model(spark, sf_dir, docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    ship(spark)
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of similar texts the one with the smallest id."""
    ship(spark)
    return jaccard_join.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    ship(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    import public_tokenizers

    ship(spark)
    return packing.packed(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))).drop("ids")


STAGES = [
    ("quality", keep_good),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("benchmark", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"kept-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
