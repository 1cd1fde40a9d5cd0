"""The training-corpus pipeline: five stages over ``documents``.

Each stage takes what its predecessor kept, as (spark, docs, sf_dir), and all
but the last return the columns of ``documents``. ``run`` writes every stage's
result to the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import ngram_jaccard, packing, pii_disclosure, quality_mcd, toxicity_gru
from folioflow.llm.common import batch_setting_restored, discard, scratch, small_batches, stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, does not find toxic."""
    small_batches(spark)
    return toxicity_gru.clean_only(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    small_batches(spark)
    return quality_mcd.kept_only(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return ngram_jaccard.one_of_each(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data, and the words that reveal it, replaced."""
    small_batches(spark)
    return pii_disclosure.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the packed corpus."""
    small_batches(spark)
    return packing.pack(docs, release=True)


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicates", near_duplicates), ("pii", pii), ("pack", pack)]

#: Trained and iterated stages can't be stated in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``.

    A stage's intermediate tables go when its result is written, and that goes
    when the next one's is.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with batch_setting_restored(spark):
        for name, stage in STAGES:
            with scratch(spark):
                after = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", outlives=True)
            discard(docs)
            docs = after
    return docs
