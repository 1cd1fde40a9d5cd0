"""The registered queries of the operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_stream, collocations, conversations, html_ttr, license_scan, ngram_jaccard, packing, pii_disclosure, quality_mcd, sharding, telephony, token_counts, toxicity_gru


#: Bytes of a shard in the registered query: small enough that the test tables split.
QUERY_SHARD_BYTES = 1 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality counts and the robust-outlier verdict of every document."""
    return quality_mcd.judge(_table(spark, sf_dir, "documents"))


def op2_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, and the words near it that give it away."""
    return pii_disclosure.report(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, copies and number of near-duplicate links of every document."""
    return ngram_jaccard.join(_table(spark, sf_dir, "documents"))


def op4_telephony(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as mu-law speech and as resampled PCM, both read back and described."""
    return telephony.stored_features(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template notices of every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op6_html_ttr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_ttr.extract(_table(spark, sf_dir, "pages"))


def op7_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt from the labelled rows that are not held out."""
    return toxicity_gru.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens; a row a piece."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded by the streaming byte-level BPE; digests of both."""
    return bpe_stream.round_trip(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document by extendible hashing, QUERY_SHARD_BYTES of text at most in each."""
    return sharding.shard(_table(spark, sf_dir, "documents"), QUERY_SHARD_BYTES)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two and three words of each language, mined by pivot."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return conversations.repair(_table(spark, sf_dir, "conversations"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text, from pieces counted once a pretoken."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_mcd": op1_quality_mcd,
    "op2_pii_disclosure": op2_pii_disclosure,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_telephony": op4_telephony,
    "op5_license_scan": op5_license_scan,
    "op6_html_ttr": op6_html_ttr,
    "op7_toxicity_gru": op7_toxicity_gru,
    "op8_packing": op8_packing,
    "op9_bpe_stream": op9_bpe_stream,
    "op10_sharding": op10_sharding,
    "op11_collocations": op11_collocations,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": license_scan.oracle_sql(),
    "op10_sharding": sharding.shard_sql(QUERY_SHARD_BYTES),
    "op11_collocations": collocations.oracle_sql(),
    "op12_conversation_repair": conversations.oracle_sql(),
}
