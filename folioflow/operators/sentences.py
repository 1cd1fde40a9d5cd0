"""Texts to paragraphs and sentences, and their measures."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility normal form, which no built-in gives."""
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def normalised(c: Column, full_width: bool = True) -> Column:
    """Compatibility normal form, then full width."""
    return X.to_full_width(nfkc(c)) if full_width else nfkc(c)


def split(rows: DataFrame, key: str, column: str, terminators: str = X.TERMINATORS, closers: str = X.CLOSERS) -> DataFrame:
    """A row a sentence: key, para and sent (from 0) and sentence."""
    paragraphs = rows.select(key, F.posexplode(X.paragraphs(F.col(column))).alias("para", "paragraph"))
    return paragraphs.select(key, "para", F.posexplode(X.sentences(F.col("paragraph"), terminators, closers)).alias("sent", "sentence"))


def parse_paragraphs(rows: DataFrame, key: str, column: str, full_width: bool = True, **marks: str) -> DataFrame:
    """Normalise, then ``split``."""
    return split(rows.withColumn(column, normalised(F.col(column), full_width)), key, column, **marks)


def nested(text: Column, terminators: str = X.TERMINATORS, closers: str = X.CLOSERS) -> Column:
    """array<struct<tags, sentences: array<struct<tags, sentence>>>> of a text, tags empty."""
    none = F.array().cast("array<string>")
    sentence = lambda s: F.struct(none.alias("tags"), s.alias("sentence"))
    return F.transform(X.paragraphs(text), lambda p: F.struct(none.alias("tags"), F.transform(X.sentences(p, terminators, closers), sentence).alias("sentences")))


def measured(text: Column, paragraphs: Column) -> dict[str, Column]:
    """character_count, paragraph_count and sentence_count of a text and its ``nested`` paragraphs."""
    return {
        "character_count": F.length(text).cast("long"),
        "paragraph_count": F.size(paragraphs).cast("long"),
        "sentence_count": F.aggregate(paragraphs, F.lit(0), lambda a, p: a + F.size(p["sentences"])).cast("long"),
    }


def document(rows: DataFrame, key: str, column: str, terminators: str = X.TERMINATORS, closers: str = X.CLOSERS) -> DataFrame:
    """key and ``paragraphs``, the nested form. No shuffle."""
    return rows.select(key, nested(F.col(column), terminators, closers).alias("paragraphs"))


def extent(rows: DataFrame, key: str, column: str, terminators: str = X.TERMINATORS, closers: str = X.CLOSERS) -> DataFrame:
    """key and the measures of each text, null counting as empty: one number of sentences for each paragraph, summed."""
    text = F.coalesce(F.col(column), F.lit(""))
    counts = F.transform(X.paragraphs(text), lambda p: F.size(X.sentences(p, terminators, closers)))
    counted = rows.select(key, F.length(text).cast("long").alias("character_count"), counts.alias("_counts"))
    return counted.select(key, "character_count", F.size("_counts").cast("long").alias("paragraph_count"), F.aggregate("_counts", F.lit(0), lambda a, x: a + x).cast("long").alias("sentence_count"))
