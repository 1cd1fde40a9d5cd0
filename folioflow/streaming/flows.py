"""Structured Streaming forms: catalogue files as they arrive, revision windows, triple sets.

The scalar, catalogue and text expressions are stateless and apply to streams
as they are; these functions add the stateful ones, each with a watermark that
bounds its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import catalog, triples
from ..sources import rdf
from ..sources.triple_table import TripleTable


def catalogue_stream(spark: SparkSession, folder: str, per_trigger: int = 10) -> DataFrame:
    """Catalogue rows of CSV files as they appear in a folder, columns by their known order of names."""
    rows = spark.readStream.schema(catalog.SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').option("maxFilesPerTrigger", per_trigger).csv(folder)
    return rows.select("*", F.col("_metadata.file_path").alias("file"))


def entity_stream(rows: DataFrame, **options) -> DataFrame:
    """work and person of each arriving row, with the time it was seen.

    A stream does not number rows, so ``row_ix`` orders them by file alone.
    """
    return catalog.entities(rows.withColumn("row_ix", F.lit(0).cast("long")), **options).withColumn("seen", F.current_timestamp())


def new_triples(stream: DataFrame, time_column: str, delay: str = "1 hour") -> DataFrame:
    """Triples of a stream without those seen within the watermark's delay: the set as it grows."""
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(triples.COLUMNS)


def counts_by_window(stream: DataFrame, time_column: str, key: str, length: str = "1 hour", delay: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Rows a window and key; late rows count until the watermark passes the window."""
    window = F.window(time_column, length, slide) if slide else F.window(time_column, length)
    counted = stream.withWatermark(time_column, delay).groupBy(window.alias("w"), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def sessions(stream: DataFrame, time_column: str, key: str, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Runs of a key's rows without a pause longer than ``gap``."""
    counted = stream.withWatermark(time_column, delay).groupBy(F.session_window(time_column, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def write_ntriples(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of triples to N-Triples files."""
    lines = rdf.ntriples(stream).select(F.col("line").alias("value"))
    return lines.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()


def grow_table(stream: DataFrame, table: TripleTable, checkpoint: str) -> StreamingQuery:
    """Add a stream of triples to a stored table, what has arrived so far, batch by batch.

    Adding what is there changes nothing, so a batch that is repeated after a
    failure leaves each triple in the table once.
    """
    added = stream.select(*triples.COLUMNS).writeStream.foreachBatch(lambda rows, _: table.add(rows) and None)
    return added.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
