"""Catalogues: CSV tables, also inside zip archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import COLUMNS

#: How catalogue files are written: quoted, "" for a quote, line breaks inside quotes.
CSV = {"header": True, "multiLine": True, "escape": '"', "quote": '"', "encoding": "UTF-8", "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Plain CSV catalogues, all strings, with ``file`` and ``row_ix`` in file order."""
    rows = spark.read.options(**CSV).csv(path)
    named = rows.select("*", F.col("_metadata.file_path"))
    return named.toDF(*[c.lstrip("﻿") for c in rows.columns], "file").withColumn("row_ix", F.monotonically_increasing_id())


def parse_table(data: bytes) -> Iterator[dict[str, str]]:
    """The rows of a CSV file by header: short rows lack the last columns, cells beyond the header go, of equal headers the last counts."""
    import csv

    reader = csv.reader(io.StringIO(data.decode("utf-8-sig"), newline=""))
    header = next(reader, None)
    for row in reader if header else ():
        if row:
            yield dict(zip(header, row))


def first_member(data: bytes) -> bytes:
    """The content of an archive's first entry."""
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        return archive.read(archive.infolist()[0])


def unpacked(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The tables in the first entries of archives (path, content), with ``file`` and ``row_ix`` in file order.

    Archives are unpacked on the executors, an archive a row, and rows leave as
    they are parsed. Rows are numbered within their archive, so what orders them
    is (file, row_ix); ``catalog.entities`` takes both.
    """
    names = columns or COLUMNS
    schema = "file string, row_ix long, " + ", ".join(f"`{c}` string" for c in names)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"]):
                rows = ([file, i, *[row.get(c) for c in names]] for i, row in enumerate(parse_table(first_member(bytes(content)))))
                while some := list(islice(rows, 10_000)):
                    yield pd.DataFrame(some, columns=["file", "row_ix", *names])

    return files.select("path", "content").mapInPandas(unpack, schema)


def read_zip(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """``unpacked`` archives under a path, read by Spark, so any store it knows will do."""
    return unpacked(spark.read.format("binaryFile").load(path), columns)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue, zipped or not, by its name."""
    return read_zip(spark, path) if path.lower().endswith(".zip") else read_csv(spark, path)
