"""Source texts: routing of addresses to files, a download cache, unpacking and decoding."""

from __future__ import annotations

import hashlib
import io
import posixpath
import urllib.request
import zipfile
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import extension, route
from ..functions.text import strip_cr

#: What the catalogue calls encodings, as Python names them. The first is read with the vendor's extensions.
CODECS = {"SJIS": "cp932", "EUC": "euc_jp", "UTF-8": "utf-8-sig"}
TEXT_ENDS = (".txt", ".html")


def decode(data: bytes, encoding: str | None) -> str:
    """Text in a named encoding (UTF-8 if none); bytes it does not know become U+FFFD."""
    return data.decode(CODECS.get(encoding or "UTF-8", encoding or "utf-8"), "replace")


def text_of(path: str, data: bytes, encoding: str | None) -> str | None:
    """The text of a file, or of the first text in an archive; None for an archive without one, or a damaged one."""
    if posixpath.splitext(path)[1].lower() != ".zip":
        return decode(data, encoding)
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            for entry in archive.infolist():
                if posixpath.splitext(entry.filename)[1].lower() in TEXT_ENDS:
                    return decode(archive.read(entry), encoding)
    except (OSError, zipfile.BadZipFile):
        pass
    return None


def cached(url: str, folder: str) -> str:
    """The path of a fetched address, fetched now unless it is there; kept under its digest and base name.

    A file is moved into place when it is whole, so that workers may share the folder.
    """
    name = f"{hashlib.sha512(url.encode()).hexdigest()}-{posixpath.basename(urllib.request.urlparse(url).path.rstrip('/'))}"
    target = Path(folder) / name
    if not target.exists():
        target.parent.mkdir(parents=True, exist_ok=True)
        with urllib.request.urlopen(url) as response:
            part = target.with_name(f"{name}.{id(response)}.part")
            part.write_bytes(response.read())
        part.replace(target)
    return str(target)


def fetch(resources: DataFrame, folder: str) -> DataFrame:
    """``resources`` (url) with ``path``: where each is cached, null if it could not be had. folder: shared by all workers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths = []
            for url in batch["url"]:
                try:
                    paths.append(cached(url, folder) if url else None)
                except OSError:
                    paths.append(None)
            yield batch.assign(path=paths)

    return resources.mapInPandas(run, T.StructType([*resources.schema.fields, T.StructField("path", T.StringType())]))


def decoded(files: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and text of files (path, content, encoding): text null for archives without one."""
    kept = [files.schema[c] for c in keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_of(p, bytes(c), e if isinstance(e, str) else None) for p, c, e in zip(batch["path"], batch["content"], batch["encoding"])]
            yield batch[list(keep)].assign(text=texts)

    return files.mapInPandas(run, T.StructType([*kept, T.StructField("text", T.StringType())]))


def read_texts(spark: SparkSession, files: str, encodings: DataFrame | None = None, pattern: str = "*") -> DataFrame:
    """path and text of the files under ``files``.

    encodings: (name, encoding) by the files' base names; others are UTF-8.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(files).select("path", "content")
    if encodings is not None:
        found = found.withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1)).join(encodings, "name", "left").select("path", "content", "encoding")
    else:
        found = found.withColumn("encoding", F.lit(None).cast("string"))
    return decoded(found, "path")


def sources(works: DataFrame, form: str = "text/plain") -> DataFrame:
    """work_id, url and encoding of the works' resources of a format."""
    return works.select("work_id", F.explode("sources").alias("x")).where(F.col("x.format") == form).select("work_id", F.col("x.url").alias("url"), F.col("x.encoding").alias("encoding"))


#: Resources up to which their paths are broadcast to the files, so that no file's bytes are shuffled.
BROADCAST_RESOURCES = 500_000
#: Paths in one scan's filter, and paths up to which the driver plans scans by them.
SCAN_PATHS, MOST_PATHS = 20_000, 500_000
#: Bits of the bitmap of paths beyond that.
BITMAP_BITS = 1 << 26


def plain_path(path: Column) -> Column:
    """A file's path without its scheme, as catalogues and routes write local paths; other stores keep theirs."""
    return F.regexp_replace(path, "^file:/*", "/")


def named_files(spark: SparkSession, root: str, paths: DataFrame) -> DataFrame:
    """path and content of the files under ``root`` that ``paths`` (path) names.

    The files are listed, and the filter on a file's name is decided when the scan
    is planned: no other file gets a task or is opened. Paths are names alone, as
    Spark's own listing holds them; SCAN_PATHS of them make a scan. Beyond
    MOST_PATHS the named folders filter the listing instead, and a bitmap of the
    paths' hashes, of 2^20 rows at most, holds the contents of other files back
    before a join decides.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # Listed names have their special characters encoded; a plus sign stands for itself.
    place = plain_path(F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")))
    named = [r["path"] for r in paths.select("path").distinct().limit(MOST_PATHS + 1).collect()]
    if len(named) <= MOST_PATHS:
        scans = [files.where(place.isin(named[i : i + SCAN_PATHS])) for i in range(0, len(named), SCAN_PATHS)] or [files.where("false")]
        return reduce(DataFrame.unionByName, [x.select(plain_path(F.col("path")).alias("path"), "content") for x in scans])
    # Listed paths without their contents say which are wanted; those are then scanned by folder.
    folders = paths.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).distinct()
    there = [r["folder"] for r in folders.limit(MOST_PATHS + 1).collect()]
    of = F.regexp_extract(place, r"^(.*)/[^/]*$", 1)
    near = (files.where(of.isin(there)) if len(there) <= MOST_PATHS else files).select(plain_path(F.col("path")).alias("path"), "content")
    at = F.pmod(F.xxhash64("path"), F.lit(BITMAP_BITS))
    word, place_in = F.floor(at / 64).alias("word"), (at % 64).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place_in).alias("bit")
    bitmap = paths.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    maybe = near.withColumn("word", word).join(F.broadcast(bitmap), "word").where(F.call_function("getbit", "bits", place_in) == 1)
    return maybe.select("path", "content").join(paths.select("path").distinct(), "path", "left_semi")


def extract_texts(spark: SparkSession, works: DataFrame, host_pattern: str, root: str, form: str = "text/plain") -> DataFrame:
    """work_id, url and text, without carriage returns, of every resource that has a file under ``root``.

    The resources of the format come first; only the files they name are opened
    (``named_files``). Up to BROADCAST_RESOURCES resources, counted, what is said of
    them goes to the files, so that no file's bytes are shuffled.
    """
    wanted = sources(works, form).withColumn("path", route(F.col("url"), host_pattern, root)).where(F.col("path").isNotNull())
    wanted = wanted.withColumn("path", plain_path(F.col("path")))
    found = named_files(spark, root, wanted)
    few = wanted.limit(BROADCAST_RESOURCES + 1).count() <= BROADCAST_RESOURCES
    joined = found.join(F.broadcast(wanted) if few else wanted, "path")
    texts = decoded(joined.select("work_id", "url", "path", "encoding", "content"), "work_id", "url")
    return texts.where(F.col("text").isNotNull()).withColumn("text", strip_cr(F.col("text")))


__all__ = ["CODECS", "cached", "decode", "extension", "extract_texts", "fetch", "named_files", "read_texts", "sources", "text_of"]
