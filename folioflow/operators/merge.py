"""Merging the rows of one entity.

``first``: for each field the first value in row order that is not null, over
the union of the fields. An array counts as a value even if it is empty.
``collect``: array fields become the distinct union of all rows' elements.

Both are one aggregation with partial states, so a key that most rows share
costs no more than any other. What "collect" unites of one entity stands in one
row; where one may have more links than a row should hold, as with an author
named "anonymous", ``linked_chunks`` gives them as rows of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import Workspace


def first_value(value: Column, order: Column) -> Column:
    """The value of least ``order`` among those that are not null."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def merge(rows: DataFrame, key: str, order: str, mode: str = "first", collect: list[str] | None = None) -> DataFrame:
    """One row a key. collect: the array fields that mode "collect" unites (default: all of strings)."""
    if mode not in ("first", "collect"):
        raise ValueError(f"mode is first or collect, not {mode!r}")
    united: set[str] = set()
    if mode == "collect":
        united = set(collect if collect is not None else [f.name for f in rows.schema if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)])
    out = []
    for name in rows.columns:
        if name in (key, order):
            continue
        c = F.col(f"`{name}`")
        if name in united:
            # Elements are made distinct within a row first, and sorted, so that the result has no order of arrival.
            whole = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array_distinct(c)))))
            out.append(F.when(F.count(c) > 0, whole).alias(name))
        else:
            out.append(first_value(c, F.col(order)).alias(name))
    return rows.groupBy(key).agg(*out)


#: Links in a row of ``linked_chunks``.
CHUNK = 10_000


def linked_chunks(rows: DataFrame, key: str, field: str, size: int = CHUNK) -> DataFrame:
    """key, chunk, links: each key's distinct, sorted elements of array ``field``, ``size`` to a row but for the last.

    Numbered on two levels, so that no task gathers a key: links are dealt by
    ranges of key and link and stored sorted; within a range a link's number is its
    place among the rows of its key there, and a key's ranges, of which there are
    few, are added up before them. A key without links has no row.
    """
    with Workspace(rows.sparkSession, "links") as space:
        links = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.explode(field).alias("link")).where("link is not null").distinct()
        sorted_ = links.repartitionByRange("key", "link").sortWithinPartitions("key", "link")
        placed = space.store(sorted_.select("key", "link", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part")))
        ranges = placed.groupBy("key", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
        before = F.sum("n").over(Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        starts = space.store(ranges.select("key", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")))
        number = placed.join(starts, ["key", "part"]).select("key", "link", F.floor((F.col("at") + F.col("shift")) / size).cast("long").alias("chunk"))
        return space.keep(number.groupBy("key", "chunk").agg(F.array_sort(F.collect_list("link")).alias("links")).select(F.col("key").alias(key), "chunk", "links"))


def merged_catalogue(pairs: DataFrame, mode: str = "collect") -> tuple[DataFrame, DataFrame]:
    """works and persons of ``catalog.entities`` rows."""
    works = merge(pairs.select("row_ix", "work.*"), "work_id", "row_ix", mode, collect=[r for r in pairs.schema["work"].dataType.names if r in _LINKS])
    persons = merge(pairs.select("row_ix", "person.*"), "person_id", "row_ix", mode, collect=[r for r in pairs.schema["person"].dataType.names if r.removesuffix("_of") in _LINKS])
    return works, persons


_LINKS = {"author", "translator", "editor", "proofreader", "other_author"}


def entity_union(works: DataFrame, persons: DataFrame) -> DataFrame:
    """All entities in one table, with ``kind`` work or person."""
    return works.withColumn("kind", F.lit("work")).unionByName(persons.withColumn("kind", F.lit("person")), allowMissingColumns=True)
