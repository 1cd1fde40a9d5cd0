"""A graph as a stored table: a directory for each predicate, buckets by subject.

A bound predicate reads its directory alone. Patterns that share their subject
join bucket by bucket without a shuffle, as all predicates have the same buckets.
Adding triples reads only the predicates that the new ones have, and of those
only the buckets their subjects fall in, and leaves out what is there already, so
adding twice changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.triples import COLUMNS
from ..session import remove_files, shared_folder

#: Predicates that a table may have: each is a directory.
MOST_PREDICATES = 5_000
#: Columns as stored; the partition column stands last.
STORED = ["s", "o", "o_kind", "o_datatype", "o_lang", "bucket", "p"]


class TripleTable:
    """A graph under a table name, with ``buckets`` buckets a predicate.

    The name lives in the session's catalogue; the files lie in ``path``, or in the
    shared folder. Null subjects, predicates and objects are no triples and are left out.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int = 64) -> None:
        self.spark, self.buckets = spark, buckets
        self.name = name or f"folioflow_triples_{uuid.uuid4().hex}"
        self.path = path or f"{shared_folder(spark)}/folioflow/{self.name}"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        """The graph; filters on p reach the directories, joins on s the buckets."""
        return self.spark.table(self.name).select(*COLUMNS)

    def _prepared(self, triples: DataFrame) -> DataFrame:
        # Spark deals rows to bucket files by this same hash; the column makes touched buckets visible to filters.
        bucket = F.pmod(F.hash("s"), F.lit(self.buckets)).alias("bucket")
        given = triples.select(*COLUMNS).where("s is not null and p is not null and o is not null").dropDuplicates(COLUMNS)
        return given.select("s", "o", "o_kind", "o_datatype", "o_lang", bucket, "p")

    def _write(self, rows: DataFrame) -> None:
        # By bucket and predicate, so that each task writes few files; one predicate's rows spread over all buckets.
        dealt = rows.repartition("bucket", "p")
        dealt.write.mode("append").format("parquet").option("path", self.path).partitionBy("p").bucketBy(self.buckets, "s").sortBy("s").saveAsTable(self.name)

    def add(self, triples: DataFrame) -> int:
        """Add what is not there yet; returns how many triples that was."""
        fresh = self._prepared(triples)
        if not self.exists():
            self._check(fresh.select("p").distinct().limit(MOST_PREDICATES + 1).count())
            self._write(fresh)
            return self.spark.table(self.name).count()
        before = self.spark.table(self.name)
        touched = fresh.groupBy("p").agg(F.collect_set("bucket").alias("buckets")).limit(MOST_PREDICATES + 1).collect()
        self._check(len(touched))
        if not touched:
            return 0
        # At most MOST_PREDICATES names of directories and ``buckets`` numbers: filters that Spark prunes files by.
        there = before.where(F.col("p").isin([r["p"] for r in touched]) & F.col("bucket").isin(sorted({b for r in touched for b in r["buckets"]})))
        # Written beside the table first, as it is read from the table that is appended to.
        path = f"{self.path}-adding-{uuid.uuid4().hex}"
        self._missing(fresh, there).write.parquet(path)
        new = self.spark.read.schema(fresh.schema).parquet(path)
        n = new.count()
        if n:
            self._write(new)
        remove_files(self.spark, path)
        return n

    @staticmethod
    def _missing(fresh: DataFrame, there: DataFrame) -> DataFrame:
        # Null-safe on datatype and language; the equalities on s, p and o are the join's keys.
        a, b = fresh.alias("a"), there.alias("b")
        same = (F.col("a.s") == F.col("b.s")) & (F.col("a.p") == F.col("b.p")) & (F.col("a.o") == F.col("b.o"))
        for c in COLUMNS[3:]:
            same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        return a.join(b, same, "left_anti")

    @staticmethod
    def _check(predicates: int) -> None:
        if predicates > MOST_PREDICATES:
            raise ValueError(f"more than {MOST_PREDICATES} predicates: each would be a directory")

    def drop(self) -> None:
        """Take the name and the files away."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_files(self.spark, self.path)
