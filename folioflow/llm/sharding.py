"""Extendible hashing of documents into shards of bounded bytes.

A directory is indexed by the leading bits of a key's hash. All keys begin in
one bucket; a bucket over the byte limit, and only that one, splits on its next
bit, until every bucket fits. The bytes of buckets come from histograms over
hash prefixes: first over about twice as many as there will be shards, then
``STRIDE`` bits deeper in each round and only under the buckets that are still
too large, so the documents themselves are read once and moved only by a writer. The finished directory is joined to the keys on their
shortest common prefix.

A row's key is its doc_id; its hash is the first 60 bits of the id's MD5. Rows
of one id that together exceed the limit cannot be told apart by any bit: such
a bucket at full depth is chained into overflow pages, by prefix sums over its
rows in order of their size (rows of one size are alike).

``write`` makes the shards: a folder and one file for each shard and page.

Edge cases: a null text has no bytes; null ids share one key; a document over
the limit has a page to itself (``oversized`` is true); repeated rows are
separate rows; ties of size go to any page that has room; an empty table gives
no shards; other columns of any name go (``write`` keeps those of ``documents``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import DOCUMENT, join_small, pick, stored

#: Bytes of text in a shard, at most.
SHARD_BYTES = 64 << 20
#: Bits of the hash, and bits examined in a round.
BITS, STRIDE = 60, 8


def _prefix(hashed: F.Column, depth) -> F.Column:
    return F.shiftright(hashed, BITS - depth) if isinstance(depth, int) else F.call_function("shiftright", hashed, (F.lit(BITS) - depth).cast("int"))


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with n_bytes and the key's hash."""
    return rows.withColumns({
        "n_bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"),
        "hashed": F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long"),
    })


def keys(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the key's hash: narrow rows."""
    return _keyed(pick(docs, doc_id="long", text="string")).select("doc_id", "n_bytes", "hashed")


def directory(rows: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """The buckets of ``keys`` rows: depth, prefix, bytes, rows, lo and hi of their hashes.

    The first round goes as deep as even buckets would need, and one bit more;
    then depth grows by STRIDE bits a round. A round ends the search under each
    bucket that fits and keeps the oversized ones for the next.
    """
    root = rows.groupBy(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"))
    root = stored(root, "shard-level")
    leaves, large = root.where(F.col("bytes") <= limit), root.where(F.col("bytes") > limit)
    depth = 0
    while depth < BITS and not large.isEmpty():
        even = large.agg(F.max("bytes")).first()[0] // limit
        below = min(depth + max(1 if depth == 0 else STRIDE, even.bit_length() + 1), BITS)
        fine = rows.select("n_bytes", _prefix(F.col("hashed"), below).alias("fine"), _prefix(F.col("hashed"), depth).alias("above"))
        if depth:
            fine = fine.join(large.select(F.col("prefix").alias("above")), "above", "left_semi")
        histogram = fine.groupBy("fine").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"))
        levels = histogram.select("bytes", "rows", F.explode(F.transform(F.sequence(F.lit(depth + 1), F.lit(below)), lambda d: F.struct(d.alias("depth"), F.call_function("shiftright", F.col("fine"), (F.lit(below) - d).cast("int")).alias("prefix")))).alias("at"))
        sums = levels.groupBy("at.depth", "at.prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        # A bucket exists where the one above it was oversized; those at the round's top are known to be.
        above = sums.where(F.col("bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
        deeper = sums.join(above, ["depth", "prefix"], "left_semi")
        reached = stored(sums.where(F.col("depth") == depth + 1).unionByName(deeper), "shard-level")
        large = reached.where((F.col("depth") == below) & (F.col("bytes") > limit))
        final = reached.where((F.col("bytes") <= limit) | (F.col("depth") == BITS)).select("depth", "prefix", "bytes", "rows")
        leaves = leaves.unionByName(final)
        depth = below
    return _bounds(leaves)


def _bounds(leaves: DataFrame) -> DataFrame:
    width = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(BITS) - F.col("depth")).cast("int"))
    return leaves.withColumn("lo", F.col("prefix") * width).withColumn("hi", F.col("lo") + width - 1)


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (of ``_keyed``) with depth, shard (its prefix bits), page, shard_bytes (of the page) and oversized."""
    buckets = stored(directory(rows.select("n_bytes", "hashed"), limit), "shard-directory")
    least = buckets.agg(F.coalesce(F.min("depth"), F.lit(0))).first()[0]
    found = rows.withColumn("top", _prefix(F.col("hashed"), least)).join(
        buckets.withColumn("top", _prefix(F.col("lo"), least)).withColumnRenamed("bytes", "shard_bytes"),
        "top",
    ).where(F.col("hashed").between(F.col("lo"), F.col("hi")))
    name = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
    found = found.select(*rows.columns, "depth", name.alias("shard"), "shard_bytes", (F.col("n_bytes") > limit).alias("oversized"))
    fits = found.withColumn("page", F.lit(0).cast("long"))
    if buckets.where((F.col("depth") == BITS) & (F.col("bytes") > limit)).isEmpty():
        return fits
    too_large = (F.col("depth") == BITS) & (F.col("shard_bytes") > limit)
    return fits.where(~too_large).unionByName(_overflow(found.where(too_large), limit))


def shard(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """A row a document: doc_id, n_bytes, depth, shard (its prefix bits), page, shard_bytes, oversized."""
    placed = _placed(stored(keys(docs), "shard-keys"), limit)
    return placed.select("doc_id", "n_bytes", "depth", "shard", "page", "shard_bytes", "oversized")


def write(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write ``documents`` as Parquet, one file for each shard and page.

    The rows move once, to the task of their shard: a page's bytes bound what a
    task gathers for one file.
    """
    columns = list(DOCUMENT)
    placed = _placed(_keyed(pick(docs, **DOCUMENT)), limit)
    named = placed.withColumn("shard", F.concat(F.lit("b"), "shard")).select(*columns, "shard", "page")
    named.repartition("shard", "page").write.partitionBy("shard", "page").parquet(path)


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Pages for rows that no bit divides, by prefix sums: over sizes, over partitions, and within both.

    A page holds the rows that begin in its stretch of bytes, which is shorter
    than ``limit`` by the largest row, so that the last of them fits as well.
    """
    dealt = rows.drop("shard_bytes").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "shard-overflow")
    earlier = Window.unboundedPreceding, -1
    before = lambda c, by, order: F.coalesce(F.sum(c).over(Window.partitionBy(*by).orderBy(order).rowsBetween(*earlier)), F.lit(0))
    counts = stored(dealt.groupBy("shard", "n_bytes", "part").agg(F.count("*").alias("n")), "shard-overflow-sizes")
    sizes = counts.groupBy("shard", "n_bytes").agg((F.col("n_bytes") * F.sum("n")).alias("bytes"))
    smaller = sizes.select("shard", "n_bytes", before("bytes", ["shard"], "n_bytes").alias("smaller"))
    stretch = counts.groupBy("shard").agg(F.greatest(F.lit(1), F.lit(limit) - F.max("n_bytes") + 1).alias("stretch"))
    base = counts.select("shard", "n_bytes", "part", before("n", ["shard", "n_bytes"], "part").alias("ahead")).join(smaller, ["shard", "n_bytes"]).join(stretch, "shard")
    base = base.select("shard", "n_bytes", "part", (F.col("smaller") + F.col("ahead") * F.col("n_bytes")).alias("base"), "stretch")
    k = F.row_number().over(Window.partitionBy("shard", "part", "n_bytes").orderBy("at")) - 1
    local = dealt.withColumn("k", k).join(base, ["shard", "n_bytes", "part"])
    paged = local.withColumn("page", F.floor((F.col("base") + F.col("k") * F.col("n_bytes")) / F.col("stretch")).cast("long"))
    paged = paged.withColumn("on", F.concat_ws(":", "shard", "page"))
    pages = stored(paged.groupBy("on").agg(F.sum("n_bytes").alias("shard_bytes")), "shard-pages")
    return join_small(paged, pages, "on").select(*rows.columns, "page")


def shard_sql(limit: int = SHARD_BYTES) -> str:
    """The same by brute force: the bytes of every prefix, each id's first one that fits, and pages at full depth."""
    return f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {BITS // 4})) AS BIGINT) AS hashed
  FROM documents),
levels AS (
  SELECT r, doc_id, n_bytes, d AS depth, hashed >> ({BITS} - d) AS prefix,
         sum(n_bytes) OVER (PARTITION BY d, hashed >> ({BITS} - d)) AS bucket
  FROM rows, (SELECT unnest(range(0, {BITS + 1})) AS d) depths),
first_fit AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY depth) AS k FROM levels WHERE bucket <= {limit} OR depth = {BITS}),
begun AS (
  SELECT *, bucket > {limit} AS too_large,
         coalesce(sum(n_bytes) OVER (PARTITION BY depth, prefix ORDER BY n_bytes ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins,
         greatest(1, {limit} - max(n_bytes) OVER (PARTITION BY depth, prefix) + 1) AS stretch
  FROM first_fit WHERE k = 1),
paged AS (SELECT *, CASE WHEN too_large THEN CAST(begins // stretch AS BIGINT) ELSE 0 END AS page FROM begun)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INTEGER), '0') END AS shard,
       page, CAST(sum(n_bytes) OVER (PARTITION BY depth, prefix, page) AS BIGINT) AS shard_bytes, n_bytes > {limit} AS oversized
FROM paged
"""
