"""N-gram Jaccard self-join of documents by MinHash banding.

1. Signatures, without a shuffle of texts: each text's distinct 5-word shingles
   are hashed, bands * rows minima of multiplied-and-mixed hashes are taken, and
   each band of minima is folded into one value. ``plan`` chooses both numbers:
   for each number of rows the fewest bands that miss a pair at the threshold
   with at most 1 - RECALL, and of these the cheapest in minima, shuffled bands
   and chance candidates.
2. Copies collapse: texts with the same words in the same order are one class
   with a representative row and a size (partial aggregation; no class is gathered).
3. Representatives are shuffled on (band, value). Buckets of one are dropped,
   buckets with the same members in several bands are kept once, at the first.
4. Pairs are verified on full shingle sets inside a bucket, in numpy. A bucket
   over BLOCK members is cut into blocks by a hash and each pair of blocks is
   a unit of its own, so a unit's size is bounded and a huge group of near
   copies spreads over many tasks; a text goes to as many units as its bucket has
   blocks. A pair is counted in the first band that its two signatures share, so
   in one unit only. No pair is ever a row: a unit returns a row a member, with
   its number of links and the smallest id of its component there.
5. Groups are the connected components of those links, by repeated minimum over
   neighbours with pointer jumping, each round stored; joins on labels, which a
   whole component shares, are broadcast or salted.

A word is a run of anything but ASCII white space; texts with one to four words
are one shingle. Shingles are compared by 64-bit hashes.

Edge cases: null texts and texts without words are linked to nothing; rows with
a null id are left out, as nothing could name them; rows that repeat an id are
copies if their words are equal, and share the id's links and group if not;
ties go to the smallest id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DOCUMENT, discard, join_hot, join_small, marked, pick, releasing, resident, slices, stored, without

SHINGLE, SIMILARITY = 5, 0.8
#: Share of pairs at SIMILARITY that some band shall find, and minima in a band at most.
RECALL, MOST_ROWS = 0.9999, 16
#: Costs in minima of a text: a shuffled band, and a candidate pair of a text that is half alike in every document.
BAND_COST, CANDIDATE_COST = 8, 4000
#: Members of a unit's block, and words of one (long texts make smaller blocks).
BLOCK, BLOCK_WORDS = 1024, 600_000
#: Words whose hashes a worker keeps before it starts anew (about 30 MB).
CACHE_WORDS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def plan_bands(similarity: float, rows: int, recall: float = RECALL) -> int:
    """The fewest bands of so many rows that find a pair of this similarity with this chance."""
    if similarity >= 1:
        return 1
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def plan(similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[int, int]:
    """bands and rows of least cost that reach the recall."""

    def cost(rows: int) -> float:
        bands = plan_bands(similarity, rows, recall)
        return bands * rows + BAND_COST * bands + CANDIDATE_COST * (1 - (1 - 0.5**rows) ** bands)

    rows = min(range(1, MOST_ROWS + 1), key=cost)
    return plan_bands(similarity, rows, recall), rows


class _Words(dict):
    """Word (bytes) to its 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX2
    return x ^ (x >> np.uint64(32))


def shingles(text: str, width: int = SHINGLE, known: dict[bytes, int] | None = None) -> tuple[np.ndarray, int, str]:
    """Sorted distinct shingle hashes, the number of words, and a digest of the words in order."""
    words = text.encode().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), 0, ""
    known = _Words() if known is None else known
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    width = min(width, n)
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        total = total * _MIX + hashes[k : n - width + 1 + k]
        total ^= total >> np.uint64(31)
    return np.unique(_mixed(total)), n, xxhash.xxh3_128_hexdigest(b" ".join(words))


@lru_cache(maxsize=4)
def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240607)
    return random.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1), random.integers(0, 1 << 32, count, dtype=np.uint32)


def signature(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit value a band."""
    times, plus = _multipliers(bands * rows)
    low = hashes.astype(np.uint32)
    least = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 256):
        x = low[i : i + 256, None] * times
        x += plus
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        np.minimum(least, x.min(0), out=least)
    minima = least.astype(np.uint64).reshape(bands, rows)
    value = np.zeros(bands, np.uint64)
    for k in range(rows):
        value = _mixed(value * _MIX + minima[:, k] + np.uint64(1))
    return value.view(np.int64)


def signatures(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key (hash of the text as it stands), words, content (digest of the words, null without any) and bands (null likewise)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, np.ndarray] = {}
        known = resident("jaccard", _Words)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                sizes, contents, values = [], [], []
                for text in batch.column("text").to_pylist():
                    hashes, n, content = shingles(text or "", SHINGLE, known)
                    sizes.append(n)
                    contents.append(content or None)
                    if content and content not in last:
                        if len(last) > 2000:
                            last.clear()
                        last[content] = signature(hashes, bands, rows)
                    values.append(last[content] if content else None)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(contents, pa.string()), pa.array(values, pa.list_(pa.int64()))], names=["doc_id", "text_key", "words", "content", "bands"])

    return docs.select("doc_id", "text", "text_key").mapInArrow(lambda batches: releasing(run(batches), True), "doc_id long, text_key long, words long, content string, bands array<long>")


def intersections(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all pairs of two lists, or within one.

    They come from products of incidence matrices over the shingles that two or
    more sets hold, a slice of these at a time.
    """
    sets = left + (right or [])
    n, m = len(left), len(right) if right is not None else len(left)
    if n == m == 1:
        return np.array([[len(np.intersect1d(left[0], sets[-1], assume_unique=True))]], np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    owner = owner[shared]
    _, column = np.unique(inverse[shared], return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, m), np.float32)
    step = max(256, min(4096, (2 << 20) // len(sets)))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [first, first + step])
        incidence = np.zeros((len(sets), step), np.float32)
        incidence[owner[a:b], column[a:b] - first] = 1
        common += incidence[:n] @ (incidence if right is None else incidence[n:]).T
    if right is None:
        # Shingles that one set holds alone count in its own size.
        np.fill_diagonal(common, [len(x) for x in left])
    return common


def pair_links(left: list[np.ndarray], right: list[np.ndarray] | None, values: tuple[np.ndarray, np.ndarray], band: int, limit: float) -> np.ndarray:
    """Boolean matrix: pairs at ``limit`` or more whose first common band is ``band``.

    right: the sets across which to compare; None: ``left`` within itself.
    """
    common = intersections(left, right)
    sizes = [np.array([len(x) for x in part], np.float32) for part in (left, left if right is None else right)]
    linked = common >= np.float32(limit) * (sizes[0][:, None] + sizes[1][None, :] - common) - 1e-3
    if right is None:
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    if len(i):
        # Whole numbers decide what the tolerance let through; then the bands, of the pairs that are left.
        inter = np.rint(common[i, j]).astype(np.int64)
        union = (sizes[0][i] + sizes[1][j]).astype(np.int64) - inter
        good = inter * 10**6 >= round(limit * 10**6) * union
        good &= values[0][i, band] == values[1][j, band]
        for k in range(band):
            good &= values[0][i, k] != values[1][j, k]
        linked[i, j] = good
    return linked


def local_roots(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each member's component within a unit, of its links (i, j)."""
    label = ids.copy()
    while True:
        lower = label.copy()
        np.minimum.at(lower, i, label[j])
        np.minimum.at(lower, j, label[i])
        if (lower == label).all():
            return label
        label = lower


def verified(units: DataFrame, limit: float) -> DataFrame:
    """Rows in order of unit -> a row a linked member: rep, links (documents), least (its local component).

    A unit of two blocks compares across them only, so nothing if one is empty; a unit of one block compares within.
    """
    names = ["unit", "rep", "text", "bands", "copies", "band", "side", "content", "cross"]

    def unit(rows: list[tuple], known: dict[bytes, int]) -> list[tuple[int, int, int]]:
        # By the sides of the unit; a row that came twice, as equal rows do, stands once.
        rows = list({(r[1], r[7]): r for r in rows}.values())
        cross = rows[0][8]
        if cross:
            rows.sort(key=itemgetter(6))
        cut = sum(r[6] == rows[0][6] for r in rows) if cross else len(rows)
        if len(rows) < 2 or (cross and cut == len(rows)):
            return []
        sets = [shingles(r[2] or "", SHINGLE, known)[0] for r in rows]
        values = np.array([r[3] for r in rows], np.int64)
        ids, weight = np.array([r[1] for r in rows], np.int64), np.array([r[4] for r in rows], np.int64)
        if cross:
            i, j = np.nonzero(pair_links(sets[:cut], sets[cut:], (values[:cut], values[cut:]), rows[0][5], limit))
            j = j + cut
        else:
            i, j = np.nonzero(np.triu(pair_links(sets, None, (values, values), rows[0][5], limit)))
        if not len(i):
            return []
        links = np.bincount(i, weight[j], len(rows)) + np.bincount(j, weight[i], len(rows))
        roots = local_roots(i, j, ids)
        return [(rows[k][1], int(links[k]), int(roots[k])) for k in np.unique(np.concatenate([i, j]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for part in slices(batch, "text", 4 << 20) for row in zip(*(part.column(c).to_pylist() for c in names)))
        out: list[tuple[int, int, int]] = []
        known = resident("jaccard", _Words)
        for _, members in groupby(rows, key=itemgetter(0)):
            out += unit(list(members), known)
            if len(out) >= 4096:
                yield _link_batch(out)
                out = []
        if out:
            yield _link_batch(out)

    return units.select(*names).mapInArrow(lambda batches: releasing(run(batches), True), "rep long, links long, least long")


def _link_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["rep", "links", "least"])


def components(edges: DataFrame) -> DataFrame:
    """id and group (the smallest id of its component) of every end of ``edges`` (a, b).

    Each round gives every node the smallest label around it and then that
    label's own label; rounds end when no label changes.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "jaccard-edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "jaccard-labels")
    while True:
        around = join_small(both, labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        lowered = labels.select("id", "label").join(around, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("further"))
        moved = stored(join_small(lowered, jump, "label", "left").select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "jaccard-labels")
        discard(labels)
        if moved.where("label <> old").isEmpty():
            return moved.select("id", F.col("label").alias("group"))
        labels = moved


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """A row a document: doc_id, class_id, copy_id, n_links, n_words.

    class_id: smallest id of the group of linked documents; copy_id: smallest
    id among the copies of the same words; n_links: other documents whose
    similarity is ``similarity`` or more, copies included. A row without an id
    can't be named by a link: it comes back with null ids, no links and its words.
    """
    bands, rows = plan(similarity, recall)
    every = pick(docs, doc_id="long", text="string").withColumn("text_key", F.xxhash64("text"))
    texts = every.where(F.col("doc_id").isNotNull())
    told = stored(signatures(every, bands, rows), "jaccard-signatures")
    signed = told.where(F.col("doc_id").isNotNull())
    copied = signed.where(F.col("content").isNotNull()).groupBy("content")
    # A class is represented by one row, told by its id and its text's hash.
    classes = copied.agg(F.min(F.struct("doc_id", "text_key")).alias("x"), F.count("*").alias("copies"), F.first("words").alias("words"), F.first("bands").alias("bands"))
    classes = stored(classes.select("content", F.col("x.doc_id").alias("rep"), F.col("x.text_key").alias("text_key"), "copies", "words", "bands"), "jaccard-classes")
    placed = stored(_placements(classes), "jaccard-placements")
    near = marked(texts.withColumnRenamed("doc_id", "rep"), placed, "rep").where("maybe").drop("maybe")
    # Each representative's text once, whatever rows repeat it; then to its units.
    chosen = classes.select("rep", "text_key", "content", "bands").join(near, ["rep", "text_key"]).dropDuplicates(["rep", "text_key"])
    units = placed.join(chosen, ["rep", "text_key"])
    found = stored(verified(units.repartition("unit").sortWithinPartitions("unit"), similarity), "jaccard-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    known = classes.select("content", "rep", "copies").join(links, "rep", "left").join(groups.withColumnRenamed("id", "rep"), "rep", "left")
    known = known.select("content", "copies", F.col("rep").alias("copy_id"), F.coalesce("group", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    columns = ["doc_id", "class_id", "copy_id", "n_links", F.col("words").alias("n_words")]
    alone = signed.where(F.col("content").isNull()).select("doc_id", "words", F.col("doc_id").alias("copy_id"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    none = F.lit(None).cast("long")
    nameless = told.where(F.col("doc_id").isNull()).select("doc_id", "words", none.alias("copy_id"), none.alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    linked = join_hot(signed.select("doc_id", "words", "content"), stored(known, "jaccard-known"), "content", "copies")
    return linked.select(*columns).unionByName(alone.select(*columns)).unionByName(nameless.select(*columns))


def _placements(classes: DataFrame) -> DataFrame:
    """rep, text_key, copies, band, side, unit and cross (whether of two blocks): the units in which each representative is compared."""
    banded = classes.select("rep", "text_key", "words", "copies", F.posexplode("bands").alias("band", "value"))
    # A bucket is told by its members: their number, extremes and summed hashes. Equal ones are the same bucket.
    member = F.xxhash64("rep", "text_key").cast("decimal(20,0)")
    buckets = banded.groupBy("band", "value").agg(F.count("*").alias("size"), F.min("rep").alias("low"), F.max("rep").alias("high"), F.sum(member).alias("mark"), F.sum("words").alias("all_words")).where("size > 1")
    buckets = buckets.groupBy("size", "low", "high", "mark").agg(F.min(F.struct("band", "value", "all_words")).alias("x")).select("x.*", "size")
    # Blocks: by a hash, enough that each is small by members and by words.
    number = F.greatest(F.lit(1), F.ceil(F.col("size") / BLOCK), F.ceil(F.col("all_words") / BLOCK_WORDS)).cast("int")
    members = banded.drop("words").join(buckets.withColumn("blocks", F.least(number, F.col("size").cast("int"))), ["band", "value"])
    members = members.withColumn("side", F.pmod(F.xxhash64("rep", "text_key", F.lit(7)), F.col("blocks")).cast("int"))
    units = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.xxhash64("band", "value", F.least(o, F.col("side")), F.greatest(o, F.col("side"))).alias("unit"), (o != F.col("side")).alias("cross")))
    return members.select("rep", "text_key", "copies", "band", "side", F.explode(units).alias("x")).select("rep", "text_key", "copies", "band", "side", "x.unit", "x.cross")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``documents`` with one of each group: the one whose id is the group's.

    Of rows that repeat such an id, one stays. Texts without words and rows
    without an id are in no group and stay.
    """
    rows = pick(docs, **DOCUMENT)
    found = stored(join(rows).select("doc_id", "class_id", "n_words"), "jaccard-groups")
    gone = found.where(F.col("doc_id") != F.col("class_id")).select("doc_id").distinct()
    repeated = found.where((F.col("doc_id") == F.col("class_id")) & (F.col("n_words") > 0)).groupBy("doc_id").count().where("count > 1").select("doc_id")
    left = marked(without(rows, gone, "doc_id"), repeated, "doc_id")
    again = left.where("maybe").drop("maybe")
    once = again.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*[c for c in rows.columns if c != "doc_id"])).alias("x")).select("doc_id", "x.*")
    return left.where(~F.col("maybe")).drop("maybe").unionByName(again.join(repeated, "doc_id", "left_anti").select(*rows.columns)).unionByName(once.select(*rows.columns))
