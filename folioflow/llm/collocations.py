"""Phrase collocations by pivot partitioning, as in MG-FSM.

Texts are rewritten as numbers of their frequent words; everything else is a
gap. Each occurrence of a word asks for the phrases in which it is the rarest
one, so its fragment is the word and up to two neighbours a side, cut at gaps
and at rarer words. Fragments go to the word's partition (the pivot's), equal
ones of a block as one with a weight, and are mined there; a partition gives out
only phrases that its pivots own. Steps:

1. blocks of texts are cut to words once; block dictionaries go to owners, who
   add up word counts, number frequent words and answer (``exchange``);
2. blocks are rewritten, fragments made, equal ones put together and dealt;
3. partitions count the phrases of their fragments and keep the frequent ones;
4. joins by word numbers give each phrase its parts' counts; cuts are scored
   with decimals, phrases inside longer ones dropped, the best of each language
   ranked.

An occurrence counts in one fragment only: that of its leftmost rarest word, as
a fragment takes strictly more frequent words on its left, and equally or more
frequent ones on its right. A pivot with more occurrences than HOT has its
fragments dealt to several partitions by block, which give partial counts that
are then summed by phrase; so no partition grows with a word.

Edge cases: a null or empty text has no words; a null language is ``und``; equal
texts count as often as they stand there; ties of scores and counts go by the
phrase's bytes; an empty table gives no rows; other columns of any name go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import gathered, pick, stored
from .exchange import BLOCK_BYTES, by_key, from_planes, owner_of, owners_for, packed_rows, packed_words, planes, unpacked_words, values_of

#: Occurrences that make a phrase a candidate, percent of them inside a longer one that drop it, and rows a language.
LEAST, INSIDE, TOP = 10, 50, 2000
#: Fragments that a partition gets on average, and occurrences from which on a pivot has several partitions.
FRAGMENTS, HOT = 250_000, 100_000
#: Words of a block's rewritten text in a row.
CODES = 1 << 16
#: Bits of a word's number within its owner.
OWN_BITS = 24
#: Groups that a language's phrases are ranked in before the last ranking.
RANK_SALTS = 64

#: A-Z to a-z; ends of pieces to full stops, which are no part of a word.
_PREPARE = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r", bytes(range(97, 123)) + b"." * 9)

BLOCKS = "block long, owner long, start long, lang string, words binary, sizes binary, counts binary, codes binary"
OWNED = "block long, owner long, start long, lang string, words array<binary>, counts array<long>, ids binary, frequencies binary, total long"
FRAGMENT_ROWS = "part long, hot boolean, fragments binary, weights binary"
MINED = "w1 long, w2 long, w3 long, a long, partial boolean"


def _batch(schema: str, **columns) -> pa.RecordBatch:
    """A batch of one of the schemas above; columns that are not given are null."""
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in schema.split(", ")]
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def words_of(texts: list[str]) -> pa.Array:
    """The words of texts in a row; a full stop stands between pieces and after each text."""
    line = b" . ".join([*(x.encode() for x in texts), b""]).translate(_PREPARE).replace(b".", b" . ")
    found = pc.ascii_split_whitespace(pa.array([line.decode()], pa.large_string())).values
    return found.filter(pc.greater(pc.binary_length(found), 0)).cast(pa.large_binary())


def blocks(docs: DataFrame, owners: int) -> DataFrame:
    """Dictionaries of blocks (a row for each owner and language) and their texts as numbers of entries (``BLOCKS``)."""

    def of_language(block: int, start: int, lang: str, texts: list[str]) -> tuple[int, Iterator[pa.RecordBatch]]:
        encoded = words_of(texts).dictionary_encode()
        entries, codes = encoded.dictionary.to_numpy(zero_copy_only=False), encoded.indices.to_numpy()
        stop = int(np.flatnonzero(entries == b".")[0])
        counts = np.bincount(codes, minlength=len(entries))
        owner = owner_of(entries, owners)
        owner[stop] = -1  # no owner: the first in order
        order = np.argsort(owner, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(start, start + len(order), dtype=np.uint32)  # 0 of the block's first language is a gap
        place[stop] = 0
        dealt, listed = owner[order[1:]], order[1:]  # without the full stop

        def rows() -> Iterator[pa.RecordBatch]:
            if len(listed):
                starts = [0, *(np.flatnonzero(np.diff(dealt)) + 1).tolist()]
                n = len(starts)
                words, sizes = packed_words(encoded.dictionary.take(pa.array(listed)), starts)
                told = [planes(x.astype(np.uint64)) for x in np.split(counts[listed], starts[1:])]
                yield _batch(BLOCKS, block=[block] * n, owner=dealt[starts].tolist(), start=[start + 1 + x for x in starts], lang=[lang] * n, words=words, sizes=sizes, counts=told)
            numbers = place[codes]
            chunks = [numbers[i : i + CODES] for i in range(0, len(numbers), CODES)]
            yield _batch(BLOCKS, block=[block] * len(chunks), start=[(start << 32) + i for i in range(len(chunks))], codes=[planes(x) for x in chunks])

        return start + len(order), rows()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, batch in enumerate(gathered(batches, "text", BLOCK_BYTES)):
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                by_lang.setdefault("und" if lang is None else lang, []).append(text or "")
            start = 0
            for lang, texts in sorted(by_lang.items()):
                start, rows = of_language((task << 24) | n, start, lang, texts)
                yield from rows

    return pick(docs, text="string", lang="string").mapInArrow(run, BLOCKS)


def count_words(dictionaries: DataFrame, least: int) -> DataFrame:
    """Answers to blocks, and the owners' frequent words (``OWNED``).

    A row with ``ids`` answers a block: the number of each of its entries plus
    one (0: not frequent) and how often that word stands in the corpus. A row with
    ``words`` has an owner's frequent words of a language, numbered in order from
    ``owner << OWN_BITS``, and the occurrences of all its words in ``total``.
    """

    def run(owner: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, block, start = (values_of(batches, c) for c in ("lang", "block", "start"))
        lists = [unpacked_words(w, n, pa.binary()) for w, n in zip(values_of(batches, "words"), values_of(batches, "sizes"))]
        counted = [from_planes(x, "<u8") for x in values_of(batches, "counts")]
        given = 0
        for lang in sorted(set(langs)):
            mine = [i for i, x in enumerate(langs) if x == lang]
            encoded = pa.concat_arrays([lists[i] for i in mine]).dictionary_encode()
            codes = encoded.indices.to_numpy()
            # Exact below 2^53 occurrences.
            total = np.bincount(codes, np.concatenate([counted[i] for i in mine])).astype(np.int64)
            often = np.flatnonzero(total >= least)
            number = np.zeros(len(total), np.uint64)
            number[often] = (owner << OWN_BITS) + given + 1 + np.arange(len(often))
            yield _batch(OWNED, owner=[owner], start=[(owner << OWN_BITS) + given], lang=[lang], words=[encoded.dictionary.take(pa.array(often)).to_pylist()], counts=[total[often].tolist()], total=[int(total.sum())])
            given += len(often)
            ends = np.cumsum([len(lists[i]) for i in mine])
            answers = np.split(codes, ends[:-1])
            ids = [planes(number[x]) for x in answers]
            told = [planes(np.where(number[x] > 0, total[x], 0).astype(np.uint64)) for x in answers]
            yield _batch(OWNED, block=[block[i] for i in mine], start=[start[i] for i in mine], ids=ids, frequencies=told)
        if given >= 1 << OWN_BITS:
            raise ValueError(f"an owner has {given} frequent words; more owners are needed")

    return by_key(dictionaries, "owner", ["lang", "block"], run, OWNED)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Well-spread 64 bits of 64 bits."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def fragments_of(ranks: np.ndarray) -> np.ndarray:
    """A row for each word that owns a phrase: two words before, the pivot, two behind; -1 where none belongs.

    ranks: the text's words by frequency, the most frequent 0; -1: a gap.
    """
    gap = np.full(2, -1, np.int32)
    line = np.concatenate([gap, ranks.astype(np.int32), gap])
    at = np.flatnonzero(ranks >= 0) + 2
    pivot = line[at]
    rows = np.full((len(at), 5), -1, np.int32)
    rows[:, 2] = pivot
    near = None
    for step, column in ((-1, 1), (-2, 0), (1, 3), (2, 4)):
        word = line[at + step]
        fits = (word >= 0) & (word < pivot if step < 0 else word <= pivot)
        near = fits if abs(step) == 1 else near & fits
        rows[:, column] = np.where(near, word, -1)
    return rows[(rows[:, 1] >= 0) | (rows[:, 3] >= 0)]


def merged(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, with how many they were; rows that only share a hash stay apart."""
    if not len(rows):
        return rows, np.zeros(0, np.uint32)
    mix = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        mix = _mixed(mix + column.astype(np.int64).view(np.uint64))
    order = np.argsort(mix)
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))
    return rows[first], np.diff(np.append(first, len(rows))).astype(np.uint32)


def rewrite(answered: DataFrame, parts: int, hot: int) -> DataFrame:
    """The weighted fragments of every block, dealt to their pivots' partitions (``FRAGMENT_ROWS``)."""

    def run(block: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = [(s, from_planes(i, "<u8"), from_planes(f, "<u8")) for b in batches for s, i, f in zip(*(b.column(c).to_pylist() for c in ("start", "ids", "frequencies"))) if i is not None]
        chunks = [x for x in values_of(batches, "codes") if x is not None]
        if not answers or not chunks:
            return
        size = max(s + len(i) for s, i, _ in answers)
        number, frequency = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        for s, i, f in answers:
            number[s : s + len(i)], frequency[s : s + len(i)] = i, f
        often = np.flatnonzero(number)
        often = often[np.lexsort((number[often], ~frequency[often]))]  # most frequent first, then by number
        rank = np.full(size, -1, np.int32)
        rank[often] = np.arange(len(often))
        rows, weights = merged(fragments_of(rank[np.concatenate([from_planes(x, "<u4") for x in chunks])]))
        number, frequency = number[often], frequency[often]
        pivot = rows[:, 2]
        ways = frequency[pivot] // np.uint64(hot) + np.uint64(1)
        salt = _mixed(np.full(1, block, np.uint64))[0] % ways
        part = _mixed(number[pivot] + (salt << np.uint64(48))) % np.uint64(parts)
        key = part * np.uint64(2) + (ways > 1)
        order = np.argsort(key, kind="stable")
        rows, weights, key = rows[order], weights[order], key[order]
        ids = np.where(rows >= 0, number[np.maximum(rows, 0)], 0).astype(np.uint64)
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
        for i in range(0, len(spans), 256):
            some = spans[i : i + 256]
            yield _batch(FRAGMENT_ROWS, part=[int(key[a] >> np.uint64(1)) for a, _ in some], hot=[bool(key[a] & np.uint64(1)) for a, _ in some], fragments=[planes(ids[a:b].T.ravel()) for a, b in some], weights=[planes(weights[a:b]) for a, b in some])

    return by_key(answered, "block", ["codes_last", "start"], run, FRAGMENT_ROWS)


def phrases_of(rows: np.ndarray, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases (rows of two and of three numbers) that fragments hold with their pivot, and their counts."""
    known, local = np.unique(rows, return_inverse=True)
    local = local.reshape(rows.shape)
    for width in (2, 3):
        spans = range(3 - width, 3)  # first columns of the windows that hold column 2
        found = [np.flatnonzero((rows[:, s : s + width] > 0).all(1)) for s in spans]
        words = np.concatenate([local[i, s : s + width] for i, s in zip(found, spans)])
        count = np.concatenate([weights[i] for i in found])
        if not len(words):
            continue
        key = words[:, 0].astype(np.int64)
        for column in words.T[1:]:
            if key.max() >= (1 << 62) // len(known):  # numbers of what is there instead
                _, key = np.unique(key, return_inverse=True)
            key = key * len(known) + column
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
        yield known[words[order[first]]], np.add.reduceat(count[order].astype(np.int64), first)


def mine(fragments: DataFrame, least: int) -> DataFrame:
    """The phrases of each partition's fragments (``MINED``): frequent ones, or partial counts where a pivot is hot."""

    def run(part: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = values_of(batches, "hot")
        shown, given = values_of(batches, "fragments"), values_of(batches, "weights")
        for hot in (False, True):
            mine_ = [i for i, x in enumerate(kind) if x == hot]
            if not mine_:
                continue
            rows = np.concatenate([from_planes(shown[i], "<u8").reshape(5, -1).T for i in mine_])
            weights = np.concatenate([from_planes(given[i], "<u4") for i in mine_])
            for words, a in phrases_of(rows, weights):
                kept = slice(None) if hot else a >= least
                words, a = words[kept].astype(np.int64) - 1, a[kept]
                third = words[:, 2] if words.shape[1] == 3 else np.full(len(a), -1, np.int64)
                yield _batch(MINED, w1=words[:, 0], w2=words[:, 1], w3=third, a=a, partial=np.full(len(a), hot))

    return by_key(fragments, "part", [], run, MINED)


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole decimals of 38 digits: exact for counts under 10^15."""
    return F.expr(f"cast((cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)) * cast(1000000 as decimal(7,0))) div (cast({left} as decimal(15,0)) * cast({right} as decimal(15,0))) as long)")


def scored(phrases: DataFrame, words: DataFrame, inside: int = INSIDE) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases that are not inside a longer one.

    phrases: w1, w2, w3 (-1: none), a. words: id, lang, word, f.
    """
    named = lambda n: words.select(F.col("id").alias(f"w{n}"), F.col("word").alias(f"word{n}"), F.col("f").alias(f"f{n}"))
    two = phrases.where("w3 = -1").select("w1", "w2", "a")
    three = phrases.where("w3 >= 0").select("w1", "w2", "w3", "a")
    longer = three.select("w1", "w2", "a").unionByName(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy("w1", "w2").agg(F.max("a").alias("longest"))
    pairs = two.join(words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("word1"), F.col("f").alias("f1")), "w1").join(named(2), "w2")
    short = (
        pairs.join(longer, ["w1", "w2"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < inside * F.col("a")))
        .select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    )
    head = pairs.select("w1", "w2", "lang", "word1", "word2", "f1", F.col("a").alias("f12"))
    tail = two.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    cuts = three.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(named(3), "w3").withColumns({"s1": _score("a", "f1", "f23"), "s2": _score("a", "f12", "f3")})
    first = F.col("s1") <= F.col("s2")
    long = cuts.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
        F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    return short.unionByName(long)


def ranked(scores: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each language with ``rank``; first within RANK_SALTS groups of it, so that none meets whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    near = scores.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("_salt")


def mine_phrases(docs: DataFrame, least: int = LEAST, fragments: int = FRAGMENTS, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All phrases of two and three words with ``least`` occurrences or more, by word numbers; the words; the languages' totals."""
    spark = docs.sparkSession
    with packed_rows(spark, 500):
        cut = stored(blocks(docs, owners_for(pick(docs, text="string"))), "phrases-blocks", packed=True)
    with packed_rows(spark):
        owned = stored(count_words(cut.where("words is not null"), least), "phrases-words", packed=True)
        occurrences = owned.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n")).first()["n"] or 0
        parts = max(16, -(-occurrences // fragments))
        codes = cut.where("codes is not null").select("block", "start", F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("frequencies"), "codes", F.lit(1).alias("codes_last"))
        answers = owned.where("ids is not null").select("block", "start", "ids", "frequencies", F.lit(None).cast("binary").alias("codes"), F.lit(0).alias("codes_last"))
        mined = stored(mine(rewrite(answers.unionByName(codes), parts, hot), least), "phrases-mined")
    whole = mined.where("not partial").select("w1", "w2", "w3", "a")
    summed = mined.where("partial").groupBy("w1", "w2", "w3").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    given = owned.where("words is not null")
    words = given.select("lang", "start", F.posexplode(F.arrays_zip("words", "counts"))).select((F.col("start") + F.col("pos")).alias("id"), "lang", F.col("col.words").cast("string").alias("word"), F.col("col.counts").alias("f"))
    return whole.unionByName(summed), words, given.groupBy("lang").agg(F.sum("total").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, fragments: int = FRAGMENTS, hot: int = HOT) -> DataFrame:
    """The best collocations of each language: lang, rank, phrase, a, l, r, n, score."""
    phrases, words, totals = mine_phrases(docs, least, fragments, hot)
    phrases = stored(phrases, "phrases-all")
    best = ranked(scored(phrases, words), top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> str:
    """The same in DuckDB SQL, from all phrases."""
    big = "CAST(1000000 AS HUGEINT) * a * a // (CAST({} AS HUGEINT) * {})"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), lines AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lines),
spans AS (SELECT lang, w, i, unnest([1, 2, 3]) AS k FROM places),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM spans WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= {least}),
longer AS (
  SELECT lang, part, max(a) AS longest FROM (
    SELECT lang, w[1] || ' ' || w[2] AS part, a FROM cand WHERE k = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE k = 3
  ) GROUP BY ALL
), cuts AS (
  SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM cand
), told AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.a AS l, y.a AS r, CAST({big.format("x.a", "y.a").replace(" a *", " c.a *").replace("* a ", "* c.a ")} AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:c.cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
  LEFT JOIN longer g ON c.k = 2 AND g.lang = c.lang AND g.part = c.phrase
  WHERE g.longest IS NULL OR 100 * g.longest < {inside} * c.a
), least AS (SELECT * FROM told QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT b.lang, rank, phrase, a, l, r, n, score FROM best b JOIN totals t ON t.lang = b.lang WHERE rank <= {top}
"""
