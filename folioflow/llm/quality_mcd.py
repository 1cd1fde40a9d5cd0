"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated 5-word windows. The
documents they pass are then compared with their own kind: for each language
and source a minimum-covariance-determinant (MCD) estimate of location and
scatter of FEATURES, transformed statistics, gives each document a Mahalanobis
distance; beyond CUT it is rejected.

The MCD is found by concentration steps from two deterministic starts (medians
with median deviations; classical moments). A step takes the SHARE of the pool
that is nearest under the present estimate and re-estimates from it, until the
determinants stay as they are (or after MOST_STEPS); the start that ends with
the smaller one wins and is reweighted once. With half a pool in the estimate, as
many equal outliers as nearly half of it can't pass for its middle. A step is one
aggregation: distances fall into CELLS per octave, moments are summed by pool
and cell with partial aggregation, and a window over a pool's few hundred cells
finds the nearest share; of the cell at its edge, the moments count by the part
of its rows that is still wanted. Cells and the floors below make the steps
approximate: a determinant can rise in the last digits, which ends them too. So
no pool, however large, is gathered anywhere. Statistics are held in whole
QUANTA, sums are whole numbers, and the result does not depend on the order of
rows. A variance floor per feature (FLOORS) keeps the scatter of constant
statistics regular.

Pools with fewer than MIN_POOL documents share one pool for their language, and
languages that are still too small one pool for all; a document in a pool that
is smaller yet is judged by the base rules alone.

Edge cases: a null text has no words and fails the base rules; null languages
and sources are values of their own; equal texts of one pool get equal
verdicts (so ties never part); repeated rows are separate rows; rows that share
an id, or have none, are judged each by its own text; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import DOCUMENT, discard, join_small, pick, stored, without

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = ".,;:!?"
#: Transformed statistics, and the least deviation that counts as one unit.
FLOORS = {"word_length": 0.06, "symbol_share": 0.03, "capital_share": 0.06, "mark_share": 0.05, "dup_line_share": 0.15, "repeat_share": 0.10}
FEATURES = tuple(FLOORS)
#: Words that a document counts as having besides its own, so that shares of short texts vary less.
PRIOR_WORDS = 40
#: Whole units of a statistic: one QUANTUM each.
QUANTUM = 1 / 2000
SHARE, MOST_STEPS, MIN_POOL, CELLS = 0.5, 20, 80, 16
#: Change of a determinant's logarithm that counts as none.
SETTLED = 1e-2
#: Chance that a document of a normal pool is rejected.
TAIL = 1e-9
#: Chance beyond which a document has no weight in the final estimate.
REWEIGHT_TAIL = 0.025


def chi2_cdf(x: float, p: int) -> float:
    """Distribution function of chi-squared with p degrees of freedom (power series)."""
    if x <= 0:
        return 0.0
    a, t = p / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= t / n
        total += term
    return total * math.exp(a * math.log(t) - t - math.lgamma(a))


def chi2_quantile(tail: float, p: int) -> float:
    """The value that chi-squared exceeds with probability ``tail``."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi2_cdf(mid, p) > tail else (low, mid)
    return high


def consistency(share: float, p: int) -> float:
    """What the covariance of the nearest ``share`` of a normal pool lacks."""
    return share / chi2_cdf(chi2_quantile(1 - share, p), p + 2)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words that lie in a window of ``width`` words found twice or more.

    Windows are cut by a look-ahead at every word. Where all differ the answer
    is 0; else sorted (window, place) pairs show which have an equal neighbour,
    and their places, in order, how many words they cover.
    """
    window = " ".join(["[^ ]+"] * width)
    windows = F.regexp_extract_all(F.array_join(words, " "), F.lit(f"(?<![^ ])(?=({window}))"), F.lit(1))

    def covered(places: Column) -> Column:
        steps = F.zip_with(places, F.slice(places, 2, F.greatest(F.size(places), F.lit(1))), lambda a, b: F.least(F.lit(width), F.coalesce(b - a, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def twice(pairs: Column) -> Column:
        held = F.filter(pairs, lambda x, i: F.coalesce(F.get(pairs, i - 1)["w"] == x["w"], F.lit(False)) | F.coalesce(F.get(pairs, i + 1)["w"] == x["w"], F.lit(False)))
        return F.array_sort(F.transform(held, lambda x: x["i"]))

    def count(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_let(_let(pairs, twice), covered))

    return F.when(F.size(words) <= width, F.lit(0)).otherwise(_let(windows, count)).cast("long")


def _count_of(text: Column, letters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, letters, ""))).cast("long")


def _arcsine(part: Column, whole: Column) -> Column:
    return F.asin(F.sqrt(F.least(F.lit(1.0), part / whole)))


def _row_key() -> Column:
    """Two hashes of a row's id, language, source and text, which tell its verdict apart from those of others."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("doc_id", "lang", "source", "text")]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *reversed(parts)).alias("b"))


def statistics(docs: DataFrame) -> DataFrame:
    """Base counts, base_failed and the quantised features of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(docs, doc_id="long", text="string", lang="string", source="string")
    worded = rows.select("doc_id", "lang", "source", _row_key().alias("key"), text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    counted = worded.select(
        "doc_id", "lang", "source", "key",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("text"), CAPITALS).alias("n_capitals"),
        _count_of(F.col("text"), MARKS).alias("n_marks"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    n, chars = F.col("n_words"), F.col("word_chars")
    failed = (n < 10) | (100 * F.col("n_repeat_words") > 20 * n)
    values = {
        "word_length": F.log((chars + 5 * PRIOR_WORDS) / (n + PRIOR_WORDS)),
        "symbol_share": _arcsine(F.col("n_symbols"), chars + 5 * PRIOR_WORDS),
        "capital_share": _arcsine(F.col("n_capitals"), chars + 5 * PRIOR_WORDS),
        "mark_share": _arcsine(F.col("n_marks"), chars + 5 * PRIOR_WORDS),
        "dup_line_share": _arcsine(F.col("lines.dup"), F.col("lines.n") + 10),
        "repeat_share": _arcsine(F.col("n_repeat_words"), n + PRIOR_WORDS),
    }
    return counted.select(
        "doc_id", "lang", "source", "key", "n_words", "word_chars", "n_symbols",
        F.col("lines.dup").alias("n_dup_lines"), "n_repeat_words", failed.alias("base_failed"),
        *[F.round(v / QUANTUM).cast("long").alias(name) for name, v in values.items()],
    )


def pooled(rows: DataFrame) -> DataFrame:
    """``rows`` with the key of each one's pool."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    keyed = rows.withColumn("by_lang", part("lang")).withColumn("by_both", F.concat_ws("\x1f", "by_lang", part("source")))
    sizes = stored(keyed.where(~F.col("base_failed")).groupBy("by_lang", "by_both").count(), "mcd-sizes")
    own = F.when(F.col("count") >= MIN_POOL, F.col("by_both"))
    # Languages with enough documents in small pools, by partial sums: sources may be many.
    rests = sizes.where(F.col("count") < MIN_POOL).groupBy("by_lang").agg(F.sum("count").alias("rest")).where(F.col("rest") >= MIN_POOL)
    told = join_small(sizes, stored(rests, "mcd-languages"), "by_lang", "left")
    pools = told.select("by_both", F.coalesce(own, F.when(F.col("rest").isNotNull(), F.col("by_lang")), F.lit("*")).alias("pool"))
    return join_small(keyed, stored(pools, "mcd-pools"), "by_both", "left").withColumn("pool", F.coalesce("pool", F.lit("*"))).drop("by_lang", "by_both")


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


def _moments() -> list[Column]:
    """Exact sums of the features and their products.

    Longs hold them: a statistic has 44,000 quanta at most (a text of 2^31
    letters in one word), so that 4.7 billion such rows of a pool fit, and some
    10^12 ordinary ones. Decimals would cost the driver, which compiles the code
    of every step, and the tasks more.
    """
    return [F.count("*").alias("n"), *[F.sum(a).alias(f"s{i}") for i, a in enumerate(FEATURES)], *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}_{j}") for i, j in _pairs()]]


def _added(taken: Column) -> list[Column]:
    """Sums of cells' moments, each cell's by the part of its rows that is taken."""
    part = lambda c: F.when(taken == F.col("n"), F.col(c)).otherwise(F.round(F.col(c).cast("double") * taken / F.col("n")).cast("long"))
    names = [*[f"s{i}" for i in range(len(FEATURES))], *[f"s{i}_{j}" for i, j in _pairs()]]
    return [F.sum(taken).alias("n"), *[F.sum(part(c)).alias(c) for c in names]]


def _named(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``rows`` with ``columns``, each of which may use those before it.

    One select with lateral aliases: a chain of ``withColumn`` would have the
    driver analyse the whole plan anew for every link, step after step.
    """
    return rows.select("*", *[value.alias(name) for name, value in columns.items()])


def _factored(moments: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Means, the Cholesky factor of the scatter (in quanta) and the logarithm of its determinant."""
    p = len(FEATURES)
    n = F.col("n").cast("double")
    named = {f"m{i}": F.col(f"s{i}").cast("double") / n for i in range(p)}
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    for i, j in _pairs():
        # n * sum(xy) - sum(x) * sum(y) in whole numbers: nothing is lost by cancellation.
        exact = (F.col("n").cast("decimal(14,0)") * whole(f"s{i}_{j}") - whole(f"s{i}") * whole(f"s{j}")).cast("double") / n / n
        named[f"c{i}_{j}"] = exact * factor + (F.lit((FLOORS[FEATURES[i]] / QUANTUM) ** 2) if i == j else F.lit(0.0))
    for j in range(p):
        # A column of the factor: its diagonal, then what stands below.
        left = lambda i: F.col(f"c{i}_{j}") - (reduce(Column.__add__, [F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)]) if j else F.lit(0.0))  # noqa: B023, E731
        named[f"l{j}_{j}"] = F.sqrt(left(j))
        named |= {f"l{i}_{j}": left(i) / F.col(f"l{j}_{j}") for i in range(j + 1, p)}
    out = _named(moments, named)
    logdet = reduce(Column.__add__, [2 * F.log(F.col(f"l{i}_{i}")) for i in range(p)])
    return out.select(*keys, "n", logdet.alias("logdet"), *[f"m{i}" for i in range(p)], *[f"l{i}_{j}" for i, j in _pairs()])


def _distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution, as column d2."""
    named = {}
    for i, name in enumerate(FEATURES):
        inner = [F.col(f"l{i}_{k}") * F.col(f"z{k}") for k in range(i)]
        named[f"z{i}"] = (F.col(name) - F.col(f"m{i}") - (reduce(Column.__add__, inner) if inner else F.lit(0.0))) / F.col(f"l{i}_{i}")
    return _named(rows, named | {"d2": reduce(Column.__add__, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(FEATURES))])})


def _first_estimates(rows: DataFrame) -> DataFrame:
    """Start 0: medians and median deviations; start 1: classical moments."""
    p = len(FEATURES)
    # Exact medians: a pool's map holds an entry for each quantum in use at most.
    middle = rows.groupBy("pool").agg(F.count("*").alias("n"), *[F.median(a).alias(f"m{i}") for i, a in enumerate(FEATURES)])
    middle = stored(middle, "mcd-medians")
    spread = join_small(rows, middle, "pool").groupBy("pool").agg(*[(1.4826 * F.median(F.abs(F.round(F.col(a) - F.col(f"m{i}"))))).alias(f"d{i}") for i, a in enumerate(FEATURES)])
    floor = [(FLOORS[a] / QUANTUM) ** 2 for a in FEATURES]
    robust = middle.join(spread, "pool").withColumns({f"l{i}_{j}": F.sqrt(F.col(f"d{i}") ** 2 + floor[i]) if i == j else F.lit(0.0) for i, j in _pairs()})
    robust = robust.select(F.lit(0).alias("start"), "pool", "n", F.lit(0.0).alias("logdet"), *[f"m{i}" for i in range(p)], *[f"l{i}_{j}" for i, j in _pairs()])
    classical = _factored(rows.groupBy("pool").agg(*_moments()), ["pool"], 1.0).select(F.lit(1).alias("start"), "*")
    return robust.unionByName(classical)


def estimates(rows: DataFrame) -> DataFrame:
    """The reweighted MCD estimate of every pool of MIN_POOL rows or more."""
    p = len(FEATURES)
    present = stored(_first_estimates(rows), "mcd-start")
    factor, count = consistency(SHARE, p), present.count()
    for _ in range(MOST_STEPS):
        measured = _distance(join_small(rows, present.drop("n", "old").withColumnRenamed("logdet", "old"), "pool", count=count))
        cell = F.floor(F.log2(1 + F.col("d2")) * CELLS).cast("int")
        cells = measured.withColumn("cell", cell).groupBy("pool", "start", "old", "cell").agg(*_moments())
        within = Window.partitionBy("pool", "start", "old")
        nearer = F.coalesce(F.sum("n").over(within.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        wanted = F.ceil(F.sum("n").over(within) * SHARE) - nearer
        chosen = cells.withColumn("taken", F.least(F.col("n"), wanted)).where("taken > 0")
        keys = ["pool", "start", "old"]
        before, present = present, stored(_factored(chosen.groupBy(*keys).agg(*_added(F.col("taken"))), keys, factor), "mcd-step")
        discard(before)
        count, moved = present.agg(F.count("*"), F.count_if(F.abs(F.col("logdet") - F.col("old")) > SETTLED)).first()
        if not moved:
            break
    best = present.groupBy("pool").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    raw = stored(present.join(best, ["pool", "start"]).drop("start", "old"), "mcd-best")
    near = _distance(join_small(rows, raw.drop("n"), "pool")).where(F.col("d2") <= chi2_quantile(REWEIGHT_TAIL, p))
    final = _factored(near.groupBy("pool").agg(*_moments()), ["pool"], consistency(1 - REWEIGHT_TAIL, p))
    return stored(final.where(F.col("n") >= MIN_POOL * SHARE / 2), "mcd-final")


def _judged(docs: DataFrame) -> DataFrame:
    rows = stored(pooled(stored(statistics(docs), "mcd-statistics")), "mcd-rows")
    passed = rows.where(~F.col("base_failed")).select("pool", *FEATURES)
    measured = _distance(join_small(rows, estimates(passed).drop("n"), "pool", "left"))
    outlier = F.coalesce(F.col("d2") > chi2_quantile(TAIL, len(FEATURES)), F.lit(False))
    return measured.withColumns({"distance": F.round(F.sqrt("d2"), 6), "kept": ~F.col("base_failed") & ~outlier})


def judge(docs: DataFrame) -> DataFrame:
    """A row a document: doc_id, lang, source, base counts, base_failed, distance and kept."""
    return _judged(docs).select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")


def kept_only(docs: DataFrame) -> DataFrame:
    """``documents`` without the rows that ``judge`` rejects."""
    rows = pick(docs, **DOCUMENT)
    rejected = stored(_judged(rows).where(~F.col("kept")).select("key"), "mcd-rejected")
    return without(rows.withColumn("key", _row_key()), rejected, "key").drop("key")
