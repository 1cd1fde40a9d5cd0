"""Personal data, and the words that give it away, in DataFrame functions only.

Base spans are patterns: e-mail and IP addresses, card and phone numbers. What
is protected is each distinct value, its contact class (the domain of an
e-mail address, the network of an IP address, the issuer of a card, the area of
a phone number) and its kind as such: three entities a span. All words of the
documents that mention one are then weighed by what they reveal about it: with
N texts, n_e texts that mention entity e, n_t texts with word t, and n_te texts
with both,

    disclosure(t, e) = log2(n_te * N / (n_t * n_e)) / log2(N / n_e),

the pointwise mutual information as a share of all the information there is
about e. A word that gives away REMOVE of it is removed wherever it stands in
the entity's documents, one that gives away GENERALISE is replaced by the
broader term of its form (a number, a code, a name, a word); both need SUPPORT
different texts for a value and CLASS_SUPPORT for a class or kind, since a word
seen beside an entity once shows nothing. All four numbers count equal texts once.

Patterns are written so that matching is linear in the text: possessive runs
that start only where a run starts, and bounded or possessive groups (the
matcher's plain groups recurse). A match's place comes from the lengths of the
pieces between matches. Documents without any match, nearly all, end there.
The others are stored. The words of one row of each distinct text are counted
over all documents (a bitmap holds other words back before the shuffle), and only
pairs of an entity with support and a word rare enough to reveal it are made and
counted. Words are runs of letters, marks and digits, without case; those inside a
span go with the span.

Edge cases: a null text is the empty text; overlapping kinds are both reported
and replaced once; repeated rows are separate rows; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_small, marked, pick, shuffled, stored

KINDS = ("email", "ip", "card", "phone", "term")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Runs of 16 to 19 digits that no digit, with or without one blank or hyphen, continues on either side.
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Words: runs of letters, marks and digits.
TERM = r"[\p{L}\p{M}\p{N}]++"
GENERALISE, REMOVE, SUPPORT, CLASS_SUPPORT = 0.8, 0.95, 2, 5
#: Pairs of an entity and a word that a part of a document may have before they are pruned.
PAIRS = 1_000_000
#: Digits that name a card's issuer, and a phone number's country and area.
ISSUER_DIGITS, AREA_DIGITS = 6, 4
#: What stands in a sanitised text for a span of each kind.
SHOWN = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
#: Broader terms by the form of a word, the first that fits.
BROADER = {r"^\p{N}+$": "[NUMBER]", r"\p{N}": "[CODE]", r"^\p{Lu}": "[NAME]", "": "[WORD]"}

SPAN = "struct<k:int,s:int,e:int,v:string>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _starts(lengths: Column) -> Column:
    """Running totals before each element: over long strides, short strides and elements, in about n ** (4 / 3) steps."""
    total = lambda at, n: F.aggregate(F.slice(lengths, at + 1, n), F.lit(0), lambda a, x: a + x)
    whole = lambda x: F.floor(x).cast("int")
    every = lambda stride: F.sequence(F.lit(0), whole((F.size(lengths) - 1) / stride))

    def in_strides(c: Column) -> Column:
        long = F.transform(every(c * c), lambda k: total(F.lit(0), k * c * c))
        return _let(long, lambda far: _let(
            F.transform(every(c), lambda j: F.get(far, whole(j / c)) + total(whole(j / c) * c * c, (j % c) * c)),
            lambda near: F.transform(lengths, lambda x, i: F.get(near, whole(i / c)) + total(whole(i / c) * c, i % c)),
        ))

    return _let(F.ceil(F.cbrt(F.size(lengths))).cast("int"), in_strides)


def matches(text: Column, pattern: str, kind: int, value, valid) -> Column:
    """array<SPAN> of the leftmost matches that are ``valid``; value: what names the entity."""

    def placed(found: Column) -> Column:
        pieces = F.split(text, pattern, -1)

        def spans(gaps: Column) -> Column:
            lengths = F.transform(found, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
            return _let(_let(lengths, _starts), lambda starts: F.transform(found, lambda m, i: F.struct(
                F.lit(kind).alias("k"),
                (F.get(starts, i) + F.length(F.get(gaps, i))).cast("int").alias("s"),
                (F.get(starts, i) + F.length(F.get(gaps, i)) + F.length(m)).cast("int").alias("e"),
                F.when(valid(m), value(m)).alias("v"),
            )))

        return F.when(F.size(found) == 0, F.array().cast(f"array<{SPAN}>")).otherwise(F.filter(_let(pieces, spans), lambda x: x["v"].isNotNull()))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """The check sum of a digit string: every second digit from the right doubled."""
    number = F.reverse(_digits(m))
    digit = lambda i: F.substring(number, i, 1).cast("int")
    part = lambda i: F.when(i % 2 == 1, digit(i)).otherwise(digit(i) * 2 - F.when(digit(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda a, i: a + part(i)) % 10 == 0


def _parts_fit(m: Column) -> Column:
    """Every part of an address is at most 255, however many zeros it begins with."""
    part = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255")))


def base_spans(text: Column) -> Column:
    """array<SPAN> of the pattern kinds, by kind, then place."""
    none = F.array().cast(f"array<{SPAN}>")
    email = F.when(F.contains(text, F.lit("@")), matches(text, EMAIL, 0, F.lower, lambda m: F.lit(True))).otherwise(none)
    ip = matches(text, IP, 1, lambda m: m, _parts_fit)
    card = matches(text, CARD, 2, _digits, _luhn)
    phone = F.when(F.contains(text, F.lit("+")), matches(text, PHONE, 3, _digits, lambda m: F.length(_digits(m)).between(8, 15))).otherwise(none)
    return F.concat(email, F.when(F.rlike(text, F.lit("[0-9]")), F.concat(ip, card)).otherwise(none), phone)


def words_of(text: Column) -> Column:
    """The distinct words of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def entities_of(spans: Column) -> Column:
    """The distinct entities of a text: values (v), contact classes (c) and kinds (k), each by kind."""
    group = lambda x: F.when(x["k"] == 0, F.substring_index(x["v"], "@", -1)).when(x["k"] == 1, F.substring_index(x["v"], ".", 2)).otherwise(F.left(x["v"], F.when(x["k"] == 2, F.lit(ISSUER_DIGITS)).otherwise(F.lit(AREA_DIGITS))))
    named = lambda level, x, value: F.concat(F.lit(level), x["k"].cast("string"), F.lit(":"), value)
    return F.array_distinct(F.flatten(F.transform(spans, lambda x: F.array(named("v", x, x["v"]), named("c", x, group(x)), named("k", x, F.lit(""))))))


def _support() -> Column:
    """Distinct texts that must show what an entity's words reveal."""
    return F.when(F.col("entity").startswith("v"), F.lit(SUPPORT)).otherwise(F.lit(CLASS_SUPPORT))


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with a blank for each code point of its spans."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, x: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, F.greatest(x["s"] - done["at"], F.lit(0)))
        return F.struct(
            F.greatest(done["at"], x["e"]).alias("at"),
            F.concat(done["out"], gap, F.repeat(F.lit(" "), F.greatest(x["e"] - F.greatest(x["s"], done["at"]), F.lit(0)))).alias("out"),
        )

    cuts = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
    return F.aggregate(cuts, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))


def free_terms(text: Column, spans: Column) -> Column:
    """array<SPAN> of the words outside the spans."""
    return _let(blanked(text, spans), lambda t: matches(t, TERM, 4, F.lower, lambda m: F.lit(True)))


def _pair() -> Column:
    return F.concat_ws("\x1f", "entity", "term").alias("pair")


def _counted_terms(once: DataFrame, docs: DataFrame, copies: DataFrame) -> DataFrame:
    """term and n_t, the distinct texts of the corpus with it, of the words that SUPPORT texts with entities or more have.

    Equal texts count once: words of texts that repeat (or meet one that does in
    the bitmap) by text first, others at once.
    """
    wanted = once.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT).select("term")
    wanted = stored(wanted, "pii-words")
    told = marked(docs.select("text", F.xxhash64("text").alias("content")), copies.where("count > 1"), "content")
    held = told.select(F.when(F.col("maybe"), F.col("content")).alias("content"), F.explode(words_of(F.col("text"))).alias("term"))
    held = marked(held, wanted, "term").where("maybe").groupBy("content", "term").agg(F.count("*").alias("n"))
    counted = held.groupBy("term").agg(F.sum(F.when(F.col("content").isNull(), F.col("n")).otherwise(1)).alias("n_t"))
    return stored(counted.join(shuffled(wanted), "term", "left_semi"), "pii-terms")


def _enough(n_t: Column, n_e: Column, total: Column) -> Column:
    """Whether a word can reach GENERALISE at all: n_te is n_e at most, so n_t is no more than n_e * (N / n_e) ** (1 - GENERALISE)."""
    return n_t <= n_e * F.pow(total / n_e, F.lit(1 - GENERALISE)) * 1.000001


def disclosures(found: DataFrame, docs: DataFrame) -> DataFrame:
    """entity, term and disclosure of the pairs that reach GENERALISE.

    found: text and spans of the documents with entities; docs: text of all. Words
    are counted first: of a document's words only those in SUPPORT texts or more,
    and of these for each entity only those rare enough to reveal it, are paired
    with its entities. A document's pairs are dealt by word, PAIRS to a part, so a
    long list of addresses does not fall to one task.
    """
    firsts = stored(found.groupBy(F.xxhash64("text").alias("content")).agg(F.min("row").alias("row")).select("row"), "pii-texts")
    once = join_small(found.select("row", "text", entities_of(F.col("spans")).alias("entities")), firsts, "row")
    once = once.select("row", "entities", words_of(F.col("text")).alias("words"))
    ways = F.greatest(F.lit(1), F.ceil(F.size("entities").cast("long") * F.size("words") / PAIRS))
    once = stored(once.withColumn("ways", ways), "pii-once")
    copies = stored(docs.select(F.xxhash64("text").alias("content")).groupBy("content").count(), "pii-copies")
    total = copies.count()
    listed = once.select("row", "ways", F.explode("entities").alias("entity"))
    entities = stored(listed.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= _support()), "pii-entities")
    terms = _counted_terms(once, docs, copies)
    most = entities.agg(F.max("n_e").alias("n")).first()["n"] or 0
    rare = stored(terms.where(_enough(F.col("n_t"), F.lit(most), F.lit(total))), "pii-rare") if most else terms.where("false")
    named = join_small(marked(listed, entities, "entity").where("maybe").drop("maybe"), entities, "entity")
    worded = join_small(marked(once.select("row", "ways", F.explode("words").alias("term")), rare, "term").where("maybe").drop("maybe"), rare, "term")
    left = named.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1))).drop("ways")
    right = worded.withColumn("part", F.pmod(F.xxhash64("term"), F.col("ways"))).drop("ways")
    together = left.join(right, ["row", "part"]).where(_enough(F.col("n_t"), F.col("n_e"), F.lit(total)))
    # Distinct texts: a row of ``once`` is one, and has each entity and each word once.
    weighed = together.groupBy("entity", "term", "n_e", "n_t").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= _support())
    information = F.log2(F.lit(total) / F.col("n_e"))
    share = F.log2(F.col("n_te") * F.lit(total) / (F.col("n_t") * F.col("n_e"))) / information
    return weighed.where(information > 0).select("entity", "term", F.least(share, F.lit(1.0)).alias("disclosure")).where(F.col("disclosure") >= GENERALISE)


def _joined(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def detect(docs: DataFrame, keep: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The documents without entities, and those with: columns ``keep``, text, spans and terms.

    terms: array of (s, e, removed) of the words that give an entity of their
    document away, by place.
    """
    columns = {"text": "string"} | keep
    picked = pick(docs, **columns).withColumn("text", F.coalesce("text", F.lit("")))
    spanned = picked.withColumn("spans", base_spans(F.col("text")))
    clean = spanned.where(F.size("spans") == 0).withColumn("terms", F.array().cast("array<struct<s:int,e:int,removed:boolean>>"))
    found = stored(spanned.where(F.size("spans") > 0).withColumn("row", F.monotonically_increasing_id()), "pii-found")
    revealing = stored(disclosures(found, picked).select("entity", _pair(), "disclosure"), "pii-disclosures")
    # The revealing words of each document first; only documents that have some need their places.
    worded = found.select("row", words_of(F.col("text")).alias("words"), entities_of(F.col("spans")).alias("entities")).select("row", "words", F.explode("entities").alias("entity"))
    told = marked(worded, revealing, "entity").where("maybe").select("row", "entity", F.explode("words").alias("term"))
    near = join_small(marked(told.select("row", "term", _pair()), revealing, "pair").where("maybe").drop("maybe"), revealing.drop("entity"), "pair")
    place = F.xxhash64("row", "term").alias("place")
    hits = stored(near.groupBy("row", "term").agg((F.max("disclosure") >= REMOVE).alias("removed")).select("*", place), "pii-hits")
    cut = join_small(found.select("row", "text", "spans"), stored(hits.select("row").distinct(), "pii-hit-rows"), "row")
    words = cut.select("row", F.explode(free_terms(F.col("text"), F.col("spans"))).alias("x")).select("row", "x.s", "x.e", F.col("x.v").alias("term"))
    each = marked(words.select("*", place), hits, "place").where("maybe").drop("maybe", "place").join(shuffled(hits.drop("place")), ["row", "term"])
    terms = each.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("s", "e", "removed"))).alias("terms"))
    found = found.join(terms, "row", "left").drop("row").withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<s:int,e:int,removed:boolean>>")))
    return clean, found.select(*clean.columns)


def report(docs: DataFrame) -> DataFrame:
    """A row a document: doc_id, the counts by kind, base_sha256, spans, n_term."""
    clean, found = detect(docs, {"doc_id": "long"})
    rows = clean.unionByName(found)
    of = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    term_spans = F.transform("terms", lambda t: F.struct(F.lit(4).alias("k"), t["s"].alias("s"), t["e"].alias("e"), F.lit("").alias("v")))
    return rows.select(
        "doc_id",
        *[of(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"),
        _joined(F.concat("spans", term_spans)).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def broader(word: Column) -> Column:
    """The broader term that stands for a word."""
    return F.coalesce(*[F.when(F.rlike(word, F.lit(form)), F.lit(term)) for form, term in BROADER.items()])


def sanitised(text: Column, spans: Column, terms: Column) -> Column:
    """``text`` with spans replaced by their kind and revealing words by a broader term; removed words leave nothing."""
    shown = F.array(*map(F.lit, SHOWN.values()))
    cuts = F.concat(
        F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.element_at(shown, x["k"] + 1).alias("by"))),
        F.transform(terms, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(x["removed"], F.lit("")).otherwise(broader(F.substring(text, x["s"] + 1, x["e"] - x["s"]))).alias("by"))),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, cut: Column) -> Column:
        ahead = cut["s"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], cut["e"]).alias("at"),
            F.when(ahead, F.concat(done["out"], F.substring(text, done["at"] + 1, cut["s"] - done["at"]), cut["by"])).otherwise(done["out"]).alias("out"),
        )

    return F.aggregate(F.array_sort(cuts), start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))


def sanitise(docs: DataFrame) -> DataFrame:
    """``documents`` with personal data and the words that reveal it replaced; n_chars follows.

    Texts without any are passed on as they are, nulls too.
    """
    kept = {"doc_id": "long", "lang": "string", "source": "string", "n_chars": "long", "was_null": "boolean"}
    rows = pick(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long").withColumn("was_null", F.col("text").isNull())
    clean, found = detect(rows, kept)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    same = clean.withColumn("text", F.when(~F.col("was_null"), F.col("text")))
    changed = found.withColumn("text", sanitised(F.col("text"), F.col("spans"), F.col("terms"))).withColumn("n_chars", F.length("text").cast("long"))
    return same.select(*columns).unionByName(changed.select(*columns))
