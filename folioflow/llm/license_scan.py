"""License notices by an exact set-similarity join of text blocks and templates.

Blocks are windows of a text's words, across its lines, at every half window, so
any stretch of half a window lies whole in one block. A block meets a template
if it holds ``need`` of the template's distinct words, the share CONTAINMENT
rounded up. Templates of up to SHORT_WORDS words are looked for in windows of
SHORT_WINDOW words, so that they can't be put together from words far apart;
longer ones in windows of WINDOW words. The join is exact and uses three filters
over one global order of the template words, rarest in the corpus first:

* prefix: ``need`` shared words leave a template at most size - need others, so
  a match shows within its first size - need + 1 words; only those are indexed,
  and likewise for a block only its first words are looked up;
* length: a block needs ``need`` template words at all;
* position: the words that follow a hit on both sides must suffice.

Texts are read once: their words, with all but template words blanked (others
can't count), are stored, and give both the order and the blocks. Most texts
hold no indexed word at all, so few rows are exploded. The index has a row for
each indexed word of each template: its size is that of the parameter, never of
the corpus, and it is broadcast. The verified hits of a row meet again by a row
number; nothing else is shuffled.

Edge cases: a null text is the empty text (no words, score 0); very long texts
are just more blocks; words of equal frequency are ordered by themselves;
repeated rows are separate rows; a template with more words than half a window
is refused; an empty table gives no rows; other columns of any name go.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that are found wherever their words stand in a row (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Share of a template's words that a block must hold.
CONTAINMENT = 0.8
#: Words of a block; a template may have half as many. Those of up to SHORT_WORDS words take the short blocks.
WINDOW, SHORT_WINDOW, SHORT_WORDS = 48, 12, 6
#: Notices to look for, by label: short notices, the pieces of the standard texts, and lines of their usual wrapping.
#: A template of at most four words needs them all, so that what names the license can't be the word that is missing.
TEMPLATES: list[tuple[str, str]] = [
    ("mit", "released under mit license"),
    ("mit", "licensed under mit license"),
    ("mit", "spdx identifier mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise"),
    ("apache-2", "apache license version 2"),
    ("apache-2", "under apache license 2"),
    ("apache-2", "spdx identifier apache 2"),
    ("apache-2", "you may obtain a copy of the license at www apache org licenses license 2 0"),
    ("apache-2", "www apache org licenses license 2 0"),
    ("bsd", "under bsd license"),
    ("bsd", "bsd clause license"),
    ("bsd", "by bsd style license"),
    ("bsd", "spdx identifier bsd clause"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistribution and use in source and binary forms with or without"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"),
    ("bsd", "procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under gnu general public"),
    ("gpl", "under gnu gpl"),
    ("gpl", "licensed under gpl"),
    ("gpl", "released under gpl"),
    ("gpl", "licensed under gplv2"),
    ("gpl", "licensed under gplv3"),
    ("gpl", "spdx identifier gpl"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl", "received a copy of the gnu general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "mozilla public license 2"),
    ("mpl-2", "spdx identifier mpl 2"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public"),
    ("mpl-2", "if a copy of the mpl was not distributed with this file you can obtain one at mozilla org mpl 2 0"),
    ("mpl-2", "obtain one at mozilla org mpl 2 0"),
    ("cc-by-nc", "under cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nc", "creativecommons licenses by nc"),
    ("cc-by-nc", "spdx cc by nc"),
    ("cc-by-sa", "under cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-sa", "creativecommons licenses by sa"),
    ("cc-by-sa", "spdx cc by sa"),
    ("all-rights-reserved", "all rights reserved"),
]


def _words_of(text: str) -> list[str]:
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def window_of(words: list[str]) -> int:
    """Words of the blocks in which a template is looked for."""
    return SHORT_WINDOW if len(words) <= SHORT_WORDS else WINDOW


def prepared(templates: list[tuple[str, str]], share: float) -> list[tuple[str, list[str], int]]:
    """Label, distinct words and needed words of each template."""
    out = []
    for label, text in templates:
        words = sorted(set(_words_of(text)))
        if not words or len(words) > WINDOW // 2:
            raise ValueError(f"a template needs 1 to {WINDOW // 2} distinct words: {text!r}")
        out.append((label, words, max(1, math.ceil(share * len(words) - 1e-9))))
    return out


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _lit(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def word_order(held: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template words by the number of texts that hold them, rarest first.

    held: rows with ``words``, others than template words blank. A count for each
    template word reaches the driver, however large the corpus.
    """
    counts = held.select(F.explode(F.array_distinct("words")).alias("word")).where("word <> ''").groupBy("word").count().collect()
    found = {r["word"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def _placer(words: Column, n: int):
    """From the pieces between a phrase of n words: its count, first and last place; null without any."""
    return lambda p: F.when(
        F.size(p) > 1,
        F.struct(
            (F.size(p) - 1).cast("long").alias("n"),
            _spaces(p[0]).cast("long").alias("first"),
            (F.size(words) - (_spaces(F.element_at(p, -1)) - 1) - n).cast("long").alias("last"),
        ),
    )


def phrase_places(words: Column, lower: Column) -> dict[str, Column]:
    """n_base, first_word, last_word and the array base_set of the fixed phrases.

    The words are joined by blanks and split at a phrase; the blanks of a piece
    count its words. Only texts with the phrase's characters are joined.
    """
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        parts = phrase.split(" ")
        rare = max(parts, key=len)
        likely = F.contains(lower, F.lit(rare))
        pieces = F.when(likely, F.split(joined, f" {phrase}(?= )")).otherwise(F.array(F.lit(" ")))
        # One evaluation of the pieces serves all four columns.
        place = F.element_at(F.transform(F.array(pieces), _placer(words, len(parts))), 1)
        counts.append(F.coalesce(place["n"], F.lit(0).cast("long")))
        firsts.append(place["first"])
        lasts.append(place["last"])
        labels.append(F.when(place.isNotNull(), F.lit(label)))
    return {
        "n_base": sum(counts[1:], counts[0]),
        "first_word": F.least(*firsts),
        "last_word": F.greatest(*lasts),
        "base_set": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def _blocks(words: Column, window: int, order: list[str], indexed: list[str], least: int) -> Column:
    """array<struct<window, block>>: the distinct blocks with ``least`` template words or more, in the global order; none without an indexed word."""
    half = window // 2
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - half - 1, F.lit(0)), F.lit(half))
    cut = F.transform(starts, lambda i: F.array_intersect(_lit(order), F.slice(words, i + 1, window)))
    kept = F.transform(F.array_distinct(F.filter(cut, lambda b: F.size(b) >= least)), lambda b: F.struct(F.lit(window).alias("window"), b.alias("block")))
    return F.when(F.arrays_overlap(words, _lit(indexed)), kept).otherwise(F.array().cast("array<struct<window:int,block:array<string>>>"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, share: float = CONTAINMENT) -> DataFrame:
    """A row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score: the largest share of a template that a block of the text holds,
    from ``share`` on; 1 where a phrase stands; else 0.
    """
    known = prepared(TEMPLATES if templates is None else templates, share)
    vocabulary = sorted({w for _, words, _ in known for w in words})
    base = pick(docs, doc_id="long", text="string").select("doc_id", lowered(F.col("text")).alias("lower"))
    base = base.select("doc_id", "lower", F.regexp_extract_all("lower", F.lit(WORD), F.lit(0)).alias("all_words"))
    found = phrase_places(F.col("all_words"), F.col("lower"))
    blanked = F.transform("all_words", lambda w: F.when(w.isin(*vocabulary), w).otherwise(F.lit("")))
    rows = base.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("all_words").cast("long").alias("n_words"),
        *[c.alias(n) for n, c in found.items()],
        F.when(F.arrays_overlap("all_words", _lit(vocabulary)), blanked).otherwise(F.array().cast("array<string>")).alias("words"),
    )
    rows = stored(rows, "license-words")

    order = word_order(rows, vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    index_rows, blocks = [], []
    for window in (SHORT_WINDOW, WINDOW):
        indexed, least = set(), WINDOW
        for label, words, need in known:
            if window_of(words) == window:
                ranked = sorted(words, key=rank.__getitem__)
                least = min(least, need)
                for place, word in enumerate(ranked[: len(ranked) - need + 1]):
                    index_rows.append((window, word, label, place, len(ranked), need, ranked))
                    indexed.add(word)
        if indexed:
            blocks.append(_blocks(F.col("words"), window, order, sorted(indexed), least))
    index = docs.sparkSession.createDataFrame(index_rows, "window int, word string, label string, place int, size int, need int, template array<string>")
    blocked = rows.select("row", "doc_id", "n_words", *found, F.explode_outer(F.concat(*blocks)).alias("x")).select("row", "doc_id", "n_words", *found, "x.window", "x.block")
    looked_up = blocked.select("*", F.posexplode_outer("block").alias("at", "word"))
    hits = looked_up.join(F.broadcast(index), ["window", "word"], "left")
    size = F.size("block")
    remaining = F.lit(1) + F.least(F.col("size") - F.col("place") - 1, size - F.col("at") - 1)
    possible = (size >= F.col("need")) & (F.col("at") <= size - F.col("need")) & (remaining >= F.col("need"))
    overlap = F.when(possible, F.size(F.array_intersect("block", "template")))
    met = overlap >= F.col("need")
    verified = hits.select("row", "doc_id", "n_words", *found, F.when(met, F.col("label")).alias("label"), F.when(met, overlap / F.col("size")).alias("held"))
    together = verified.groupBy("row").agg(*[F.first(c).alias(c) for c in ("doc_id", "n_words", *found)], F.collect_set("label").alias("own"), F.max("held").alias("held"))
    return together.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_set", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_set", "own")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("held", F.lit(0.0))).cast("double").alias("score"),
    )


def oracle_sql(templates: list[tuple[str, str]] | None = None, share: float = CONTAINMENT) -> str:
    """The same by brute force in DuckDB: every window against every template."""
    known = prepared(TEMPLATES if templates is None else templates, share)
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(f"({i}, {window_of(words)}, '{label}', {quoted(words)}, {need})" for i, (label, words, need) in enumerate(known))
    phrases = ", ".join(f"({quoted(p.split(' '))}, '{label}')" for p, label in PHRASES.items())
    word = WORD.replace("'", "''")
    return f"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS lower FROM documents),
worded AS (SELECT doc_id, lower, regexp_extract_all(lower, '{word}') AS words FROM lowered),
phrases(parts, label) AS (VALUES {phrases}),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(1, len(words) - len(parts) + 2), lambda i: words[i:i + len(parts) - 1] = parts)) - 1 AS place
  FROM worded, phrases),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS base_set
  FROM places GROUP BY doc_id),
block AS (
  SELECT row_number() OVER () AS b, doc_id, size_of, words[s + 1:s + size_of] AS words
  FROM (SELECT doc_id, words, size_of, unnest(range(0, greatest(len(words) - size_of // 2 - 1, 0) + 1, size_of // 2)) AS s
        FROM worded, (VALUES ({SHORT_WINDOW}), ({WINDOW})) sizes(size_of))),
templates(t, size_of, label, parts, need) AS (VALUES {rows}),
parts AS (SELECT t, size_of, label, need, len(parts) AS size, unnest(parts) AS word FROM templates),
block_words AS (SELECT DISTINCT b, doc_id, size_of, unnest(words) AS word FROM block),
met AS (
  SELECT doc_id, b, t, label, count(*) / size AS held
  FROM block_words JOIN parts USING (size_of, word) GROUP BY doc_id, b, t, label, size, need HAVING count(*) >= need),
own AS (SELECT doc_id, list(DISTINCT label) AS own_set, max(held) AS held FROM met GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base_set), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_set, []), coalesce(own_set, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(held, 0.0) END::DOUBLE AS score
FROM worded w LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""
