"""End-to-end plans: catalogue to graph, texts to TEI."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, merge, sentences, tei, triples, validate
from ..sources import rdf, zipcsv


def catalogue_graph(rows: DataFrame, prefix: str = "urn:folioflow:", merge_mode: str = "collect", list_mode: str = "multi", date_type: str = "date", labels: dict[str, str] | None = None, parity: bool = False, strict: bool = False) -> DataFrame:
    """The triples of a catalogue's works and persons, as a set.

    One projection of the rows, an aggregation by work and one by person with
    partial states, the lift, and the shuffle that makes a set.
    """
    pairs = catalog.entities(rows, prefix=prefix, labels=labels, parity=parity, strict=strict)
    works, persons = merge.merged_catalogue(pairs, merge_mode)
    links = {r for r in catalog.RELATIONS} | {f"{r}_of" for r in catalog.RELATIONS}
    lifted = [triples.lift(x, "id", links=links, link_prefix=prefix, mode=list_mode, date_type=date_type) for x in (works, persons)]
    return triples.as_graph(*lifted)


def catalogue_violations(rows: DataFrame) -> DataFrame:
    """kind, id and broken rule of the merged entities that break one."""
    works, persons = merge.merged_catalogue(catalog.entities(rows))
    parts = []
    for frame, key, rules in ((works, "work_id", validate.work_rules()), (persons, "person_id", validate.person_rules())):
        parts.append(validate.invalid(frame, rules).select(F.lit(key.removesuffix("_id")).alias("kind"), F.col(key).alias("id"), F.explode("violations").alias("rule")))
    return parts[0].unionByName(parts[1])


def convert_catalogue(spark: SparkSession, source: str, target: str, form: str = "turtle", single: bool = False, **options) -> DataFrame:
    """Read a catalogue, write its graph, and return it. single: to one file, by one task, for a small graph."""
    graph = catalogue_graph(zipcsv.read_catalogue(spark, source), **options)
    prefixes = {k: v for k, v in triples.PREFIXES.items() if k} if form == "turtle" else None
    rdf.write_graph(graph, target, form, prefixes, single)
    return graph


def tei_documents(texts: DataFrame, key: str, column: str, title: Column, authors: Column | None = None, terminators: str = sentences.X.TERMINATORS, closers: str = sentences.X.CLOSERS) -> DataFrame:
    """key and xml: a TEI document of every text, its extent measured. One pass, no shuffle.

    Paragraphs and sentences are cut once; the measures are their sizes.
    """
    text, none = F.coalesce(F.col(column), F.lit("")), F.lit(None)
    people = authors if authors is not None else F.array().cast("array<string>")
    cut = texts.select(key, text.alias("_text"), title.alias("_title"), people.alias("_people"), sentences.nested(text, terminators, closers).alias("_paragraphs"))
    sizes = sentences.measured(F.col("_text"), F.col("_paragraphs"))
    extent = F.struct(*[sizes.get(n, none.cast("long")).alias(n) for n in ("character_count", "suw_count", "paragraph_count", "sentence_count")])
    unknown = ("publications", "source_description", "responsibilities", "factuality_type", "class_codes", "text_type", "derivation_type", "constitution_type", "purpose_type", "purpose_degree", "changes")
    record = F.struct(F.col("_title").alias("title"), F.col("_people").alias("authors"), F.array().cast("array<string>").alias("editors"), extent.alias("extent"), *[none.alias(n) for n in unknown])
    prepared = cut.select(key, record.cast(tei.HEADER).alias("_record"), "_paragraphs")
    return prepared.select(key, tei.tei(tei.header(F.col("_record")), tei.body(F.col("_paragraphs"))).alias("xml"))
