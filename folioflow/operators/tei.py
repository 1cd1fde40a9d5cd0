"""TEI P5 documents from header records and paragraph tables, as string expressions.

A document is one XML string built by JVM expressions: nothing is parsed,
grouped or shuffled, and a document is never split over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAMESPACE = "http://www.tei-c.org/ns/1.0"
#: Header record: what ``header`` reads.
HEADER = (
    "struct<title:string,authors:array<string>,editors:array<string>,extent:struct<character_count:bigint,suw_count:bigint,paragraph_count:bigint,sentence_count:bigint>,"
    "publications:array<struct<publisher:string,distributor:string,availability:string,date:date,idno:string>>,source_description:string,"
    "responsibilities:array<struct<resp:string,names:array<string>>>,factuality_type:string,class_codes:array<struct<category:string,childrens:boolean>>,text_type:string,"
    "derivation_type:string,constitution_type:string,purpose_type:string,purpose_degree:string,changes:array<struct<when:date,who:string>>>"
)
#: Quotation record: what ``quotation`` takes besides the text.
QUOTATION = "struct<type:string,direct:boolean,aloud:boolean,outside_referer:boolean>"
ENCODING_NOTE = "Converted automatically; boundaries of words, sentences and paragraphs are encoded, some formatting is left out."
PROJECT_NOTE = "Converted from a digital library."


def escape(c: Column) -> Column:
    """Text for element content and attribute values; characters that XML cannot hold go."""
    c = F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x{FFFE}\\x{FFFF}]", "")
    for raw, shown in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(shown))
    return c


def element(name: str, *content: Column | str, **attributes: Column | str | None) -> Column:
    """An element; null content counts as empty, an attribute of null is left out."""
    parts: list[Column] = [F.lit(f"<{name}")]
    for key, value in attributes.items():
        if value is None:
            continue
        shown = escape(F.lit(value) if isinstance(value, str) else value.cast("string"))
        parts.append(F.coalesce(F.concat(F.lit(f' {key.rstrip("_").replace("__", ":")}="'), shown, F.lit('"')), F.lit("")))
    inner = [F.lit(c) if isinstance(c, str) else F.coalesce(c, F.lit("")) for c in content]
    return F.concat(*parts, F.lit(">"), *inner, F.lit(f"</{name}>"))


def each(items: Column, make) -> Column:
    """The elements made of an array's items, in a row."""
    return F.array_join(F.transform(items, make), "")


def header(h: Column) -> Column:
    """The header of a record of the HEADER form."""
    text = lambda name: escape(h[name])
    names = lambda tag, items: each(items, lambda x: element(tag, escape(x)))
    measure = lambda unit, name, word: element("measure", h["extent"][name].cast("string"), F.lit(f" {word}"), unit=unit, quantity=h["extent"][name])
    first = F.get(h["publications"], 0)
    publication = F.concat(
        element("publisher", escape(first["publisher"])),
        element("distributor", escape(first["distributor"])),
        F.coalesce(F.when(first["idno"].isNotNull(), element("idno", escape(first["idno"]), type="ISBN")), F.lit("")),
        element("availability", element("p", escape(first["availability"])), status="free"),
        F.coalesce(F.when(first["date"].isNotNull(), element("date", F.date_format(first["date"], "MMMM d, yyyy"), when=F.date_format(first["date"], "yyyy-MM-dd"))), F.lit("")),
    )
    responsible = each(h["responsibilities"], lambda r: element("respStmt", element("resp", escape(r["resp"])), names("name", r["names"])))
    code = lambda c: element("classCode", F.when(c["childrens"], F.lit("K")).otherwise(F.lit("")), escape(c["category"]), scheme="#NDC")
    file_desc = element(
        "fileDesc",
        element("titleStmt", element("title", text("title")), names("author", h["authors"]), names("editor", h["editors"]), responsible),
        element("editionStmt", element("p")),
        element("extent", measure("characters", "character_count", "characters"), measure("SUWs", "suw_count", "Short Unit Words"), measure("paragraphs", "paragraph_count", "paragraphs"), measure("sentences", "sentence_count", "sentences")),
        element("publicationStmt", F.when(first.isNotNull(), publication).otherwise(element("p"))),
        element("sourceDesc", element("p", text("source_description"))),
    )
    encoding_desc = element(
        "encodingDesc",
        element("projectDesc", element("p", PROJECT_NOTE)),
        element("editorialDecl", element("p", ENCODING_NOTE)),
        element("classDecl", element("taxonomy", element("bibl", element("title", "Nippon Decimal Classification"), element("edition", "9")), xml__id="NDC")),
    )
    profile_desc = element(
        "profileDesc",
        element("langUsage", element("language", "Japanese", ident="ja")),
        element("textDesc", element("channel", mode="w"), element("constitution", type=h["constitution_type"]), element("derivation", type=h["derivation_type"]), element("domain"), element("factuality", type=h["factuality_type"]), element("interaction"), element("preparedness"), element("purpose", type=h["purpose_type"], degree=h["purpose_degree"]), n=h["text_type"]),
        element("textClass", each(h["class_codes"], code)),
    )
    revision_desc = element("revisionDesc", each(h["changes"], lambda c: element("change", "Converted", when=F.date_format(c["when"], "yyyy-MM-dd"), who=c["who"])), status="published")
    return element("teiHeader", file_desc, encoding_desc, profile_desc, revision_desc)


def quotation(text: Column, type: Column, direct: Column, aloud: Column, outside_referer: Column) -> Column:
    """A quotation: ``quote`` if its referer stands outside the text, else ``q``."""
    flag = lambda c: F.when(c, F.lit("true"))
    attributes = {"type": type, "direct": flag(direct), "aloud": flag(aloud)}
    return F.when(F.coalesce(outside_referer, F.lit(False)), element("quote", escape(text), **attributes)).otherwise(element("q", escape(text), **attributes))


def _tags(tags: Column) -> Column:
    return F.when(F.size(tags) > 0, F.array_join(tags, " "))


def body(paragraphs: Column) -> Column:
    """<body> of one division of ``sentences.document`` paragraphs."""
    sentence = lambda s: element("s", escape(s["sentence"]), ana=_tags(s["tags"]))
    return element("body", element("div", each(paragraphs, lambda p: element("p", each(p["sentences"], sentence), ana=_tags(p["tags"])))))


def divisions(items: Column) -> Column:
    """<body> of array<struct<type, paragraphs>>."""
    sentence = lambda s: element("s", escape(s["sentence"]), ana=_tags(s["tags"]))
    paragraph = lambda p: element("p", each(p["sentences"], sentence), ana=_tags(p["tags"]))
    return element("body", each(items, lambda d: element("div", each(d["paragraphs"], paragraph), type=d["type"])))


def tei(header_xml: Column, body_xml: Column) -> Column:
    return F.concat(F.lit(f'<TEI xmlns="{NAMESPACE}">'), header_xml, F.lit("<text>"), body_xml, F.lit("</text></TEI>"))


def write(documents: DataFrame, path: str, column: str = "xml") -> None:
    """One document a line of text files: a document holds no line break outside its text, where they are references."""
    documents.select(F.regexp_replace(F.regexp_replace(column, "\n", "&#10;"), "\r", "&#13;").alias("value")).write.mode("overwrite").text(path)


def read(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Documents as Spark's XML reader sees them, a row each.

    lines: files hold a document a line, as ``write`` makes them, and are cut into
    splits between lines; without, each file is one document on any number of lines.
    """
    return spark.read.format("xml").option("rowTag", "TEI").option("multiLine", not lines).load(path)
