"""Registered queries of forms: records in full, TEI read back, quotations, text tests, nils, contracts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import text as X
from ..operators import catalog, sentences, tei, triples, validate
from ..session import shared_folder, table
from ..sources import revisions, texts
from . import pipelines
from .queries import _ESCAPE_SQL, _SENTENCES_SQL, WESTERN, query

_URL_SQL = "CASE page_id % 4 WHEN 1 THEN 'no url' WHEN 2 THEN NULL WHEN 3 THEN url || '/a.b.TXT' ELSE url END"


@query(rf"""
WITH u AS (SELECT page_id, {_URL_SQL} AS u FROM pages)
SELECT page_id, CASE WHEN u LIKE 'http%' THEN u END AS url, coalesce(u LIKE 'http%', FALSE) AS good, lower(regexp_extract(regexp_extract(u, '([^/]*)/*$', 1), '[^.](\.[^.]*)$', 1)) AS ext FROM u
""")
def url_forms(spark: SparkSession, d: str) -> DataFrame:
    """URLs, other text and nulls: which are URLs, and the extension of what they name."""
    k = F.col("page_id") % 4
    u = F.when(k == 1, "no url").when(k == 2, F.lit(None)).when(k == 3, F.concat("url", F.lit("/a.b.TXT"))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", S.to_url(u).alias("url"), S.is_url(u).alias("good"), S.extension(u).alias("ext"))


@query("""
SELECT p_partkey, p_size % 12 = 0 AS gone, CASE WHEN p_size % 3 <> 0 THEN p_name END AS title, p_size % 2 = 0 AS no_parent, CASE WHEN p_size % 2 <> 0 THEN p_brand END AS parent_title,
  CASE WHEN p_size % 12 = 0 THEN NULL ELSE 1 END AS names, CASE WHEN p_size % 12 = 0 THEN NULL ELSE 'urn:p' || CAST(p_partkey AS VARCHAR) END AS about
FROM part
""")
def nil_removal(spark: SparkSession, d: str) -> DataFrame:
    """Records without what is null in them, from the inside out, and with their subject's name."""
    size = F.col("p_size")
    parent = F.struct(F.when(size % 2 != 0, F.col("p_brand")).alias("title"), F.lit(None).cast("date").alias("span"))
    names = F.when(size % 12 != 0, F.array(F.col("p_type"), F.lit(None)))
    rows = table(spark, d, "part").select("p_partkey", F.struct(F.when(size % 3 != 0, F.col("p_name")).alias("title"), parent.alias("parent"), names.alias("names")).alias("value"))
    clean = rows.select("p_partkey", S.without_nulls(F.col("value"), rows.schema["value"].dataType).alias("v"))
    named = S.with_about(F.col("v").withField("about", F.lit(None).cast("string")), F.concat(F.lit("urn:p"), F.col("p_partkey")))
    return clean.select(
        "p_partkey", F.col("v").isNull().alias("gone"), F.col("v.title").alias("title"), F.col("v.parent").isNull().alias("no_parent"), F.col("v.parent.title").alias("parent_title"),
        F.when(F.col("v.names").isNotNull(), F.size("v.names")).alias("names"), named["about"].alias("about"),
    )


def _wide_sql(value: str) -> str:
    """Printable ASCII and the blank of a value in full width."""
    plain = "".join(map(chr, range(0x21, 0x7F)))
    wide = "".join(chr(i + 0xFEE0) for i in range(0x21, 0x7F))
    return f"translate({value}, '{plain.replace(chr(39), chr(39) * 2)} ', '{wide}　')"


@query(f"""
WITH t AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '彼は「' || p_name || '」と' WHEN 1 THEN 'カタカナー' ELSE p_name END AS t, CASE p_size % 2 WHEN 0 THEN '未知' WHEN 1 THEN '和' END AS origin FROM part)
SELECT p_partkey, origin = '未知' AS unknown, contains(t, '「') AS quoted, t = 'カタカナー' AS katakana, {_wide_sql("t")} AS wide FROM t
""")
def text_tests(spark: SparkSession, d: str) -> DataFrame:
    """Words no dictionary has, quotations, katakana sentences, and full width."""
    size = F.col("p_size")
    t = F.when(size % 3 == 0, F.concat(F.lit("彼は「"), "p_name", F.lit("」と"))).when(size % 3 == 1, "カタカナー").otherwise(F.col("p_name"))
    origin = F.when(size % 2 == 0, "未知").otherwise("和")
    return table(spark, d, "part").select("p_partkey", X.is_unknown(origin).alias("unknown"), X.has_quotation(t).alias("quoted"), X.is_katakana(t).alias("katakana"), X.to_full_width(t).alias("wide"))


@query(f"""
SELECT p_partkey, 0 AS para, 0 AS sent, {_wide_sql("p_name")} || '。' AS sentence FROM part
UNION ALL SELECT p_partkey, 0, 1, {_wide_sql("p_type")} FROM part
UNION ALL SELECT p_partkey, 1, 0, 'ガ１' || {_wide_sql("p_brand")} FROM part
""")
def paragraph_forms(spark: SparkSession, d: str) -> DataFrame:
    """Texts with half-width kana, circled digits and blank lines, normalised and cut to sentences."""
    text = F.concat("p_name", F.lit("。"), "p_type", F.lit("\r\n \nｶﾞ①"), "p_brand")
    rows = table(spark, d, "part").select("p_partkey", text.alias("text"))
    return sentences.parse_paragraphs(rows, "p_partkey", "text")


@query(f"""
WITH r AS (SELECT *, CASE p_size % 3 WHEN 0 THEN 'spoken' WHEN 1 THEN 'thought' END AS kind, {_ESCAPE_SQL.format("p_name || ' <&>'")} AS shown FROM part),
a AS (SELECT *, coalesce(' type="' || kind || '"', '') || CASE WHEN p_size % 2 = 0 THEN ' direct="true"' ELSE '' END || CASE WHEN p_size % 5 = 0 THEN ' aloud="true"' ELSE '' END AS attributes FROM r)
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '<quote' || attributes || '>' || shown || '</quote>' ELSE '<q' || attributes || '>' || shown || '</q>' END AS quotation,
  '<body><div type="chapter"><p' || CASE WHEN p_size % 2 = 0 THEN ' ana="a b"' ELSE '' END || '><s>' || shown || '</s><s ana="quoted">' || p_brand || '</s></p></div></body>' AS body,
  CASE WHEN kind IS NULL OR p_size % 11 <> 0 THEN '' ELSE 'type: one of a set' END AS violations
FROM a
""")
def tei_quotations(spark: SparkSession, d: str) -> DataFrame:
    """Quotations of every kind, divisions with tags, and which quotation records break the rules."""
    size = F.col("p_size")
    kind = F.when(size % 3 == 0, "spoken").when(size % 3 == 1, "thought")
    shown = F.concat("p_name", F.lit(" <&>"))
    none = F.array().cast("array<string>")
    lines = F.array(F.struct(none.alias("tags"), shown.alias("sentence")), F.struct(F.array(F.lit("quoted")).alias("tags"), F.col("p_brand").alias("sentence")))
    paragraph = F.struct(F.when(size % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(none).alias("tags"), lines.alias("sentences"))
    division = F.struct(F.lit("chapter").alias("type"), F.array(paragraph).alias("paragraphs"))
    rows = table(spark, d, "part").select("p_partkey", tei.quotation(shown, kind, size % 2 == 0, size % 5 == 0, size % 7 == 0).alias("quotation"), tei.divisions(F.array(division)).alias("body"), F.when(kind.isNotNull() & (size % 11 == 0), F.concat(kind, F.lit("?"))).otherwise(kind).alias("type"))
    return validate.validate(rows, validate.quotation_rules()).select("p_partkey", "quotation", "body", F.array_join("violations", ",").alias("violations"))


@query(f"""
WITH {_SENTENCES_SQL},
p AS (SELECT doc_id, count(*) AS n_paragraphs, CAST(sum(len(parts)) AS BIGINT) AS n_sentences FROM cut GROUP BY doc_id)
SELECT 'Document ' || CAST(d.doc_id AS VARCHAR) AS title, coalesce(n_paragraphs, 0) AS n_paragraphs, coalesce(n_sentences, 0) AS n_sentences FROM documents d LEFT JOIN p USING (doc_id)
""")
def tei_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as TEI and read back by the XML reader."""
    path = f"{shared_folder(spark)}/folioflow-tei/{uuid.uuid4().hex}"
    tei.write(pipelines.tei_documents(table(spark, d, "documents"), "doc_id", "text", F.concat(F.lit("Document "), F.col("doc_id")), **WESTERN), path)
    paragraphs = F.col("text.body.div.p")
    n = F.coalesce(F.aggregate(paragraphs, F.lit(0), lambda a, p: a + F.coalesce(F.size(F.array_compact(p["s"])), F.lit(0))), F.lit(0))
    return tei.read(spark, path).select(F.col("teiHeader.fileDesc.titleStmt.title").alias("title"), F.coalesce(F.size(paragraphs), F.lit(0)).cast("long").alias("n_paragraphs"), n.cast("long").alias("n_sentences"))


#: Text fields of works and persons, as they stand in a record: their name and the order's key.
_WORK_TEXTS = ["title", "transcription", "subtitle", "subtitle_transcription", "original_title", "transcriber", "orthographic_style", "revisor"]
_PERSON_TEXTS = ["given_name", "given_name_romaji", "given_name_transcription", "family_name", "family_name_romaji", "family_name_transcription"]
_K = "CAST(o_orderkey AS VARCHAR)"
_DAY_SQL = "strftime(o_orderdate, '%Y-%m-%d')"
_MONTH_SQL = "CAST(1900 + o_orderkey % 90 AS VARCHAR) || '-' || lpad(CAST(1 + o_orderkey % 12 AS VARCHAR), 2, '0') || '-01'"


@query(f"""
SELECT 'w' || {_K} AS work_id, 'p' || CAST(o_custkey AS VARCHAR) AS person_id, 'urn:folioflow:w' || {_K} AS id, 'urn:folioflow:p' || CAST(o_custkey AS VARCHAR) AS person,
  {", ".join(f"'{n}' || {_K} AS {n}" for n in _WORK_TEXTS + _PERSON_TEXTS)},
  o_orderkey % 2 = 1 AS copyright_expired, o_orderkey % 3 = 1 AS person_copyright_expired, {_DAY_SQL} AS publishing_date, {_DAY_SQL} AS last_modified_date, {_MONTH_SQL} AS first_published, {_MONTH_SQL} AS date_of_death,
  CAST(1926 + o_orderkey % 60 AS VARCHAR) || '-' || lpad(CAST(1 + o_orderkey % 12 AS VARCHAR), 2, '0') || '-01' AS date_of_birth,
  'https://card.example/' || {_K} AS bib_resource, 'K' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS codes,
  CASE WHEN o_orderkey % 2 = 0 THEN 'r1,r2' ELSE 'r1' END AS revision_source, CASE WHEN o_orderkey % 2 = 0 THEN 't2' ELSE 't1,t2' END AS transcription_source,
  'https://a.example/' || {_K} || '.zip text/plain 2 Unicode UTF-8 ' || {_DAY_SQL} || ';https://b.example/' || {_K} || '.html text/html 3 JIS X 0208 SJIS ' || {_DAY_SQL} AS resources,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'book1 ' || {_MONTH_SQL} || ' x+y parent1 ' || {_MONTH_SQL} || ' z;' END || 'book2 ' || {_MONTH_SQL} || ' x' AS books,
  CASE o_orderkey % 5 WHEN 0 THEN 'author' WHEN 1 THEN 'translator' WHEN 2 THEN 'editor' WHEN 3 THEN 'proofreader' ELSE 'other_author' END AS relation
FROM orders
""")
def record_mapping(spark: SparkSession, d: str) -> DataFrame:
    """Every column of the catalogue, mapped to works and persons."""
    o = F.col("o_orderkey")
    k, day = o.cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd")
    written = F.concat((o % 90 + 1900).cast("string"), F.lit("（大正）年"), (o % 12 + 1).cast("string"), F.lit("月"))
    era = F.concat(F.lit("昭和"), (o % 60 + 1).cast("string"), F.lit("年"), (o % 12 + 1).cast("string"), F.lit("月生"))
    given = {catalog.ROW_IDS["work"]: k, catalog.ROW_IDS["person"]: F.col("o_custkey").cast("string"), catalog.ROW_IDS["relation"]: F.element_at(F.array(*map(F.lit, S.RELATIONS)), (o % 5 + 1).cast("int"))}
    fields = catalog.WORK_FIELDS | catalog.PERSON_FIELDS
    given |= {fields[n]: F.concat(F.lit(n), k) for n in _WORK_TEXTS + _PERSON_TEXTS}
    given |= {fields["copyright_expired"]: F.when(o % 2 == 1, "あり").otherwise("なし"), fields["person_copyright_expired"]: F.when(o % 3 == 1, "あり").otherwise("なし"), fields["publishing_date"]: day, fields["last_modified_date"]: day}
    given |= {fields["first_published"]: written, fields["date_of_death"]: written, fields["date_of_birth"]: era, fields["bib_resource"]: F.concat(F.lit("https://card.example/"), k), fields["class_codes"]: F.concat(F.lit("NDC K"), F.lpad((o % 1000).cast("string"), 3, "0"))}
    (r1, r2), (t1, t2) = catalog.WORK_PAIRS["revision_source"], catalog.WORK_PAIRS["transcription_source"]
    given |= {r1: F.lit("r1"), r2: F.when(o % 2 == 0, "r2"), t1: F.when(o % 2 == 1, "t1"), t2: F.lit("t2")}
    for (name, _), host, end, count, characters, encoding in zip(catalog.RESOURCES, "ab", ("zip", "html"), ("2", "３"), ("Unicode", "JIS X 0208"), ("UTF-8", "ShiftJIS")):
        parts = {"url": F.concat(F.lit(f"https://{host}.example/"), k, F.lit(f".{end}")), "revision_count": F.lit(count), "character_set": F.lit(characters), "last_modified_date": day, "encoding": F.lit(encoding)}
        given |= {name + catalog.RESOURCE_PARTS[p]: c for p, c in parts.items()}
    one, two = catalog.BOOKS
    given |= {one["title"]: F.when(o % 5 != 0, "book1"), one["first_published"]: written, one["publisher"]: F.lit("x、y"), one["parent_title"]: F.lit("parent1"), one["parent_span"]: written, one["parent_publisher"]: F.lit("z")}
    given |= {two["title"]: F.lit("book2"), two["first_published"]: written, two["publisher"]: F.lit("x、"), two["parent_title"]: F.lit(" "), two["parent_span"]: F.lit(None).cast("string"), two["parent_publisher"]: F.lit(None).cast("string")}
    rows = table(spark, d, "orders").select(o.alias("row_ix"), *[c.alias(n) for n, c in given.items()])
    found = catalog.entities(rows).select("work.*", *[F.col(f"person.{n}").alias(n) for n in ("person_id", *catalog.PERSON_FIELDS)], F.col("person.id").alias("person"), *[F.col(f"person.{r}_of").alias(f"{r}_of") for r in catalog.RELATIONS])
    plus = lambda x: F.array_join(x, "+")
    resource = lambda s: F.concat_ws(" ", *[s[n].cast("string") for n in ("url", "format", "revision_count", "character_set", "encoding", "last_modified_date")])
    book = lambda b: F.concat_ws(" ", b["title"], b["first_published"].cast("string"), plus(b["publisher"]), b["parent"]["title"], b["parent"]["publishing_span"].cast("string"), plus(b["parent"]["publisher"]))
    code = lambda c: F.concat(F.when(c["childrens"], "K").otherwise(""), c["category"])
    # The relation by the work's links and, where the person's link does not say the same, not at all.
    relation = F.coalesce(*[F.when((F.get(F.col(r), 0) == F.col("person_id")) & (F.get(F.col(f"{r}_of"), 0) == F.col("work_id")), F.lit(r)) for r in catalog.RELATIONS])
    dates = ("publishing_date", "last_modified_date", "first_published", "date_of_death", "date_of_birth")
    return found.select(
        "work_id", "person_id", "id", "person", *_WORK_TEXTS, *_PERSON_TEXTS, "copyright_expired", "person_copyright_expired", *[F.col(x).cast("string").alias(x) for x in dates], "bib_resource",
        F.array_join(F.transform("class_codes", code), ",").alias("codes"), F.array_join("revision_source", ",").alias("revision_source"), F.array_join("transcription_source", ",").alias("transcription_source"),
        F.array_join(F.transform("sources", resource), ";").alias("resources"), F.array_join(F.transform("references", book), ";").alias("books"), relation.alias("relation"),
    )


@query("""
SELECT 'w' || CAST(o_custkey AS VARCHAR) AS work_id, 'https://h.example/' || CAST(o_orderkey AS VARCHAR) AS url, 'UTF-8' AS encoding FROM orders WHERE o_orderkey % 3 = 0
""")
def plain_sources(spark: SparkSession, d: str) -> DataFrame:
    """The resources of one format among those of all works."""
    one = F.struct(F.concat(F.lit("https://h.example/"), F.col("o_orderkey")).alias("url"), F.when(F.col("o_orderkey") % 3 == 0, "text/plain").when(F.col("o_orderkey") % 3 == 1, "text/html").alias("format"), F.lit("UTF-8").alias("encoding"))
    works = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(one).alias("sources")).select(F.concat(F.lit("w"), F.col("o_custkey")).alias("work_id"), "sources")
    return texts.sources(works)


@query("""
SELECT o_orderpriority AS path, o_orderkey AS line_no, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey LIMIT 20
""")
def latest_lines(spark: SparkSession, d: str) -> DataFrame:
    """The twenty latest of a file's lines, latest first."""
    lines = table(spark, d, "orders").select(F.col("o_orderpriority").alias("path"), F.col("o_orderkey").alias("line_no"), F.col("o_orderdate").alias("author_ts"))
    return revisions.file_log(lines).limit(20).select("path", "line_no", F.date_format("author_ts", "yyyy-MM-dd").alias("day"))


_NODE_SQL = "CASE WHEN p_size % 2 = 0 THEN 'urn:brand:' || p_brand ELSE '_:b' || substr(sha256('{\"title\":\"' || p_brand || '\",\"size\":' || CAST(p_size AS VARCHAR) || '}'), 1, 32) END"


@query(f"""
WITH n AS (SELECT 'urn:p' || CAST(p_partkey AS VARCHAR) AS id, {_NODE_SQL} AS node, p_brand, CAST(p_size AS VARCHAR) AS size FROM part)
SELECT DISTINCT * FROM (
  SELECT id AS s, '{triples.PREFIXES[""]}book' AS p, node AS o, CASE WHEN starts_with(node, '_:') THEN 'blank' ELSE 'iri' END AS o_kind FROM n
  UNION ALL SELECT node, '{triples.PREFIXES[""]}title', p_brand, 'literal' FROM n UNION ALL SELECT node, '{triples.PREFIXES[""]}size', size, 'literal' FROM n)
""")
def nested_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nested records as nodes: named by what they are about, else by their content, so that equal ones are one node."""
    book = F.struct(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("urn:brand:"), "p_brand")).alias("about"), F.col("p_brand").alias("title"), F.col("p_size").alias("size"))
    rows = table(spark, d, "part").select(F.concat(F.lit("urn:p"), F.col("p_partkey")).alias("id"), book.alias("book"))
    return triples.as_graph(triples.lift(rows, "id")).select("s", "p", "o", "o_kind")


@query("SELECT doc_id, lang, n_chars FROM documents")
def schema_contract(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose schema is what a contract says; another contract is refused before any row is read."""
    rows = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    try:
        validate.assert_schema(rows, {"doc_id": "string", "other": "int"})
    except ValueError:
        return validate.assert_schema(rows, {"doc_id": "bigint", "lang": "string"})
    raise AssertionError("a wrong schema was let through")


__all__ = ["latest_lines", "nested_nodes", "nil_removal", "paragraph_forms", "plain_sources", "record_mapping", "schema_contract", "tei_quotations", "tei_round_trip", "text_tests", "url_forms"]
