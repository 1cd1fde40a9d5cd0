"""Catalogue rows to typed work and person records.

The mapping is data (``COLUMNS``): which column feeds which field, and how. It
becomes one ``select``, so a load is a single projection over the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S

# The catalogue's column names, by what they describe.
ROW_IDS = {"work": "作品ID", "person": "人物ID", "relation": "役割フラグ"}
RESOURCES = [("テキストファイル", "text/plain"), ("XHTML/HTMLファイル", "text/html")]
RESOURCE_PARTS = {"url": "URL", "revision_count": "修正回数", "character_set": "文字集合", "last_modified_date": "最終更新日", "encoding": "符号化方式"}
BOOKS = [{"title": f"底本名{n}", "first_published": f"底本初版発行年{n}", "publisher": f"底本出版社名{n}", "parent_title": f"底本の親本名{n}", "parent_span": f"底本の親本初版発行年{n}", "parent_publisher": f"底本の親本出版社名{n}"} for n in (1, 2)]
WORK_FIELDS = {
    "title": "作品名", "transcription": "作品名読み", "subtitle": "副題", "subtitle_transcription": "副題読み", "original_title": "原題",
    "copyright_expired": "作品著作権フラグ", "transcriber": "入力者", "publishing_date": "公開日", "class_codes": "分類番号", "first_published": "初出",
    "bib_resource": "図書カードURL", "orthographic_style": "文字遣い種別", "last_modified_date": "最終更新日", "revisor": "校正者",
}
WORK_PAIRS = {"revision_source": ["校正に使用した版1", "校正に使用した版2"], "transcription_source": ["入力に使用した版1", "入力に使用した版2"]}
PERSON_FIELDS = {
    "person_copyright_expired": "人物著作権フラグ", "given_name": "名", "given_name_romaji": "名ローマ字", "given_name_transcription": "名読み",
    "family_name": "姓", "family_name_romaji": "姓ローマ字", "family_name_transcription": "姓読み", "date_of_death": "没年月日", "date_of_birth": "生年月日",
}

COLUMNS: list[str] = [
    *ROW_IDS.values(),
    *[name + part for name, _ in RESOURCES for part in RESOURCE_PARTS.values()],
    *[c for book in BOOKS for c in book.values()],
    *WORK_FIELDS.values(),
    *[c for pair in WORK_PAIRS.values() for c in pair],
    *PERSON_FIELDS.values(),
]
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
RELATIONS = list(S.RELATIONS.values())


def clean(rows: DataFrame) -> DataFrame:
    """All known columns, absent ones null, blank cells null; ``row_ix`` is kept or made, ``file`` is kept."""
    have = set(rows.columns)
    ix = F.col("row_ix") if "row_ix" in have else F.monotonically_increasing_id()
    return rows.select(*["file"] * ("file" in have), ix.alias("row_ix"), *[(S.blank_to_null(F.col(f"`{c}`")) if c in have else F.lit(None).cast("string")).alias(c) for c in COLUMNS])


def _resource(name: str, form: str, strict: bool) -> Column:
    cell = {k: F.col(f"`{name + v}`") for k, v in RESOURCE_PARTS.items()}
    url = S.to_url(cell["url"], strict)
    return F.when(
        url.isNotNull(),
        F.struct(
            url.alias("about"), url.alias("url"), F.lit(form).alias("format"), S.to_integer(cell["revision_count"], strict).alias("revision_count"),
            cell["character_set"].alias("character_set"), S.iso_partial_date(cell["last_modified_date"], strict).alias("last_modified_date"), S.to_encoding(cell["encoding"], strict).alias("encoding"),
        ),
    )


def _book(names: dict[str, str], prefix: str) -> Column:
    cell = {k: F.col(f"`{v}`") for k, v in names.items()}
    parent = F.struct(cell["parent_title"].alias("title"), S.catalogue_date(cell["parent_span"]).alias("publishing_span"), S.to_multiple(cell["parent_publisher"]).alias("publisher"))
    about = F.concat(F.lit(prefix + "book/"), F.sha2(cell["title"], 256))
    return F.when(
        cell["title"].isNotNull(),
        F.struct(
            about.alias("about"), cell["title"].alias("title"), S.catalogue_date(cell["first_published"]).alias("first_published"),
            S.to_multiple(cell["publisher"]).alias("publisher"), S.compact(parent, ["title", "publishing_span", "publisher"]).alias("parent"),
        ),
    )


def _converters(strict: bool, labels: dict[str, str] | None) -> dict[str, Callable[[Column], Column]]:
    date = lambda c: S.iso_partial_date(c, strict)
    flag = lambda c: S.flag_to_boolean(c, strict)
    return {
        "copyright_expired": flag, "person_copyright_expired": flag, "publishing_date": date, "last_modified_date": date,
        "class_codes": lambda c: S.class_codes(c, labels), "first_published": S.catalogue_date, "date_of_death": S.catalogue_date, "date_of_birth": S.catalogue_date,
        "bib_resource": lambda c: S.to_url(c, strict),
    }


def entities(rows: DataFrame, prefix: str = "urn:folioflow:", labels: dict[str, str] | None = None, parity: bool = False, strict: bool = False) -> DataFrame:
    """row_ix, work and person: two structs a catalogue row.

    row_ix: what orders the rows; with a column ``file`` both make it, as rows
    are numbered within their file.

    parity: give both resources the text format and take the subtitle from the
    title's reading, as some consumers of older output expect.
    strict: raise at the first bad required value, instead of nulls.
    """
    given = clean(rows)
    convert = _converters(strict, labels)
    put = lambda name, cell: convert.get(name, lambda c: c)(F.col(f"`{cell}`")).alias(name)
    work_id = F.concat(F.lit("w"), F.coalesce(F.col(ROW_IDS["work"]), F.lit("")))
    person_id = F.concat(F.lit("p"), F.coalesce(F.col(ROW_IDS["person"]), F.lit("")))
    relation = S.to_relation(F.col(ROW_IDS["relation"]), strict)
    fields = WORK_FIELDS | ({"subtitle": WORK_FIELDS["transcription"]} if parity else {})
    linked = lambda r, other: F.when(relation == r, F.array(other))
    work = F.struct(
        F.concat(F.lit(prefix), work_id).alias("id"),
        work_id.alias("work_id"),
        *[linked(r, person_id).alias(r) for r in RELATIONS],
        F.array_compact(F.array(*[_resource(name, "text/plain" if parity else form, strict) for name, form in RESOURCES])).alias("sources"),
        F.array_compact(F.array(*[_book(b, prefix) for b in BOOKS])).alias("references"),
        *[put(name, cell) for name, cell in fields.items()],
        *[F.array_compact(F.array(*[F.col(f"`{c}`") for c in pair])).alias(name) for name, pair in WORK_PAIRS.items()],
    )
    person = F.struct(
        F.concat(F.lit(prefix), person_id).alias("id"),
        person_id.alias("person_id"),
        *[linked(r, work_id).alias(f"{r}_of") for r in RELATIONS],
        *[put(name, cell) for name, cell in PERSON_FIELDS.items()],
    )
    order = F.struct("file", "row_ix").alias("row_ix") if "file" in rows.columns else F.col("row_ix")
    return given.select(order, work.alias("work"), person.alias("person"))


def with_code_labels(works: DataFrame, labels: DataFrame, key: str = "work_id", codes: str = "class_codes") -> DataFrame:
    """``works`` with the labels of their class codes in the codes' place; a code without one stands for itself.

    labels: (code, label), a row a code. The codes meet them as rows, so the table may be of any size.
    """
    each = works.select(key, F.posexplode(codes).alias("place", "x")).select(key, "place", F.col("x.category").alias("code"), "x.childrens")
    named = each.join(labels.select("code", "label"), "code", "left").select(key, "place", F.struct(F.coalesce("label", "code").alias("category"), "childrens").alias("x"))
    lists = named.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda v: v["x"]).alias("_labelled"))
    joined = works.join(lists, key, "left")
    return joined.select(*[F.coalesce("_labelled", codes).alias(c) if c == codes else F.col(f"`{c}`") for c in works.columns])


def link_table(pairs: DataFrame) -> DataFrame:
    """work_id, person_id, relation: the links of ``entities`` rows."""
    links = [F.when(F.col(f"work.{r}").isNotNull(), F.lit(r)) for r in RELATIONS]
    return pairs.select(F.col("work.work_id").alias("work_id"), F.col("person.person_id").alias("person_id"), F.coalesce(*links).alias("relation")).distinct()


def both_directions(links: DataFrame, subject: str, target: str, relation: str) -> DataFrame:
    """Each link twice: as it is, and turned round under the inverse relation."""
    there = links.select(F.col(subject).alias("subject"), F.col(relation).alias("relation"), F.col(target).alias("object"))
    back = links.select(F.col(target).alias("subject"), S.inverse_relation(F.col(relation)).alias("relation"), F.col(subject).alias("object"))
    return there.unionByName(back)
