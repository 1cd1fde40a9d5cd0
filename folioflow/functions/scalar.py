"""Normalisers for catalogue cells: blanks, numbers, dates, codes, enumerations.

Each takes and returns a Column. Where a bad value is an error, ``strict=True``
raises at run time and the default gives null, so that a load reports bad rows
(see ``operators.validate``) instead of ending.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that trimming removes: Unicode separators without the no-break ones, and controls.
TRIM_CLASS = r" \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}\x{2028}\x{2029}\x{205F}\x{3000}\x09-\x0D\x1C-\x1F"
FULL_WIDTH_DIGITS, ASCII_DIGITS = "０１２３４５６７８９", "0123456789"

# Fixed values of the catalogue's vocabulary.
ERA_YEARS = {"明治": 1868, "大正": 1912, "昭和": 1926, "平成": 1989}
FLAGS = {"なし": False, "あり": True}
ENCODINGS = {"ShiftJIS": "SJIS", "EUC": "EUC", "UTF-8": "UTF-8"}
RELATIONS = {"著者": "author", "翻訳者": "translator", "編者": "editor", "校訂者": "proofreader", "その他": "other_author"}
LIST_MARK = "、"
#: Values of date columns that name no date a pattern could find.
UNKNOWN_DATE = "不詳"
NAMED_DATES = {"「太陽　創刊号」": (1963, 7), "紀元前6世紀初": (-600, 1)}


def blank_to_null(c: Column) -> Column:
    """Null for a value of white space alone; others stay as they are, not trimmed."""
    return F.when(c.rlike(f"[^{TRIM_CLASS}]"), c)


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _part(c: Column, pattern: str, group: int) -> Column:
    """A group of the first match as an integer; null where it is absent."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).cast("int")


def _parts(c: Column, pattern: str, **groups: int) -> Column:
    """A struct of groups as integers."""
    return F.struct(*[_part(c, pattern, g).alias(name) for name, g in groups.items()])


def _failed(message: str, c: Column, kind: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{message}: "), F.coalesce(c.cast("string"), F.lit("null")))).cast(kind)


def to_integer(c: Column, strict: bool = False) -> Column:
    """A 32-bit integer: a sign and digits, full-width ones too, nothing else."""
    plain = F.translate(c, FULL_WIDTH_DIGITS, ASCII_DIGITS)
    found = F.when(plain.rlike(r"^[+-]?\d+$"), plain.try_cast("int"))
    return F.when(found.isNull(), _failed("not an integer", c, "int")).otherwise(found) if strict else found


def is_url(c: Column) -> Column:
    """Whether the value is a URL with a host; null is none."""
    return F.coalesce(F.try_parse_url(c, F.lit("HOST")).isNotNull(), F.lit(False))


def to_url(c: Column, strict: bool = False) -> Column:
    """The value if it is a URL with a host; null stays null."""
    found = F.when(is_url(c), c)
    return F.when(c.isNotNull() & found.isNull(), _failed("not a URL", c, "string")).otherwise(found) if strict else found


def _date(year: Column, month: Column, day: Column, strict: bool) -> Column:
    """A missing month is January, a missing day the first; a day without a month counts as missing."""
    m = F.coalesce(month, F.lit(1))
    d = F.when(month.isNull(), F.lit(1)).otherwise(F.coalesce(day, F.lit(1)))
    if strict:
        return F.make_date(year, m, d)
    last = F.day(F.last_day(F.make_date(year, F.when(m.between(1, 12), m), F.lit(1))))
    return F.when(d.between(1, last), F.make_date(year, F.when(m.between(1, 12), m), d))


#: A year, a month, a day, with or without hyphens (fixed value).
ISO_DATE = r"(\d{3,4})-?(\d{1,2})?-?(\d{1,2})?"


def iso_partial_date(c: Column, strict: bool = False) -> Column:
    """The first yyyy[-mm[-dd]] in the value as a date."""

    def found(v: Column) -> Column:
        date = bound(_parts(v, ISO_DATE, y=1, m=2, d=3), lambda x: _date(x["y"], x["m"], x["d"], strict))
        return F.when(_part(v, ISO_DATE, 1).isNull(), _failed("not a date", v, "date")).otherwise(date) if strict else date

    return bound(c, found)


#: An era, its year, a month (fixed value).
ERA_DATE = r"(明治|大正|昭和|平成)(\d{1,2})年(\d{1,2})?月?"


def era_date(c: Column) -> Column:
    """Year n of an era, with the month if one is given; the day is the first."""
    era = lambda x: F.coalesce(*[F.when(x["era"] == name, F.lit(year)) for name, year in ERA_YEARS.items()])
    found = lambda v: F.struct(F.regexp_extract(v, ERA_DATE, 1).alias("era"), _part(v, ERA_DATE, 2).alias("n"), _part(v, ERA_DATE, 3).alias("m"))
    return bound(bound(c, found), lambda x: _date(era(x) + x["n"] - 1, x["m"], F.lit(None).cast("int"), False))


#: A western year, the era year in brackets, a month or the first of a span, a day (fixed value).
FREE_DATE = r"(\d{3,4})年?([\(（][^)）]+[）\)])?年?\s?((\d{1,2})|(\d{1,2})[～、]\d{1,2})?月?((\d{1,2})日)?"


def free_date(c: Column) -> Column:
    """A date written out: 1948（昭和23）年5月15日. A day needs its mark."""
    return bound(bound(c, lambda v: _parts(v, FREE_DATE, y=1, m=4, d=7)), lambda x: _date(x["y"], x["m"], x["d"], False))


def catalogue_date(c: Column, iso_first: bool = True) -> Column:
    """A date of any of the catalogue's forms; null where it is unknown.

    iso_first: read yyyy-mm-dd in full. Without, such a value gives its year
    alone, as where only the free form is known.
    """

    def date(v: Column) -> Column:
        named = F.coalesce(*[F.when(v == text, F.make_date(F.lit(y), F.lit(m), F.lit(1))) for text, (y, m) in NAMED_DATES.items()])
        unknown = (v == UNKNOWN_DATE) | ~v.rlike(r"[^ \t\n\x0B\f\r]")
        steps = F.when(unknown, F.lit(None).cast("date")).when(v.isin(*NAMED_DATES), named)
        if iso_first:
            steps = steps.when(v.rlike(r"^\s*\d{4}-\d{1,2}(-\d{1,2})?\s*$"), iso_partial_date(v))
        return steps.when(~v.rlike(r"\d{4}"), era_date(v)).otherwise(free_date(v))

    return bound(c, date)


def _choice(c: Column, values: dict, kind: str, what: str, strict: bool) -> Column:
    found = F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in values.items()])
    return F.when(found.isNull(), _failed(f"not {what}", c, kind)).otherwise(found) if strict else found


def flag_to_boolean(c: Column, strict: bool = False) -> Column:
    return _choice(c, FLAGS, "boolean", "a flag", strict)


def to_encoding(c: Column, strict: bool = False) -> Column:
    return _choice(c, ENCODINGS, "string", "an encoding", strict)


def to_relation(c: Column, strict: bool = False) -> Column:
    """The English name of a person's part in a work."""
    return _choice(c, RELATIONS, "string", "a relation", strict)


def inverse_relation(c: Column) -> Column:
    return F.concat(c, F.lit("_of"))


#: One or two codes, each with or without the children's mark (fixed value).
CLASS_CODES = r"NDC (K)?(\d{3})\s?(K)?(\d{3})?"


def class_codes(c: Column, labels: dict[str, str] | None = None) -> Column:
    """array<struct<category, childrens>> of one or two codes, without repeats; null if there is none.

    labels: names of codes, a data input; a code without one stands for itself.
    """
    named = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]) if labels else None

    def one(mark: int, digits: int) -> Column:
        code = F.nullif(F.regexp_extract(c, CLASS_CODES, digits), F.lit(""))
        category = F.coalesce(F.try_element_at(named, code), code) if named is not None else code
        return F.when(code.isNotNull(), F.struct(category.alias("category"), F.when(F.regexp_extract(c, CLASS_CODES, mark) == "K", F.lit(True)).otherwise(F.lit(False)).alias("childrens")))

    return F.when(c.rlike(CLASS_CODES), F.array_distinct(F.array_compact(F.array(one(1, 2), one(3, 4)))))


def drop_trailing_empties(parts: Column) -> Column:
    """An array without the empty strings at its end (one of nothing else becomes empty)."""
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(F.lit(0))))
    return F.slice(parts, F.lit(1), F.greatest(F.coalesce(last, F.lit(0)), F.lit(0)))


def to_multiple(c: Column, field: str | None = None) -> Column:
    """The parts of a list cell; with ``field``, each in a struct of that one field."""
    parts = F.when(c == "", F.array(F.lit(""))).otherwise(drop_trailing_empties(F.split(c, LIST_MARK)))
    return F.transform(parts, lambda x: F.struct(x.alias(field))) if field else parts


def compact(value: Column, fields: list[str]) -> Column:
    """A struct, or null if every field of it is null."""
    some = F.lit(False)
    for f in fields:
        some = some | value[f].isNotNull()
    return F.when(some, value)


def without_nulls(value: Column, kind: T.DataType) -> Column:
    """A value without what is null in it, from the inside out.

    A struct all of whose fields end as null is null; an array left with no
    element stays, empty. kind: the value's type.
    """
    if isinstance(kind, T.StructType):
        fields = [without_nulls(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return bound(F.struct(*fields), lambda x: compact(x, kind.names))
    if isinstance(kind, T.ArrayType):
        return F.array_compact(F.transform(value, lambda x: without_nulls(x, kind.elementType)))
    return value


def with_about(value: Column, about: Column) -> Column:
    """A struct with the name of the node that it describes."""
    return value.withField("about", about)


def camel_case(name: str) -> str:
    """first_published -> firstPublished."""
    head, *rest = [x for x in name.replace("-", "_").split("_") if x] or [""]
    return head + "".join(x[:1].upper() + x[1:] for x in rest)


def pascal_case(name: str) -> str:
    """work_id -> WorkId."""
    name = camel_case(name)
    return name[:1].upper() + name[1:]


def date_literal(c: Column) -> Column:
    """The lexical form of a date in a graph."""
    return F.date_format(c, "yyyy-MM-dd")


def cache_key(url: Column) -> Column:
    """The name under which a fetched file is kept: digest, hyphen, base name."""
    return F.concat(F.sha2(url, 512), F.lit("-"), base_name(url))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def extension(path: Column) -> Column:
    """With its dot, in lower case; empty without one."""
    return F.lower(F.regexp_extract(base_name(path), r"[^.](\.[^.]*)$", 1))


def route(url: Column, host_pattern: str, root: str) -> Column:
    """A local path for URLs of a mirrored host, the cache's name for all others; null for none.

    host_pattern: a regular expression of the scheme and host that ``root`` mirrors.
    """
    inside = F.regexp_extract(url, f"^{host_pattern}(/.+)$", 1)
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit(None)).when(inside != "", F.concat(F.lit(root), inside)).otherwise(cache_key(url))
