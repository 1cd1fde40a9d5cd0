"""Rules over rows: a column of the names of those a row breaks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rule: its name, and a condition that holds for good rows. A null condition counts as broken.
Rule = tuple[str, Column]


def required(name: str) -> Rule:
    return f"{name}: required", F.col(name).isNotNull()


def one_of(name: str, values: Iterable, nilable: bool = False) -> Rule:
    good = F.col(name).isin(*values)
    return f"{name}: one of a set", (F.col(name).isNull() | good) if nilable else good


def non_negative(name: str, nilable: bool = False) -> Rule:
    good = F.col(name) >= 0
    return f"{name}: not negative", (F.col(name).isNull() | good) if nilable else good


def not_blank(name: str) -> Rule:
    return f"{name}: not blank", F.length(F.trim(F.col(name))) > 0


def matches(name: str, pattern: str, nilable: bool = False) -> Rule:
    good = F.col(name).rlike(pattern)
    return f"{name}: of a form", (F.col(name).isNull() | good) if nilable else good


def each(name: str, what: str, test) -> Rule:
    """Every element of an array passes."""
    return f"{name}: every {what}", F.forall(F.col(name), test)


def quotation_rules() -> list[Rule]:
    """Of quotation records; that the other three are flags is a matter of the schema (``tei.QUOTATION``)."""
    return [one_of("type", ("spoken", "thought"), nilable=True)]


def validate(rows: DataFrame, rules: list[Rule], column: str = "violations") -> DataFrame:
    """``rows`` with the array of the broken rules' names, in the order given."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]
    return rows.withColumn(column, F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))


def invalid(rows: DataFrame, rules: list[Rule], column: str = "violations") -> DataFrame:
    return validate(rows, rules, column).where(F.size(column) > 0)


def assert_schema(rows: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """``rows`` unchanged if the wanted columns have the wanted types; else a ValueError names those that don't."""
    have = dict(rows.dtypes)
    wrong = [f"{c}: {have.get(c, 'absent')}, not {t}" for c, t in wanted.items() if have.get(c) != t]
    if wrong:
        raise ValueError("; ".join(wrong))
    return rows


# Fixed values of the enumerated fields.
FORMATS = ("text/plain", "text/html", "text/xml")
CHARACTER_SETS = ("JIS X 0208", "Unicode")
ENCODINGS = ("SJIS", "EUC", "UTF-8")
STYLES = ("新字新仮名", "新字旧仮名", "旧字新仮名", "旧字旧仮名", "その他")


def work_rules() -> list[Rule]:
    return [
        ("work_id: given", F.length("work_id") > 1),
        required("title"),
        required("copyright_expired"),
        required("publishing_date"),
        required("last_modified_date"),
        one_of("orthographic_style", STYLES, nilable=True),
        each("sources", "format known", lambda s: s["format"].isin(*FORMATS)),
        each("sources", "character set known", lambda s: s["character_set"].isin(*CHARACTER_SETS)),
        each("sources", "encoding known", lambda s: s["encoding"].isin(*ENCODINGS)),
        each("sources", "revision count", lambda s: s["revision_count"] >= 0),
        each("sources", "date", lambda s: s["last_modified_date"].isNotNull()),
    ]


def person_rules() -> list[Rule]:
    return [("person_id: given", F.length("person_id") > 1), required("person_copyright_expired")]
