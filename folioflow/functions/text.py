"""Text columns: lines, sentences, widths, and the flat part of the inline markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import drop_trailing_empties

TERMINATORS = "。！？"
CLOSERS = "」』）”"
KATAKANA_SENTENCE = r"^[ァ-ヶー・、。！？\x{3000} ]+$"
OPEN_QUOTE = "「"
UNKNOWN_WORD = "未知"
_ASCII = "".join(map(chr, range(0x21, 0x7F)))
_WIDE = "".join(chr(i + 0xFEE0) for i in range(0x21, 0x7F))


def strip_cr(c: Column) -> Column:
    return F.replace(c, F.lit("\r"), F.lit(""))


def split_lines(c: Column) -> Column:
    """Lines, ended by a line feed with or without a carriage return; no empty ones at the end."""
    return drop_trailing_empties(F.split(c, "\r?\n"))


def to_full_width(c: Column) -> Column:
    """Printable ASCII and the blank in their full-width forms."""
    return F.translate(c, _ASCII + " ", _WIDE + "　")


def sentence_pattern(terminators: str = TERMINATORS, closers: str = CLOSERS) -> str:
    """A sentence: up to its terminators and the closing marks behind, or the rest of the line."""
    escaped = "".join("\\" + t if t in r".?![]^-\\" else t for t in terminators)
    shut = "".join("\\" + t if t in r"\])" else t for t in closers)
    ends = f"[{escaped}]+" + (f"[{shut}]*" if closers else "")
    return f"[^{escaped}]+(?:{ends})?|{ends}"


def sentences(line: Column, terminators: str = TERMINATORS, closers: str = CLOSERS) -> Column:
    """The sentences of a line, outer blanks trimmed, empty ones dropped."""
    found = F.regexp_extract_all(line, F.lit(sentence_pattern(terminators, closers)), F.lit(0))
    return F.filter(F.transform(found, lambda s: F.regexp_replace(s, r"^[ \x{3000}]+|[ \x{3000}]+$", "")), lambda s: s != "")


def paragraphs(c: Column) -> Column:
    """The lines that are not blank."""
    return F.filter(split_lines(c), lambda x: x.rlike(r"[^\s\x{3000}]"))


def has_quotation(c: Column) -> Column:
    return F.contains(c, F.lit(OPEN_QUOTE))


def is_katakana(c: Column) -> Column:
    return c.rlike(KATAKANA_SENTENCE)


def is_unknown(origin: Column) -> Column:
    """Whether a token's word-origin feature says that no dictionary has it."""
    return F.coalesce(origin == UNKNOWN_WORD, F.lit(False))


# The flat part of the markup; nested text takes operators.markup.
ANNOTATION = r"［＃([^］]*)］"
RUBY = r"《([^《》]*)》"
#: Characters that a reading without a base mark belongs to (fixed value).
KANJI_RUN = r"[\x{3400}-\x{9FCB}\x{F900}-\x{FAD9}仝〆○々]+"
RUBY_PAIR = rf"(?:｜([^｜《》\n]+)|({KANJI_RUN}))《([^《》\n]*)》"


def annotations(c: Column) -> Column:
    """The contents of all bracketed annotations, in order."""
    return F.regexp_extract_all(c, F.lit(ANNOTATION), F.lit(1))


def ruby_pairs(c: Column) -> Column:
    """array<struct<base, reading>>: marked bases, or the run of kanji before a reading."""
    group = lambda g: F.regexp_extract_all(c, F.lit(RUBY_PAIR), F.lit(g))
    return F.zip_with(F.zip_with(group(1), group(2), lambda a, b: F.when(a != "", a).otherwise(b)), group(3), lambda base, reading: F.struct(base.alias("base"), reading.alias("reading")))


def strip_markup(c: Column) -> Column:
    """The text without annotations, readings and base marks."""
    return F.regexp_replace(c, rf"※?{ANNOTATION}|{RUBY}|｜", "")
