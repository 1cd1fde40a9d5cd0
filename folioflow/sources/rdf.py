"""Triples as N-Triples and Turtle, written and read.

N-Triples is a line a triple: writing is one expression, reading one regular
expression, both without a shuffle. Turtle is written from triples that are dealt
by range and sorted: a task streams its rows and opens and closes the blocks of
subjects, so a subject with any number of triples takes no memory. Such files are
read in splits, cut at the ends of statements; Turtle of any other form is read by
a tokeniser over whole files.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.triples import COLUMNS, RDF, XSD

SCHEMA = ", ".join(f"{c} string" for c in COLUMNS)


def _escaped(c: Column) -> Column:
    for raw, shown in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(raw), F.lit(shown))
    return c


def _unescaped(c: Column) -> Column:
    # The doubled mark steps aside first, so that what it guards is not read as an escape.
    c = F.replace(c, F.lit("\\\\"), F.lit("\x00"))
    for raw, shown in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(shown), F.lit(raw))
    return F.replace(c, F.lit("\x00"), F.lit("\\"))


def _name(c: Column) -> Column:
    return F.when(F.startswith(c, F.lit("_:")), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))


def object_term() -> Column:
    """The object as N-Triples and Turtle both write it."""
    text = F.concat(F.lit('"'), _escaped(F.col("o")), F.lit('"'))
    typed = F.when(F.col("o_lang").isNotNull(), F.concat(text, F.lit("@"), F.col("o_lang"))).when(F.col("o_datatype").isNotNull(), F.concat(text, F.lit("^^<"), F.col("o_datatype"), F.lit(">"))).otherwise(text)
    return F.when(F.col("o_kind") == "literal", typed).otherwise(_name(F.col("o")))


def ntriples(triples: DataFrame) -> DataFrame:
    """``line``: each triple as N-Triples."""
    return triples.select(F.concat_ws(" ", _name(F.col("s")), F.concat(F.lit("<"), F.col("p"), F.lit(">")), object_term(), F.lit(".")).alias("line"))


def turtle_blocks(triples: DataFrame) -> DataFrame:
    """s and ``block``: all that is said of a subject, sorted, in one row; files of any graph take ``turtle_lines``."""
    pair = F.concat_ws(" ", F.concat(F.lit("<"), F.col("p"), F.lit(">")), object_term())
    pairs = triples.select("s", pair.alias("pair")).distinct().groupBy("s").agg(F.array_sort(F.collect_list("pair")).alias("pairs"))
    return pairs.select("s", F.concat(_name(F.col("s")), F.lit(" "), F.array_join("pairs", " ;\n    "), F.lit(" .")).alias("block"))


def turtle_lines(triples: DataFrame) -> DataFrame:
    """``value``: the graph as lines of Turtle, sorted, a block of lines for each subject.

    Triples are dealt by ranges of subject and what is said of it, so that a
    subject with many of them lies in several tasks, and each of these writes a
    block of its own, as Turtle allows. A task holds one batch of rows and the one
    before: a line ends with a full stop if the next row has another subject.
    """
    pair = F.concat_ws(" ", F.concat(F.lit("<"), F.col("p"), F.lit(">")), object_term())
    pairs = triples.select(_name(F.col("s")).alias("s"), pair.alias("pair")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last row, whose end is not known yet
        before = None  # the subject of the row before it
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            if rows.num_rows > 1:
                yield _lines(rows.slice(0, rows.num_rows - 1), before, rows["s"].slice(1))
                before = rows["s"][rows.num_rows - 2].as_py()
            held = rows.slice(rows.num_rows - 1)
        if held is not None and held.num_rows:
            yield _lines(held, before, pa.chunked_array([pa.nulls(1, held["s"].type)]))

    return pairs.repartitionByRange("s", "pair").sortWithinPartitions("s", "pair").mapInArrow(run, "value string")


def _lines(rows: pa.Table, before: str | None, after: pa.ChunkedArray) -> pa.RecordBatch:
    """A line for each row; before and after: the subjects of the row before the first, and of the next row of each."""
    s, pair = rows["s"].combine_chunks(), rows["pair"].combine_chunks()
    previous = pa.concat_arrays([pa.array([before], s.type), s.slice(0, len(s) - 1)])
    begins = pc.fill_null(pc.not_equal(s, previous), True)
    ends = pc.fill_null(pc.not_equal(s, after.combine_chunks()), True)
    head = pc.if_else(begins, pc.binary_join_element_wise(s, pa.scalar(" ", s.type), pa.scalar("", s.type)), pa.scalar("    ", s.type))
    tail = pc.if_else(ends, pa.scalar(" .", s.type), pa.scalar(" ;", s.type))
    return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(head, pair, tail, pa.scalar("", s.type))], names=["value"])


def write_graph(triples: DataFrame, path: str, form: str = "turtle", prefixes: dict[str, str] | None = None, single: bool = False) -> None:
    """Write a graph as files of turtle or ntriples. single: one file, for a small graph or a final product."""
    if form == "turtle":
        lines = turtle_lines(triples)
        if prefixes:
            head = "\n".join(f"@prefix {k}: <{v}> ." for k, v in prefixes.items())
            lines = triples.sparkSession.createDataFrame([(head,)], "value string").unionByName(lines)
    elif form == "ntriples":
        lines = ntriples(triples).select(F.col("line").alias("value"))
    else:
        raise ValueError(f"form is turtle or ntriples, not {form!r}")
    (lines.coalesce(1) if single else lines).write.mode("overwrite").text(path)


_LINE = r'^\s*(?:<([^>]*)>|(_:\S+))\s+<([^>]*)>\s+(?:<([^>]*)>|(_:[^\s.]+)|"((?:[^"\\]|\\.)*+)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)\s*\.\s*$'


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Triples of N-Triples files; lines that are none are left out."""
    rows = spark.read.text(path).where(F.col("value").rlike(_LINE))
    part = lambda g: F.nullif(F.regexp_extract("value", _LINE, g), F.lit(""))
    literal = F.regexp_extract("value", _LINE, 6)
    is_name = part(4).isNotNull() | part(5).isNotNull()
    return rows.select(
        F.coalesce(part(1), part(2)).alias("s"),
        part(3).alias("p"),
        F.coalesce(part(4), part(5), _unescaped(literal)).alias("o"),
        F.when(part(4).isNotNull(), "iri").when(is_name, "blank").otherwise("literal").alias("o_kind"),
        part(7).alias("o_datatype"),
        part(8).alias("o_lang"),
    )


_TOKEN = re.compile(r'\s+|#[^\n]*|(?P<iri><[^>]*>)|(?P<string>"""(?:[^"\\]|\\.|"(?!""))*"""|"(?:[^"\\\n]|\\.)*")|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<type>\^\^)|(?P<mark>[;,.\[\]()])|(?P<number>[+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)|(?P<word>[^\s;,\[\]()<>"]*[^\s;,.\[\]()<>"])')
_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", '"': '"', "\\": "\\", "b": "\b", "f": "\f", "'": "'"}


def _text(token: str) -> str:
    body = token[3:-3] if token.startswith('"""') else token[1:-1]
    return re.sub(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" else _ESCAPES.get(m[1], m[1]), body)


def parse_turtle(text: str, document: str = "") -> Iterator[tuple]:
    """The triples of a Turtle document as COLUMNS tuples. document: makes blank names its own."""
    tokens = [(m.lastgroup, m[0]) for m in _TOKEN.finditer(text) if m.lastgroup]
    prefixes: dict[str, str] = {}
    found: list[tuple] = []
    at, fresh = 0, 0

    def peek() -> tuple[str, str]:
        return tokens[at] if at < len(tokens) else ("end", "")

    def take() -> tuple[str, str]:
        nonlocal at
        at += 1
        return tokens[at - 1] if at <= len(tokens) else ("end", "")

    def blank() -> str:
        nonlocal fresh
        fresh += 1
        return f"_:{document}g{fresh}"

    def term() -> tuple[str, str, str | None, str | None]:
        kind, value = take()
        if kind == "iri":
            return value[1:-1], "iri", None, None
        if kind == "string":
            if peek()[0] == "lang":
                return _text(value), "literal", None, take()[1][1:]
            if peek()[0] == "type":
                take()
                return _text(value), "literal", term()[0], None
            return _text(value), "literal", None, None
        if kind == "number":
            form = "double" if re.search("[eE]", value) else "decimal" if "." in value else "integer"
            return value, "literal", XSD + form, None
        if (kind, value) == ("mark", "["):
            name = blank()
            if peek()[1] != "]":
                statements(name)
            take()
            return name, "blank", None, None
        if (kind, value) == ("mark", "("):
            items = []
            while peek()[1] != ")" and peek()[0] != "end":
                items.append(term())
            take()
            names = [blank() for _ in items]
            for i, (name, item) in enumerate(zip(names, items)):
                found.append((name, RDF + "first", item[0], *item[1:]))
                after = (names[i + 1], "blank") if i + 1 < len(names) else (RDF + "nil", "iri")
                found.append((name, RDF + "rest", *after, None, None))
            return (names[0], "blank", None, None) if names else (RDF + "nil", "iri", None, None)
        if value in ("true", "false"):
            return value, "literal", XSD + "boolean", None
        if value == "a":
            return RDF + "type", "iri", None, None
        if value.startswith("_:"):
            return "_:" + document + value[2:], "blank", None, None
        prefix, colon, rest = value.partition(":")
        if not colon:
            raise ValueError(f"not a term: {value!r}")
        return prefixes.get(prefix, prefix + ":") + rest, "iri", None, None

    def statements(subject: str) -> None:
        while True:
            p = term()[0]
            while True:
                o = term()
                found.append((subject, p, o[0], *o[1:]))
                if peek()[1] != ",":
                    break
                take()
            while peek()[1] == ";":
                take()
            if peek()[1] in (".", "]", "") or peek()[0] == "end":
                return

    while at < len(tokens):
        kind, value = peek()
        if value.lower() in ("@prefix", "prefix", "@base", "base"):
            take()
            if value.lower().endswith("prefix"):
                name = take()[1].rstrip(":")
                prefixes[name] = take()[1][1:-1]
            else:
                take()
            if value.startswith("@"):
                take()
            continue
        subject = term()[0]
        if peek()[1] != ".":
            statements(subject)
        take()
    yield from found


def read_turtle(spark: SparkSession, path: str, several: bool = False) -> DataFrame:
    """Triples of Turtle files, parsed on the executors, each file whole.

    several: blank names belong to their file; without, equal names of all files are one node.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [t for name, value in zip(batch["path"], batch["content"]) for t in parse_turtle(bytes(value).decode("utf-8"), f"d{zlib.crc32(name.encode())}" if several else "")]
            yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(parse, SCHEMA)


#: One "predicate object" of a statement of ``turtle_lines``; groups as in _LINE from the predicate on.
_PAIR = r'^<([^>]*)>\s+(?:<([^>]*)>|(_:\S+)|"((?:[^"\\]|\\.)*+)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)$'
_SUBJECT = r"^\s*(?:<([^>]*)>|(_:\S+)) "


def read_turtle_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Triples of Turtle files as ``write_graph`` makes them, without a Python worker.

    Statements are the records of a text scan, so Spark cuts a large file into
    splits at their ends, and each feeds a task of its own. Names are written out
    in such files; prefix lines of their heads are passed over. What is no
    statement of this form is an error: it is Turtle for ``read_turtle``.
    """
    records = spark.read.option("lineSep", " .\n").text(path).select(F.regexp_replace("value", "^(@prefix [^\n]*\n)+", "").alias("value"))
    statements = records.where(~F.col("value").rlike("^\\s*(@prefix .*)?$"))
    subject = F.coalesce(*[F.nullif(F.regexp_extract("value", _SUBJECT, g), F.lit("")) for g in (1, 2)])
    rest = F.regexp_replace("value", _SUBJECT, "")
    # Line breaks within literals are escaped, so this stands between pairs alone.
    pairs = statements.select(subject.alias("s"), F.explode(F.split(rest, " ;\n    ")).alias("pair"))
    part = lambda g: F.nullif(F.regexp_extract("pair", _PAIR, g), F.lit(""))
    sound = F.col("s").isNotNull() & F.col("pair").rlike(_PAIR)
    checked = pairs.select(F.when(sound, F.col("s")).otherwise(F.raise_error(F.concat(F.lit("no statement in block form: "), F.coalesce(F.substring("pair", 1, 100), F.lit(""))))).alias("s"), "pair")
    is_name = part(2).isNotNull() | part(3).isNotNull()
    return checked.select(
        "s", part(1).alias("p"), F.coalesce(part(2), part(3), _unescaped(F.regexp_extract("pair", _PAIR, 4))).alias("o"),
        F.when(part(2).isNotNull(), "iri").when(is_name, "blank").otherwise("literal").alias("o_kind"), part(5).alias("o_datatype"), part(6).alias("o_lang"),
    )


def read_graph(spark: SparkSession, path: str) -> DataFrame:
    """Triples of files whose names tell their form (.nt, else Turtle)."""
    return read_ntriples(spark, path) if path.rstrip("/*").endswith(".nt") else read_turtle(spark, path)
