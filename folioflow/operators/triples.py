"""Entity tables as triples: s, p, o, o_kind (iri, literal or blank), o_datatype, o_lang.

Lifting is one projection a table: an array of all of a row's triples, nested
ones too, is exploded; nothing is shuffled until the triples are made a set. Nested structs
become nodes of their own, named by their ``about`` or by a digest of their
content, so that equal content has equal names on every run and executor.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import camel_case, date_literal, pascal_case

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
#: Prefixes of the vocabularies in use; "" is the catalogue's own.
PREFIXES = {"": "urn:folioflow:vocab:", "dc": "http://purl.org/dc/elements/1.1/", "dcndl": "http://ndl.go.jp/dcndl/terms/", "dcterms": "http://purl.org/dc/terms/"}
#: Fields that belong to a shared vocabulary, and those that are written in Pascal case.
SHARED = {"format": "dcterms"}
PASCAL = {"work_id", "person_id"}
COLUMNS = ["s", "p", "o", "o_kind", "o_datatype", "o_lang"]
_TRIPLES = "array<struct<s:string,p:string,o:string,o_kind:string,o_datatype:string,o_lang:string>>"


def predicate(field: str, prefixes: dict[str, str] = PREFIXES) -> str:
    """The IRI of a field, worked out when the plan is built."""
    return prefixes[SHARED.get(field, "")] + (pascal_case(field) if field in PASCAL else camel_case(field))


def resource(name: str, prefixes: dict[str, str] = PREFIXES) -> str:
    """prefix:name as an IRI; a full IRI as it is."""
    prefix, colon, rest = name.partition(":")
    return prefixes[prefix] + rest if colon and prefix in prefixes else name if colon else prefixes[""] + name


def _literal(value: Column, kind: T.DataType, date_type: str) -> tuple[Column, str | None]:
    if isinstance(kind, T.DateType):
        return date_literal(value), XSD + date_type
    if isinstance(kind, T.BooleanType):
        return value.cast("string"), XSD + "boolean"
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType)):
        return value.cast("string"), XSD + "integer"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value.cast("string"), XSD + "double"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), XSD + "dateTime"
    return value.cast("string"), None


def _triple(s: Column, p: Column | str, o: Column, o_kind: Column | str, datatype: Column | str | None = None) -> Column:
    named = lambda c: F.lit(c) if isinstance(c, str) else c
    kind_of = F.lit(datatype).cast("string") if datatype is None or isinstance(datatype, str) else datatype
    return F.struct(s.alias("s"), named(p).alias("p"), o.alias("o"), named(o_kind).alias("o_kind"), kind_of.alias("o_datatype"), F.lit(None).cast("string").alias("o_lang"))


def node_name(value: Column, kind: T.StructType) -> Column:
    """The name of a nested node: its ``about``, else a blank name from its content."""
    blank = F.concat(F.lit("_:b"), F.substring(F.sha2(F.to_json(value), 256), 1, 32))
    return F.coalesce(value["about"], blank) if "about" in kind.names else blank


def _name_kind(name: Column) -> Column:
    return F.when(F.startswith(name, F.lit("_:")), "blank").otherwise("iri")


class _Lift:
    """The choices of one ``lift``; builds array<triple> expressions by type."""

    def __init__(self, links: set[str], link_prefix: str, mode: str, date_type: str, prefixes: dict[str, str]) -> None:
        self.links, self.link_prefix, self.mode, self.date_type, self.prefixes = links, link_prefix, mode, date_type, prefixes

    def end(self, name: str, value: Column, kind: T.DataType) -> tuple[Column, Column | str, str | None]:
        """Object, its kind and datatype for one value of a field."""
        if isinstance(kind, T.StructType):
            node = node_name(value, kind)
            return node, _name_kind(node), None
        if name in self.links:
            return F.concat(F.lit(self.link_prefix), value), "iri", None
        o, datatype = _literal(value, kind, self.date_type)
        return o, "literal", datatype

    def chain(self, subject: Column, name: str, p: str, values: Column, kind: T.DataType) -> Column:
        """An ordered list: its head, and a first and a rest for each cell, named by subject, field and place."""
        cell = lambda i: F.concat(F.lit("_:l"), F.substring(F.sha2(F.concat_ws("\x1f", subject, F.lit(name), i.cast("string")), 256), 1, 32))
        first, rest, nil = RDF + "first", RDF + "rest", F.lit(RDF + "nil")

        def both(value: Column, i: Column) -> Column:
            more = i + 1 < F.size(values)
            return F.array(_triple(cell(i), first, *self.end(name, value, kind)), _triple(cell(i), rest, F.when(more, cell(i + 1)).otherwise(nil), F.when(more, "blank").otherwise("iri")))

        some = F.size(values) > 0
        head = F.array(_triple(subject, p, F.when(some, cell(F.lit(0))).otherwise(nil), F.when(some, "blank").otherwise("iri")))
        return F.concat(head, F.flatten(F.transform(values, both)))

    def fields(self, subject: Column, value, kind: T.StructType, skip: set[str]) -> list[Column]:
        """array<triple> of each field of a node, null where the field is. value: name to Column."""
        out: list[Column] = []
        for field in kind.fields:
            name, data = field.name, field.dataType
            if name in skip:
                continue
            given, p = value(name), predicate(name, self.prefixes)
            if isinstance(data, T.ArrayType):
                element = data.elementType
                values = F.filter(given, lambda x: x.isNotNull())
                if self.mode == "list":
                    edges = self.chain(subject, name, p, values, element)
                else:
                    edges = F.transform(values, self._edge(subject, p, name, element))
                if isinstance(element, T.StructType):
                    edges = F.concat(edges, F.flatten(F.transform(values, self._inner(element))))
            else:
                edges = F.array(_triple(subject, p, *self.end(name, given, data)))
                if isinstance(data, T.StructType):
                    edges = F.concat(edges, self._inner(data)(given))
            out.append(F.when(given.isNotNull(), edges).cast(_TRIPLES))
        return out

    def _edge(self, subject: Column, p: str, name: str, kind: T.DataType):
        return lambda x: _triple(subject, p, *self.end(name, x, kind))

    def _inner(self, kind: T.StructType):
        return lambda x: F.flatten(F.array_compact(F.array(*self.fields(node_name(x, kind), lambda f: x[f], kind, {"about"})))).cast(_TRIPLES)


def lift(rows: DataFrame, id_column: str, links: Iterable[str] = (), link_prefix: str = "", mode: str = "multi", date_type: str = "date", prefixes: dict[str, str] = PREFIXES) -> DataFrame:
    """The triples of a table, not yet a set: one projection and one explode.

    id_column: the subjects' IRIs; rows without one give nothing. links: fields
    whose strings name entities, made IRIs with ``link_prefix``. mode: arrays
    as one triple an element (multi) or as ordered lists (list; an empty one is
    nil). date_type: the type of date literals ("dateTime" where consumers
    expect that name).
    """
    if mode not in ("multi", "list"):
        raise ValueError(f"mode is multi or list, not {mode!r}")
    choices = _Lift(set(links), link_prefix, mode, date_type, prefixes)
    parts = choices.fields(F.col(id_column), lambda name: F.col(f"`{name}`"), rows.schema, {id_column, "about"})
    if not parts:
        raise ValueError("no field besides the subject")
    every = F.flatten(F.array_compact(F.array(*parts)))
    return rows.where(F.col(id_column).isNotNull()).select(F.explode(every).alias("x")).select("x.*").select(*COLUMNS)


def as_graph(*triples: DataFrame) -> DataFrame:
    """The union of triples as a set."""
    return reduce(DataFrame.unionByName, triples).dropDuplicates(COLUMNS)


def same_graph(a: DataFrame, b: DataFrame) -> bool:
    """Whether two graphs hold the same triples; blank names count, as they come from content."""
    a, b = a.select(*COLUMNS).distinct(), b.select(*COLUMNS).distinct()
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def graph_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Triples that are in one graph only, with ``change``: added or removed."""
    added = new.select(*COLUMNS).exceptAll(old.select(*COLUMNS)).withColumn("change", F.lit("added"))
    return added.unionByName(old.select(*COLUMNS).exceptAll(new.select(*COLUMNS)).withColumn("change", F.lit("removed")))


def validate_graph(triples: DataFrame) -> DataFrame:
    """Triples that are not well formed, with the reason."""
    absolute = r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]*$"
    number = F.col("o_datatype").isin(XSD + "integer")
    reason = (
        F.when(F.col("s").isNull() | F.col("p").isNull() | F.col("o").isNull(), "a part is missing")
        .when(~F.col("s").rlike("^_:") & ~F.col("s").rlike(absolute), "subject is no IRI")
        .when(~F.col("p").rlike(absolute), "predicate is no IRI")
        .when((F.col("o_kind") == "iri") & ~F.col("o").rlike(absolute), "object is no IRI")
        .when((F.col("o_kind") != "literal") & F.col("o_datatype").isNotNull(), "only literals have a type")
        .when(number & F.col("o").try_cast("decimal(38,0)").isNull(), "not of its type")
        .when((F.col("o_datatype") == XSD + "date") & F.col("o").try_cast("date").isNull(), "not of its type")
    )
    return triples.withColumn("reason", reason).where(F.col("reason").isNotNull())
