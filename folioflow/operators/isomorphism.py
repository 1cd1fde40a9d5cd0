"""Whether two graphs are the same but for the names of their blank nodes.

Blank nodes get colours that depend on what is said of them and not on their
names: each round a node's colour becomes a digest of its own and of the
multiset of its neighbours' (direction, predicate, and name, literal or colour),
until no class is parted further. A multiset's digest is a sum of hashes, with
partial states, so nodes with many neighbours gather no list.

What refinement leaves together is decided by component, as blank nodes that no
chain of blank nodes joins are independent of each other: graphs are equal if
their ground triples are and they have the same components equally often. Where
all colours within a component differ they name its nodes, and its form is again
a sum of hashes. The others, which hold nodes that look alike, are each put into
a canonical form by trying their nodes in turn, in the tasks, a component at a
time.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .components import components
from .triples import COLUMNS

#: Triples of a component whose nodes look alike, and complete namings tried of one: beyond, an error says so.
MOST_TRIPLES, MOST_NAMINGS = 200_000, 20_000


def _blank(c: str) -> Column:
    return F.col(c).startswith("_:")


def _object_blank() -> Column:
    return (F.col("o_kind") != "literal") & _blank("o")


def _shown(*parts: Column) -> Column:
    return F.concat_ws("\x1f", *[F.coalesce(p, F.lit("\x00")) for p in parts])


def _edges(triples: DataFrame) -> DataFrame:
    """side, node, label, other: what each triple says of each of its blank nodes; other: a blank node, or null and then within the label."""
    told = triples.withColumns({"_s": _blank("s"), "_o": _object_blank()})
    term = _shown(F.col("o"), F.col("o_kind"), F.col("o_datatype"), F.col("o_lang"))
    out = F.struct(F.col("s").alias("node"), _shown(F.lit("out"), F.col("p"), F.when(~F.col("_o"), term)).alias("label"), F.when(F.col("_o"), F.col("o")).alias("other"))
    into = F.struct(F.col("o").alias("node"), _shown(F.lit("in"), F.col("p"), F.when(~F.col("_s"), F.col("s"))).alias("label"), F.when(F.col("_s"), F.col("s")).alias("other"))
    ends = F.array_compact(F.array(F.when(F.col("_s"), out), F.when(F.col("_o"), into)))
    return told.select("side", F.explode(ends).alias("x")).select("side", "x.*")


def _multiset(*values: Column) -> list[Column]:
    """Aggregates that are the same for the same multiset of values, in whatever order they come."""
    return [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)")).cast("string").alias(f"_h{seed}") for seed in (1, 2)] + [F.count("*").alias("_n")]


_DIGESTS = [f"_h{seed}" for seed in (1, 2)] + ["_n"]


def _refined(triples: DataFrame, space: Workspace) -> DataFrame:
    """side, node, colour of the blank nodes of ``triples`` (with ``side``), refined until no class is parted."""
    edges = space.store(_edges(triples))
    # Edges without a blank node at their other end have no key to meet a colour by: a join would deal them all to one task.
    linked, alone = edges.where("other is not null"), edges.where("other is null").select("side", "node", "label", F.lit("-").alias("seen"))
    colours = edges.select("side", "node").distinct().withColumn("colour", F.lit(""))
    classes = 1
    while True:
        seen = colours.select("side", F.col("node").alias("other"), F.col("colour").alias("seen"))
        near = alone.unionByName(linked.join(seen, ["side", "other"]).select("side", "node", "label", "seen"))
        sums = near.groupBy("side", "node").agg(*_multiset(F.col("label"), F.col("seen")))
        colours = space.store(sums.join(colours, ["side", "node"]).select("side", "node", F.md5(F.concat_ws("|", "colour", *_DIGESTS)).alias("colour")))
        found = colours.select("colour").distinct().count()
        if found == classes:
            return colours
        classes = found


def blank_colours(triples: DataFrame) -> DataFrame:
    """node, colour: the classes of the graph's blank nodes that what is said of them tells apart."""
    with Workspace(triples.sparkSession, "colours") as space:
        rows = triples.select(F.lit(0).alias("side"), *COLUMNS).distinct()
        return space.keep(_refined(rows, space).select("node", "colour"))


def _canonical(rows: list[tuple], colour: dict[str, str]) -> str:
    """A digest that two components have in common exactly if they are isomorphic. rows: (s, p, object key, object's blank name or None)."""
    near: dict[str, list[tuple[str, str | None]]] = {n: [] for n in colour}
    for s, p, key, o in rows:
        if s in colour:
            near[s].append((f"o\x1f{p}\x1f{'' if o else key}", o))
        if o:
            near[o].append((f"i\x1f{p}\x1f{'' if s in colour else s}", s if s in colour else None))
    links = sum(1 for s, _, _, o in rows if o and s in colour)
    tree = links == len(colour) - 1  # connected, so without a cycle: nodes of one colour can be exchanged, and any choice will do
    tried = 0

    def digest(x: str) -> str:
        return hashlib.md5(x.encode("utf-8", "surrogatepass")).hexdigest()

    def refine(now: dict[str, str]) -> dict[str, str]:
        classes = len(set(now.values()))
        while True:
            now = {n: digest(now[n] + "|" + "|".join(sorted(f"{label}\x1f{now[o] if o else '-'}" for label, o in near[n]))) for n in now}
            if (found := len(set(now.values()))) == classes:
                return now
            classes = found

    def search(now: dict[str, str]) -> str:
        nonlocal tried
        now = refine(now)
        cells: dict[str, list[str]] = {}
        for n, c in now.items():
            cells.setdefault(c, []).append(n)
        if len(cells) == len(now):
            tried += 1
            if tried > MOST_NAMINGS:
                raise ValueError(f"a component of {len(now)} blank nodes has too many nodes that look alike")
            return digest("\n".join(sorted(f"{now.get(s, s)}\x1f{p}\x1f{now[o] if o else key}" for s, p, key, o in rows)))
        _, cell = min((len(x), c) for c, x in cells.items() if len(x) > 1)
        nodes = cells[cell][:1] if tree else cells[cell]
        return min(search(now | {n: digest(now[n] + "!")}) for n in nodes)

    return search(dict(colour))


def _forms(triples: DataFrame, colours: DataFrame, space: Workspace) -> DataFrame:
    """side, form: of every component of blank nodes."""
    key = lambda c: _shown(F.col("side").cast("string"), F.col(c))
    links = triples.where(_blank("s") & _object_blank()).select(key("s").alias("a"), key("o").alias("b"))
    alone = colours.select(key("node").alias("a"), key("node").alias("b"))
    parts = components(links.unionByName(alone)).withColumnRenamed("node", "_key")
    placed = space.store(colours.withColumn("_key", key("node")).join(parts, "_key").select("side", "node", "colour", "component"))
    alike = placed.groupBy("component", "colour").count().groupBy("component").agg((F.max("count") > 1).alias("alike"))
    subject = placed.select("side", F.col("node").alias("s"), F.col("colour").alias("s_colour"), F.col("component").alias("s_part"))
    target = placed.select("side", F.col("node").alias("o"), F.col("colour").alias("o_colour"), F.col("component").alias("o_part"), F.lit(True).alias("_o"))
    told = triples.withColumn("_o", _object_blank()).join(subject, ["side", "s"], "left").join(target, ["side", "o", "_o"], "left")
    term = _shown(F.col("o"), F.col("o_kind"), F.col("o_datatype"), F.col("o_lang"))
    rows = told.withColumn("component", F.coalesce("s_part", "o_part")).join(alike, "component")
    rows = space.store(rows.select("side", "component", "alike", "s", "p", "o", "s_colour", "o_colour", F.when(F.col("o_colour").isNull(), term).alias("key")))
    named = rows.where("not alike").groupBy("side", "component").agg(*_multiset(F.coalesce("s_colour", "s"), F.col("p"), F.coalesce("o_colour", "key")))
    plain = named.select("side", F.concat_ws("|", *_DIGESTS).alias("form"))
    hard = rows.where("alike")
    if large := hard.groupBy("side", "component").count().where(F.col("count") > MOST_TRIPLES).first():
        raise ValueError(f"a component of {large['count']} triples has nodes that look alike")

    def canonical(group: pd.DataFrame) -> pd.DataFrame:
        colour = {n: c for n, c in zip(group["s"], group["s_colour"]) if isinstance(c, str)} | {n: c for n, c in zip(group["o"], group["o_colour"]) if isinstance(c, str)}
        triples_ = [(s, p, key, o if isinstance(c, str) else None) for s, p, key, o, c in zip(group["s"], group["p"], group["key"], group["o"], group["o_colour"])]
        return pd.DataFrame({"side": group["side"].iloc[:1], "form": [_canonical(triples_, colour)]})

    return plain.unionByName(hard.groupBy("side", "component").applyInPandas(canonical, "side int, form string"))


def _uneven(rows: DataFrame, key: str) -> bool:
    """Whether some value of ``key`` stands more often on one side than on the other."""
    return not rows.groupBy(key).agg(F.sum(F.when(F.col("side") == 0, 1).otherwise(-1)).alias("n")).where("n != 0").isEmpty()


def isomorphic(a: DataFrame, b: DataFrame) -> bool:
    """Whether a renaming of blank nodes makes one graph the other. Repeated triples count once."""
    sides = [x.select(F.lit(n).alias("side"), *COLUMNS).distinct() for n, x in enumerate((a, b))]
    with Workspace(a.sparkSession, "isomorphism") as space:
        both = space.store(sides[0].unionByName(sides[1]).withColumn("_blank", _blank("s") | _object_blank()))
        ground = both.where("not _blank").select("side", _shown(*[F.col(c) for c in COLUMNS]).alias("key"))
        if _uneven(ground, "key"):
            return False
        told = both.where("_blank").drop("_blank")
        if told.isEmpty():
            return True
        colours = _refined(told, space)
        return not _uneven(colours, "colour") and not _uneven(_forms(told, colours, space), "form")


__all__: list[str] = ["blank_colours", "isomorphic"]
