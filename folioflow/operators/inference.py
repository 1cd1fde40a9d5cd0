"""What follows from a graph: transitive closures to their fixpoint, and the RDFS rules.

A closure has up to the square of its nodes as rows, so no round joins or
shuffles pairs that were found. The edges are parted by component (what no
path joins shares no pair), a component's starts are dealt in blocks, and a
task walks from a block's starts breadth first over the edges of its component,
which it holds as two arrays of numbers, and sends on each pair as it is met,
once and at its least distance. Only edges and starts are shuffled and stored;
pairs are streamed to whatever asks for them.

Where distances are not asked for, no start is walked from by itself: a task
goes once over the component's edges, cycles as one node, and hands each node
the set of a block's starts that reach it, a number with a bit a start. Pairs
leave it as lists, a node with the starts that reach it, and become rows in the
engine; whoever wants numbers of pairs alone (``counts``) gets sums of the bits.

Components of more than MOST_EDGES edges, which one task should not hold, are
closed in rounds that double their reach and are semi-naive: a round joins only
the pairs found exactly at the last round's distance, and what is known already
is taken out by an anti-join. A pair is kept with its distance, so a round of
reach 2n finds the pairs at n+1 to 2n as (exactly n) then (1 to n): every pair
of a chain once, and a chain of a thousand in ten rounds. Rounds end when one
finds nothing, whatever the hierarchy's depth; cycles end like that too. Each is
a table in the shared folder, removed at the end, so a lost executor repeats
one round and no plan grows with the rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import join_counted
from ..session import Workspace
from .components import components
from .triples import COLUMNS, RDF

RDFS = "http://www.w3.org/2000/01/rdf-schema#"
TYPE = RDF + "type"
SUBCLASS, SUBPROPERTY, DOMAIN, RANGE = (RDFS + x for x in ("subClassOf", "subPropertyOf", "domain", "range"))


#: Edges of a component that one task may hold, and those of a graph that is taken for one component; starts that a task walks from.
MOST_EDGES, FEW_EDGES, BLOCK = 200_000, 5_000, 1024
#: Starts by nodes and edges that a task walks at once, which bounds its memory, and the most tasks.
CELLS, MOST_TASKS = 1 << 21, 4096
#: Rows that a task sends on together.
SENT = 1 << 15
#: Starts whose bits a task holds for each node, and bits that it spreads out at once.
WIDE, SPREAD = 4096, 1 << 20


def _walk(start: np.ndarray, first: np.ndarray, begins: np.ndarray, ends: np.ndarray, nodes: int, starts: int, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Level by level, the (start, node) met first at that distance, from 0 on with ``own``. (start, first): where walks begin; node n's edges end at ends[begins[n]:begins[n + 1]]."""
    seen = np.zeros(starts * nodes, bool)
    mark = np.empty(starts * nodes, np.int32)
    distance = 0
    if own:
        seen[start * nodes + first] = True
        yield start, first, distance
    while len(start):
        sizes = begins[first + 1] - begins[first]
        places = np.repeat(begins[first] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        start, first = np.repeat(start, sizes), ends[places]
        cell = start * nodes + first
        fresh = np.flatnonzero(~seen[cell])
        mark[cell[fresh]] = np.arange(len(fresh))
        fresh = fresh[mark[cell[fresh]] == np.arange(len(fresh))]  # a cell met twice counts once
        seen[cell[fresh]] = True
        start, first, distance = start[fresh], first[fresh], distance + 1
        if len(start):
            yield start, first, distance


def _numbered(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The starts, by number which of them begins at which node, the edges by node as ``_walk`` takes them, and the nodes' names."""
    is_edge = pc.is_null(table["s"])
    edges, starts = table.filter(is_edge), table.filter(pc.invert(is_edge))
    names = pc.unique(pa.chunked_array([*edges["a"].chunks, *edges["b"].chunks]))
    number = lambda c: pc.index_in(c, names).to_numpy().astype(np.int64)
    a, b = number(edges["a"]), number(edges["b"])
    order = np.argsort(a, kind="stable")
    begins, ends = np.searchsorted(a[order], np.arange(len(names) + 1)), b[order]
    who = pc.unique(starts["s"])
    owner, first = pc.index_in(starts["s"], who).to_numpy().astype(np.int64), number(starts["a"])
    return who, owner, first, begins, ends, names


def _block(table: pa.Table, own: bool) -> Iterator[pa.RecordBatch]:
    """a, b, distance from one block's rows: the edges (no ``s``) of a component, and the starts s with their first nodes a."""
    who, owner, first, begins, ends, names = _numbered(table)
    together = max(1, CELLS // (len(names) + len(ends)))
    for low in range(0, len(who), together):
        some = (owner >= low) & (owner < low + together)
        held, size = [], 0
        for found in _walk(owner[some] - low, first[some], begins, ends, len(names), min(together, len(who) - low), own):
            held.append((found[0] + low, found[1], np.full(len(found[0]), found[2])))
            size += len(found[0])
            if size >= SENT:
                yield from _sent(held, who, names)
                held, size = [], 0
        if held:
            yield from _sent(held, who, names)


def _sent(held: list, who: pa.Array, names: pa.Array) -> Iterator[pa.RecordBatch]:
    start, node, distance = map(np.concatenate, zip(*held))
    for i in range(0, len(start), SENT):
        part = slice(i, i + SENT)
        yield pa.RecordBatch.from_arrays([who.take(pa.array(start[part])), names.take(pa.array(node[part])), pa.array(distance[part])], names=["a", "b", "distance"])


def _knots(begins: list[int], ends: list[int]) -> list[int]:
    """For each node the number of its strongly connected part (Tarjan, 1972); edges between parts go to smaller numbers."""
    nodes = len(begins) - 1
    index, low, part, at = [0] * nodes, [0] * nodes, [-1] * nodes, begins[:]
    open_, met, parts = [], 0, 0
    for root in range(nodes):
        path = [] if index[root] else [root]
        while path:
            v = path[-1]
            if not index[v]:
                met += 1
                index[v] = low[v] = met
                open_.append(v)
            i, stop, deeper = at[v], begins[v + 1], -1
            while i < stop and deeper < 0:
                w = ends[i]
                i += 1
                if not index[w]:
                    deeper = w
                elif part[w] < 0 and index[w] < low[v]:
                    low[v] = index[w]
            at[v] = i
            if deeper >= 0:
                path.append(deeper)
                continue
            path.pop()
            if low[v] == index[v]:
                w = -1
                while w != v:
                    w = open_.pop()
                    part[w] = parts
                parts += 1
            elif path:
                low[path[-1]] = min(low[path[-1]], low[v])
    return part


def _reach(told: list[int], begins: list[int], ends: list[int], own: bool) -> list[int]:
    """For each node the bits of the starts that a path of an edge or more joins to it. told: the bits of those that begin there, with ``own`` of the result too."""
    part = _knots(begins, ends)
    members: list[list[int]] = [[] for _ in range(max(part, default=-1) + 1)]
    for v, k in enumerate(part):
        members[k].append(v)
    carried, found = [0] * len(members), told[:]
    for k in range(len(members) - 1, -1, -1):
        inside, come = members[k], carried[k]
        if len(inside) > 1 or inside[0] in ends[begins[inside[0]] : begins[inside[0] + 1]]:
            for v in inside:
                come |= told[v]
        for v in inside:
            sent = come | told[v]
            found[v] = sent if own else come
            for w in ends[begins[v] : begins[v + 1]]:
                if part[w] != k:
                    carried[part[w]] |= sent
    return found


def _bits(table: pa.Table, own: bool) -> tuple[pa.Array, pa.Array, Iterator[tuple[int, np.ndarray]]]:
    """The starts and the nodes of a block, and by stretches of nodes, each from a first one on, a row a node of ones for the starts that reach it."""
    who, owner, first, begins, ends, names = _numbered(table)
    told = [0] * len(names)
    for o, v in zip(owner.tolist(), first.tolist()):
        told[v] |= 1 << o
    found = _reach(told, begins.tolist(), ends.tolist(), own)
    wide = max(8, 1 << (len(who) - 1).bit_length())
    rows = max(1, SPREAD // wide)

    def stretches() -> Iterator[tuple[int, np.ndarray]]:
        for i in range(0, len(found), rows):
            raw = b"".join(x.to_bytes(wide // 8, "little") for x in found[i : i + rows])
            yield i, np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, wide // 8), axis=1, bitorder="little")

    return who, names, stretches()


def _listed(table: pa.Table, own: bool) -> Iterator[pa.RecordBatch]:
    """a, b: the nodes b of one block with the starts that reach them."""
    who, names, stretches = _bits(table, own)
    for i, ones in stretches:
        sizes = ones.sum(axis=1, dtype=np.int32)
        cells = np.flatnonzero(ones.view(bool).ravel()) & (ones.shape[1] - 1)
        full = np.flatnonzero(sizes)
        starts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes[full])]).astype(np.int32)), who.take(pa.array(cells)))
        if len(full):
            yield pa.RecordBatch.from_arrays([starts, names.take(pa.array(full + i))], names=["a", "b"])


def _summed(table: pa.Table, own: bool) -> Iterator[pa.RecordBatch]:
    """a, n: the starts of one block and how many of its nodes each reaches."""
    who, _, stretches = _bits(table, own)
    total: np.ndarray | int = 0
    for _, ones in stretches:
        total = total + ones.sum(axis=0, dtype=np.int32).astype(np.int64)
    yield pa.RecordBatch.from_arrays([who, pa.array(total[: len(who)])], names=["a", "n"])


def _dealt(starts: DataFrame, edges: DataFrame, own: bool, block: int, work, schema: str) -> tuple[DataFrame, DataFrame | None]:
    """What ``work`` makes of each block of ``block`` starts, and a, b, distance of the components that no task should hold, if there are any.

    schema: of what ``work`` yields; {a} and {b} stand for the types of starts and nodes.
    """
    with Workspace(edges.sparkSession, "closure") as space:
        known = space.store(edges.where("a is not null and b is not null").select("a", "b").distinct())
        few = known.limit(FEW_EDGES + 1).count() <= FEW_EDGES
        ends = known.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        parts = space.store(ends.withColumn("component", F.lit(0))) if few else components(known)
        parts = parts.withColumnRenamed("node", "a")
        placed = space.keep(known.join(parts, "a"))
        given = starts.where("s is not null and a is not null").select("s", "a").distinct()
        told = space.keep(given.join(parts, "a").withColumn("deal", F.xxhash64("s")))
        sizes = placed.groupBy("component").agg(F.count("*").alias("edges"))
        fill = told.groupBy("component").agg(F.ceil(F.approx_count_distinct("s") / block).cast("int").alias("blocks"))
        sizes = space.keep(sizes.join(fill, "component"))
        small, large = sizes.where(F.col("edges") <= MOST_EDGES).drop("edges"), sizes.where(F.col("edges") > MOST_EDGES)
        far = None
        if not large.isEmpty():
            here = told.join(large, "component", "left_semi").select("s", "a")
            above = _rounds(placed.join(large, "component", "left_semi").select("a", "b"))
            pairs = here.join(above, "a").select("s", "b", "distance")
            pairs = pairs.unionByName(here.select("s", F.col("a").alias("b"), F.lit(0).cast("long").alias("distance"))) if own else pairs
            far = space.keep(pairs.groupBy(F.col("s").alias("a"), "b").agg(F.min("distance").alias("distance")))
        tasks = min(MOST_TASKS, 2 * (small.agg(F.sum("blocks")).first()[0] or 1))
    kind = lambda df, c: df.schema[c].dataType
    copies = join_counted(placed, small, ["component"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = copies.select("component", "block", F.lit(None).cast(kind(starts, "s")).alias("s"), "a", "b")
    begun = join_counted(told, small, ["component"]).select("component", F.pmod("deal", "blocks").cast("int").alias("block"), "s", "a", F.lit(None).cast(kind(edges, "b")).alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(pa.Table.from_batches(batches), own)

    # So many tasks whatever the bytes that go in, which say nothing about the pairs that come out.
    groups = dealt.unionByName(begun).repartition(tasks, "component", "block").groupBy("component", "block")
    return groups.applyInArrow(run, schema.format(a=kind(starts, "s").simpleString(), b=kind(edges, "b").simpleString())), far


def reached(starts: DataFrame, edges: DataFrame, own: bool = False) -> DataFrame:
    """a, b, distance: the nodes b that a path of one of ``edges`` (a, b) or more joins to a node that a start says, each once, with the shortest's length.

    starts: (s, a), a start and a node from which it goes, if edges have it; s comes back as a. own: such nodes
    themselves too, at distance 0. Nulls and repeated rows add nothing. Starts and edges are stored until the
    application ends; the pairs are made whenever the result is read.
    """
    near, far = _dealt(starts, edges, own, BLOCK, _block, "a {a}, b {b}, distance long")
    return near.unionByName(far) if far is not None else near


def linked(starts: DataFrame, edges: DataFrame, own: bool = False) -> DataFrame:
    """a, b of ``reached``, which without the distances takes far less."""
    near, far = _dealt(starts, edges, own, WIDE, _listed, "a array<{a}>, b {b}")
    pairs = near.select(F.explode("a").alias("a"), "b")
    return pairs.unionByName(far.select("a", "b")) if far is not None else pairs


def counts(starts: DataFrame, edges: DataFrame, own: bool = False) -> DataFrame:
    """a, n: how many nodes ``reached`` joins to each start that has any or, with some of its nodes among the edges, none. No pair is made."""
    near, far = _dealt(starts, edges, own, WIDE, _summed, "a {a}, n long")
    found = near.unionByName(far.groupBy("a").agg(F.count("*").alias("n"))) if far is not None else near
    return found.groupBy("a").agg(F.sum("n").alias("n"))


def transitive(edges: DataFrame) -> DataFrame:
    """a, b, distance: every pair that a path of ``edges`` (a, b) joins, with the length of the shortest.

    A node that lies on a cycle reaches itself. Nulls and repeated edges add nothing.
    """
    return reached(edges.select(F.col("a").alias("s"), "a"), edges)


def _rounds(edges: DataFrame) -> DataFrame:
    """``transitive`` of distinct edges between nodes, by joins."""
    with Workspace(edges.sparkSession, "rounds") as space:
        known = space.store(edges.withColumn("distance", F.lit(1).cast("long")))
        found, reach = [known], 1
        while True:
            every = reduce(DataFrame.unionByName, found)
            frontier = found[-1].where(F.col("distance") == reach)
            steps = frontier.select("a", F.col("b").alias("mid")).join(every.select(F.col("a").alias("mid"), "b", (F.col("distance") + reach).alias("distance")), "mid")
            fresh = space.store(steps.groupBy("a", "b").agg(F.min("distance").alias("distance")).join(every.select("a", "b"), ["a", "b"], "left_anti"))
            if fresh.isEmpty():
                return space.keep(every)
            found.append(fresh)
            reach *= 2


def _iri(s: str, p: str, o: str) -> list:
    """Columns of a triple between names."""
    return [F.col(s).alias("s"), F.lit(p).alias("p"), F.col(o).alias("o"), F.when(F.col(o).startswith("_:"), "blank").otherwise("iri").alias("o_kind"), *[F.lit(None).cast("string").alias(c) for c in ("o_datatype", "o_lang")]]


def _pairs(triples: DataFrame, p: str) -> DataFrame:
    return triples.where((F.col("p") == p) & (F.col("o_kind") != "literal")).select(F.col("s").alias("a"), F.col("o").alias("b"))


def closure(triples: DataFrame, subclass: str, kind: str) -> DataFrame:
    """``kind`` triples with those that follow from the hierarchy of ``subclass``, to any depth.

    A subject's classes come from one walk that begins at all it is told, told ones
    included, so they are a set as they come and only what is told is made one.
    """
    told = triples.where(F.col("p") == kind).select(*COLUMNS).dropDuplicates(COLUMNS)
    pairs = _pairs(triples, subclass).where("a is not null and b is not null")
    found = linked(told.where("o_kind != 'literal'").select("s", F.col("o").alias("a")), pairs, own=True)
    return _alone(told, pairs).unionByName(found.select(*_iri("a", kind, "b")))


def _alone(told: DataFrame, pairs: DataFrame) -> DataFrame:
    """The triples of ``told`` whose object is no class of ``pairs``."""
    classes = pairs.select(F.explode(F.array("a", "b")).alias("o")).distinct().withColumn("_class", F.lit(True))
    return told.join(classes, "o", "left").where("_class is null or o_kind = 'literal' or s is null").select(*COLUMNS)


def type_counts(triples: DataFrame, subclass: str, kind: str) -> DataFrame:
    """s, n: the number of ``closure``'s triples of each subject, with none of them made.

    Subjects that are told the same classes have the same ones by inference, so a
    set of classes is counted for once, and its number joined to its subjects.
    """
    told = triples.where(F.col("p") == kind).select(*COLUMNS).dropDuplicates(COLUMNS)
    pairs = _pairs(triples, subclass).where("a is not null and b is not null")
    with Workspace(triples.sparkSession, "types") as space:
        subjects = told.where("o_kind != 'literal' and s is not null and o is not null").groupBy("s").agg(F.array_sort(F.collect_set("o")).alias("told"))
        subjects = space.keep(subjects)
        sets = space.keep(subjects.groupBy("told").agg(F.min("s").alias("s")))
        found = counts(sets.select("s", F.explode("told").alias("a")), pairs, own=True)
        found = space.keep(sets.join(found.withColumnRenamed("a", "s"), "s").select("told", "n"))
    by_class = join_counted(subjects, found, ["told"]).select("s", "n")
    others = _alone(told, pairs).groupBy("s").agg(F.count("*").alias("n"))
    return by_class.unionByName(others).groupBy("s").agg(F.sum("n").alias("n"))


def _order(pairs: DataFrame) -> DataFrame:
    """a, b of ``transitive``, stored, for what reads them more than once."""
    with Workspace(pairs.sparkSession, "order") as space:
        return space.keep(linked(pairs.select(F.col("a").alias("s"), "a"), pairs))


def _superproperties(triples: DataFrame) -> DataFrame:
    """a, b: the closure of the subproperty pairs, with those told by way of a subproperty of "subproperty" itself."""
    pairs = _pairs(triples, SUBPROPERTY)
    while True:
        above = _order(pairs)
        ways = above.where(F.col("b") == SUBPROPERTY).select(F.col("a").alias("p"))
        if ways.isEmpty():
            return above
        told = join_counted(triples.where("o_kind != 'literal'").select("s", "p", "o"), ways, ["p"]).select(F.col("s").alias("a"), F.col("o").alias("b"))
        more = told.join(above, ["a", "b"], "left_anti")
        if more.isEmpty():
            return above
        pairs = above.unionByName(more.distinct())


def rdfs(triples: DataFrame) -> DataFrame:
    """The graph with all that RDFS has follow from it by subproperty, domain, range, subclass and type, as a set.

    Superproperties come first, as to be of a domain or range, or a subclass, may
    itself be said by a subproperty; then domains and ranges give types, and types
    their classes' superclasses. Schema tables are counted and broadcast where
    they are small; else they meet the triples in a shuffle that splits uneven keys.
    """
    told = triples.select(*COLUMNS).where("s is not null and p is not null and o is not null")
    above = _superproperties(told)
    with Workspace(triples.sparkSession, "rdfs") as space:
        lifted = join_counted(told, above.select(F.col("a").alias("p"), F.col("b").alias("q")), ["p"]).select("s", F.col("q").alias("p"), "o", "o_kind", "o_datatype", "o_lang")
        every = space.store(told.unionByName(lifted).dropDuplicates(COLUMNS))
        classes = lambda p: _pairs(every, p).select(F.col("a").alias("p"), F.col("b").alias("class")).distinct()
        by_domain = join_counted(every.select("s", "p"), classes(DOMAIN), ["p"]).select("s", "class")
        by_range = join_counted(every.where("o_kind != 'literal'").select(F.col("o").alias("s"), "p"), classes(RANGE), ["p"]).select("s", "class")
        types = space.store(_pairs(every, TYPE).toDF("s", "class").unionByName(by_domain).unionByName(by_range).distinct())
        order = _order(_pairs(every, SUBCLASS))
        higher = join_counted(types.select("s", F.col("class").alias("a")), order, ["a"]).select("s", F.col("b").alias("class"))
        entailed = types.unionByName(higher).select(*_iri("s", TYPE, "class")).unionByName(order.select(*_iri("a", SUBCLASS, "b"))).unionByName(above.select(*_iri("a", SUBPROPERTY, "b")))
        return space.keep(every.unionByName(entailed).dropDuplicates(COLUMNS))
