"""Basic graph patterns over a triples table, compiled to joins.

Each pattern is a filtered scan: constants become filters on s, p or o, which
reach the files (in a ``sources.triple_table`` a bound predicate also prunes
directories, and patterns that share their subject join without a shuffle).
Patterns are joined on the variables they share, in an order that stays
connected: with statistics of the graph the one whose intermediate results are
estimated smallest, else from the most bound pattern on. Patterns that share no
variable with the rest are refused unless the query asks for their product.
Catalyst chooses the join strategies.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import inference
from . import joins

Pattern = tuple[str, str, str]


@dataclass
class Query:
    """Variables to return, patterns, values bound beforehand, and whether results are a set.

    A term that begins with ``?`` is a variable, ``"..."`` a literal, anything
    else an IRI or blank name. product: groups of patterns that share no variable
    may be combined, each row with each.
    """

    select: list[str]
    patterns: list[Pattern]
    bindings: dict[str, str] = field(default_factory=dict)
    distinct: bool = True
    filters: list[Column] = field(default_factory=list)
    product: bool = False


def is_variable(term: str) -> bool:
    return term.startswith("?")


def variables(pattern: Pattern) -> list[str]:
    return list(dict.fromkeys(t[1:] for t in pattern if is_variable(t)))


def _scan(triples: DataFrame, pattern: Pattern, bindings: dict[str, str]) -> DataFrame:
    """The matches of one pattern, a column a variable."""
    rows, place = triples, {}
    for column, term in zip("spo", pattern):
        if not is_variable(term):
            if term.startswith('"'):
                rows = rows.where((F.col(column) == term[1:-1]) & (F.col("o_kind") == "literal"))
            else:
                rows = rows.where(F.col(column) == term)
                if column == "o":
                    rows = rows.where(F.col("o_kind") != "literal")
            continue
        name = term[1:]
        if name in bindings:
            rows = rows.where(F.col(column) == bindings[name])
        if name in place:
            rows = rows.where(F.col(column) == F.col(place[name]))
        place.setdefault(name, column)
    return rows.select(*[F.col(c).alias(v) for v, c in place.items()])


@dataclass
class PredicateStatistics:
    """Triples of a predicate, its subjects and objects, the most of one, and its common objects with their counts."""

    n: int
    subjects: int
    objects: int
    most_of_subject: int
    most_of_object: int
    common: dict[str, int] = field(default_factory=dict)


#: Predicates whose statistics the driver takes; a share of a predicate's triples that makes an object a common one.
MOST_PREDICATES, COMMON_SHARE = 20_000, 0.01
#: Patterns up to which every order is weighed; beyond, the cheapest next one is taken.
SEARCHED = 10


def statistics(triples: DataFrame) -> dict[str, PredicateStatistics]:
    """Statistics of each predicate, for ``compile_query``: a few rows a predicate reach the driver.

    Two counts with partial states, by predicate and subject and by predicate and
    object; of the latter no more than 1 / COMMON_SHARE a predicate are common.
    """
    facts = triples.select("s", "p", "o")
    by_object = facts.groupBy("p", "o").agg(F.count("*").alias("n"))
    of_subject = facts.groupBy("p", "s").agg(F.count("*").alias("n")).groupBy("p").agg(F.sum("n").alias("n"), F.count("*").alias("subjects"), F.max("n").alias("most_of_subject"))
    of_object = by_object.groupBy("p").agg(F.count("*").alias("objects"), F.max("n").alias("most_of_object"))
    rows = of_subject.join(of_object, "p").limit(MOST_PREDICATES + 1).collect()
    if len(rows) > MOST_PREDICATES:
        raise ValueError(f"more than {MOST_PREDICATES} predicates; order the patterns without statistics")
    found = {r["p"]: PredicateStatistics(r["n"], r["subjects"], r["objects"], r["most_of_subject"], r["most_of_object"]) for r in rows}
    common = by_object.join(F.broadcast(of_subject.select("p", F.col("n").alias("all"))), "p").where(F.col("n") >= COMMON_SHARE * F.col("all"))
    for r in common.collect():
        found[r["p"]].common[r["o"]] = r["n"]
    return found


@dataclass
class Estimate:
    """Rows of an intermediate result, and distinct values of its variables."""

    rows: float
    distinct: dict[str, float]


def estimate(pattern: Pattern, bindings: dict[str, str], known: dict[str, PredicateStatistics]) -> Estimate:
    """What a pattern alone is expected to match."""
    value = lambda t: bindings.get(t[1:]) if is_variable(t) else t.strip('"')
    s, p, o = map(value, pattern)
    parts = [known[p]] if p in known else [] if p is not None else list(known.values())
    rows = subjects = objects = 0.0
    for x in parts:
        n = float(x.n)
        if o is not None:
            rest = max(0, x.n - sum(x.common.values())) / max(1, x.objects - len(x.common))
            n = float(x.common.get(o, rest))
        if s is not None:
            n /= max(1, x.subjects)
        rows += n
        subjects += min(x.subjects, n)
        objects += min(x.objects, n)
    counts = {"s": subjects, "p": float(len(parts)), "o": objects}
    return Estimate(rows, {t[1:]: max(1.0, min(counts[c], rows)) for c, t in zip("spo", pattern) if is_variable(t)})


def joined(a: Estimate, b: Estimate) -> Estimate:
    """The join of two results on the variables they share, as if values met at random."""
    rows = a.rows * b.rows
    for v in a.distinct.keys() & b.distinct.keys():
        rows /= max(a.distinct[v], b.distinct[v])
    every = {v: min(a.distinct.get(v, rows), b.distinct.get(v, rows)) for v in a.distinct | b.distinct}
    return Estimate(rows, {v: max(1.0, min(n, rows)) for v, n in every.items()})


def ordered(patterns: list[Pattern], bindings: dict[str, str], known: dict[str, PredicateStatistics] | None = None) -> list[Pattern]:
    """The order of joins: of least estimated rows in between, or without statistics the most bound pattern first."""
    if known is not None and len(patterns) > 1:
        return _cheapest([(p, estimate(p, bindings, known)) for p in patterns])
    bound = lambda p: sum(not is_variable(t) or t[1:] in bindings for t in p)
    left, out, seen = list(patterns), [], set()
    while left:
        linked = [p for p in left if seen & set(variables(p))] or left
        best = max(linked, key=bound)
        left.remove(best)
        out.append(best)
        seen |= set(variables(best))
    return out


def _cheapest(weighed: list[tuple[Pattern, Estimate]]) -> list[Pattern]:
    """Left-deep orders by dynamic programming over sets of patterns; those without a shared variable come last."""
    n = len(weighed)
    linked = lambda i, members: any(weighed[i][1].distinct.keys() & weighed[j][1].distinct.keys() for j in members)
    best: dict[frozenset[int], tuple[float, Estimate, tuple[int, ...]]] = {frozenset([i]): (weighed[i][1].rows, weighed[i][1], (i,)) for i in range(n)}
    if n > SEARCHED:
        state = min(best.values(), key=lambda x: x[0])
        while len(state[2]) < n:
            left = [i for i in range(n) if i not in state[2]]
            near = [i for i in left if linked(i, state[2])] or left
            steps = [(state[0] + (e := joined(state[1], weighed[i][1])).rows, e, (*state[2], i)) for i in near]
            state = min(steps, key=lambda x: x[0])
        return [weighed[i][0] for i in state[2]]
    for size in range(2, n + 1):
        for members in map(frozenset, combinations(range(n), size)):
            last = [i for i in members if linked(i, members - {i})] or list(members)
            options = []
            for i in last:
                cost, before, order = best[members - {i}]
                after = joined(before, weighed[i][1])
                options.append((cost + after.rows, after, (*order, i)))
            best[members] = min(options, key=lambda x: (x[0], x[2]))
    return [weighed[i][0] for i in best[frozenset(range(n))][2]]


def compile_query(triples: DataFrame, query: Query, known: dict[str, PredicateStatistics] | None = None, heavy: int = joins.HEAVY_ROWS) -> DataFrame:
    """The query's results, a column for each selected variable (without its mark).

    known: ``statistics`` of the graph. They order the joins, and where a
    predicate has ``heavy`` or more triples of one subject or object, the joins on
    it deal such values over several tasks.
    """
    wanted = [v.lstrip("?") for v in query.select]
    named = {v for p in query.patterns for v in variables(p)}
    if missing := [v for v in [*wanted, *(b.lstrip("?") for b in query.bindings)] if v not in named]:
        raise ValueError(f"not in any pattern: {missing}")
    bindings = {k.lstrip("?"): v for k, v in query.bindings.items()}
    result: DataFrame | None = None
    for pattern in ordered(query.patterns, bindings, known):
        rows = _scan(triples, pattern, bindings)
        exists = not rows.columns
        if exists:
            rows = rows.select(F.lit(1).alias("_any")).limit(1)
        if result is None:
            result = rows
            continue
        shared = [c for c in rows.columns if c in result.columns]
        if shared and known is not None and _uneven(pattern, shared, known, heavy):
            result = joins.join_heavy(result, rows, shared, heavy)
        elif shared:
            result = result.join(rows, shared)
        elif exists or result.columns == ["_any"] or query.product:
            result = result.crossJoin(rows)
        else:
            raise ValueError(f"{pattern} shares no variable with the other patterns; product=True combines them all the same")
    for condition in query.filters:
        result = result.where(condition)
    result = result.select(*wanted)
    return result.distinct() if query.distinct else result


def _uneven(pattern: Pattern, shared: list[str], known: dict[str, PredicateStatistics], heavy: int) -> bool:
    """Whether a value of a shared variable may have ``heavy`` triples in the pattern's predicate."""
    of = known.get(pattern[1])
    places = {"s": of.most_of_subject, "o": of.most_of_object} if of else {}
    return any(places.get(c, 0) >= heavy for c, t in zip("spo", pattern) if is_variable(t) and t[1:] in shared)


def closure(triples: DataFrame, subclass: str, kind: str) -> DataFrame:
    """``kind`` triples with those that follow from a subclass hierarchy, to any depth (``operators.inference``)."""
    return inference.closure(triples, subclass, kind)
