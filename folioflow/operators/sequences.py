"""Shapes of arrays: what may follow what, as a rule over a column.

A shape is built from ``one`` (an element that passes a test), ``cat``, ``alt``,
``some`` (one or more), ``many`` (none or more) and ``maybe``. It is compiled to a
state machine without empty moves: a bit for each ``one`` of the shape, the bits
that may begin, may end, and may follow each other (Glushkov's construction).
``aggregate`` folds an array with it: the state is the set of bits that the
elements so far may have ended in, so alternatives need no backtracking, and a
test on the next element is a built-in expression. Elements may hold arrays of
their own; a test of them is again a shape.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .validate import Rule

#: Tests that a shape may have: bits of a long, without its sign.
MOST_TESTS = 62


@dataclass(frozen=True)
class Shape:
    """A compiled part: its tests, whether it may be empty, and bits that may begin, end and follow."""

    tests: tuple[Callable[[Column], Column], ...] = ()
    empty: bool = True
    first: frozenset[int] = frozenset()
    last: frozenset[int] = frozenset()
    follow: frozenset[tuple[int, int]] = frozenset()

    def moved(self, by: int) -> Shape:
        """The same with its bits ``by`` further up."""
        up = lambda bits: frozenset(b + by for b in bits)
        return Shape(self.tests, self.empty, up(self.first), up(self.last), frozenset((a + by, b + by) for a, b in self.follow))


def one(test: Callable[[Column], Column]) -> Shape:
    """An element that passes ``test``; a null answer is no."""
    return Shape((test,), False, frozenset([0]), frozenset([0]))


def cat(*parts: Shape) -> Shape:
    """The parts one after another."""
    whole = Shape()
    for part in parts:
        right = part.moved(len(whole.tests))
        whole = Shape(
            whole.tests + right.tests, whole.empty and right.empty, whole.first | (right.first if whole.empty else frozenset()), right.last | (whole.last if right.empty else frozenset()),
            whole.follow | right.follow | {(a, b) for a in whole.last for b in right.first},
        )
    return whole


def alt(*parts: Shape) -> Shape:
    """Any of the parts."""
    whole = Shape(empty=False)
    for part in parts:
        right = part.moved(len(whole.tests))
        whole = Shape(whole.tests + right.tests, whole.empty or right.empty, whole.first | right.first, whole.last | right.last, whole.follow | right.follow)
    return whole


def some(part: Shape) -> Shape:
    """The part once or more."""
    return Shape(part.tests, part.empty, part.first, part.last, part.follow | {(a, b) for a in part.last for b in part.first})


def maybe(part: Shape) -> Shape:
    """The part or nothing."""
    return Shape(part.tests, True, part.first, part.last, part.follow)


def many(part: Shape) -> Shape:
    """The part any number of times."""
    return maybe(some(part))


def of(test: Callable[[Column], Column]) -> Shape:
    """Elements that all pass ``test``."""
    return many(one(test))


def _bits(of_: frozenset[int] | set[int]) -> Column:
    return F.lit(sum(1 << b for b in of_)).cast("long")


def _fold(array: Column, shape: Shape) -> Column:
    """struct<state, at, failed>: the state after all elements, their number, and the first that nothing allows (from 0)."""
    if len(shape.tests) > MOST_TESTS:
        raise ValueError(f"a shape has at most {MOST_TESTS} tests")
    begin = 1 << len(shape.tests)  # the state before any element
    none = F.lit(0).cast("long")

    def step(held: Column, element: Column) -> Column:
        state = none
        for bit, test in enumerate(shape.tests):
            before = sum(1 << a for a, b in shape.follow if b == bit) | (begin if bit in shape.first else 0)
            fits = (held["state"].bitwiseAND(F.lit(before).cast("long")) != 0) & F.coalesce(test(element), F.lit(False))
            state = state.bitwiseOR(F.when(fits, F.lit(1 << bit).cast("long")).otherwise(none))
        lost = held["failed"].isNull() & (state == 0)
        return F.struct(state.alias("state"), (held["at"] + 1).alias("at"), F.when(lost, held["at"]).otherwise(held["failed"]).alias("failed"))

    start = F.struct(F.lit(begin).cast("long").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("failed"))
    return F.aggregate(array, start, step)


def fits(array: Column, shape: Shape) -> Column:
    """Whether the array has the shape; null for a null array."""
    ends = set(shape.last) | ({len(shape.tests)} if shape.empty else set())
    return F.when(array.isNotNull(), _fold(array, shape)["state"].bitwiseAND(_bits(ends)) != 0)


def first_misfit(array: Column, shape: Shape) -> Column:
    """The index of the first element that nothing allows where it stands; the array's size if it ends too early; null if it fits."""
    return F.when(array.isNotNull() & ~fits(array, shape), F.coalesce(_fold(array, shape)["failed"], F.size(array)))


def sequence(name: str, shape: Shape) -> Rule:
    """The rule that array ``name`` has the shape; a null array breaks it."""
    return f"{name}: of a shape", fits(F.col(name), shape)


def document_shape(text: Callable[[Column], Column] = lambda s: F.length(s["sentence"]) > 0) -> Shape:
    """Paragraphs of ``sentences.document``: each with sentences, one or more, that pass ``text``."""
    return of(lambda p: fits(p["sentences"], some(one(text))))
