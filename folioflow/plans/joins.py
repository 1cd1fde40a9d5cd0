"""Joins with a side that may be small, and joins whose keys may be very uneven."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a counted side is broadcast.
SMALL_ROWS = 50_000
#: Rows of a key that make it heavy, but at least one of MOST_HEAVY parts of a side; ways that its rows are dealt.
HEAVY_ROWS, MOST_HEAVY, WAYS = 200_000, 5_000, 32


def join_counted(rows: DataFrame, side: DataFrame, on: list[str], how: str = "inner", most: int = SMALL_ROWS) -> DataFrame:
    """``rows`` with a ``side`` that is cheap to count: broadcast up to ``most`` rows, else shuffled."""
    few = side.limit(most + 1).count() <= most
    return rows.join(F.broadcast(side) if few else side, on, how)


def heavy_keys(left: DataFrame, right: DataFrame, on: list[str], heavy: int = HEAVY_ROWS) -> DataFrame | None:
    """The heavy keys of either table and ``_left``: whether the left one has more rows of them; None where there is none.

    No more than 2 x MOST_HEAVY, by what heavy means, so they can be broadcast.
    """
    given = F.lit(True)
    for c in on:
        given = given & F.col(c).isNotNull()
    counts = []
    for n, side in enumerate((left, right)):
        least = max(heavy, side.count() // MOST_HEAVY)
        counts.append(side.where(given).groupBy(*on).agg(F.count("*").alias(f"_n{n}")).where(F.col(f"_n{n}") >= least))
    more = F.coalesce("_n0", F.lit(0)) >= F.coalesce("_n1", F.lit(0))
    found = counts[0].join(counts[1], on, "full").select(*on, more.alias("_left"))
    keys = found.collect()
    return left.sparkSession.createDataFrame(keys, found.schema) if keys else None


def join_heavy(left: DataFrame, right: DataFrame, on: list[str], heavy: int = HEAVY_ROWS, ways: int = WAYS) -> DataFrame:
    """The inner join of two tables, with heavy keys of either dealt over ``ways`` tasks.

    A count by key, with partial counts before its shuffle, finds them; without
    any the join is a plain one. Of a heavy key, the rows of the side that has more
    are dealt by a salt, and the other side's are copied to every salt; all other
    keys are hashed as usual. The result is the same in every case.
    """
    keys = heavy_keys(left, right, on, heavy)
    if keys is None:
        return left.join(right, on)
    told = [side.join(F.broadcast(keys), on, "left") for side in (left, right)]
    light = [side.where("_left is null").drop("_left") for side in told]
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(ways)).cast("int")
    every = F.sequence(F.lit(0), F.lit(ways - 1))
    salted = []
    for side, heavier in zip(told, (F.col("_left"), ~F.col("_left"))):
        salts = F.when(heavier, F.array(dealt)).otherwise(every)
        salted.append(side.where("_left is not null").withColumn("_salt", F.explode(salts)).drop("_left"))
    return light[0].join(light[1], on).unionByName(salted[0].join(salted[1], [*on, "_salt"]).drop("_salt"))
