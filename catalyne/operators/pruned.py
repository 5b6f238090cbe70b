"""The best rows by a costly score, of which a cheap bound is known."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the first round for each row that is wanted, how much larger a next round is, and the most rounds before all that
#: is left is scored.
FIRST, GROWTH, ROUNDS = 4, 8, 4


def best_by_bound(rows: DataFrame, bound: Column, score: Callable[[DataFrame], DataFrame], wanted: int, tie: str, name: str) -> DataFrame:
    """The wanted rows with the largest score, ties by a column: just those that scoring every row would give.

    bound: never less than a row's score. score: adds the column name to rows; it is asked for few of them. Rounds take rows
    in falling order of the bound, until the last of the wanted scores beats every bound that is left; rows whose bound is
    below that score can't be among the wanted. Another round is made while it is small beside what is left; that is then
    scored by all tasks, not by one. A null bound comes last. Scores and bounds are compared as doubles, with room for rounding.
    """
    bounded = rows.withColumn("_bound", F.coalesce(bound.cast("double"), F.lit(0.0)) + 1e-9)
    take, floor = FIRST * wanted, None
    for _ in range(ROUNDS):
        first = score(bounded.orderBy(F.desc("_bound"), tie).limit(take))
        scores = first.select(name).orderBy(F.desc(name)).limit(wanted).collect()
        if len(scores) < wanted:
            break  # there are no more rows than these
        floor = scores[-1][name]
        left = bounded.where(F.col("_bound") >= floor).count()
        take *= GROWTH
        if left <= 2 * take:
            break
    open_ = bounded if floor is None else bounded.where(F.col("_bound") >= floor)
    return score(open_).orderBy(F.desc(name), tie).limit(wanted).drop("_bound")
