"""Majority vote over an array of predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def majority_of(votes: Column, members: int) -> Column:
    """Most frequent non-null entry of `votes`; a tie goes to the earlier entry.

    0.0 when every entry is null. Most rows are near-unanimous, so the first
    entry is tried alone: if it has more than half of all votes, it wins.
    `votes` should be a column, not an expression, as it is read several times.
    """
    first = votes[0]
    best = F.array_max(
        F.transform(
            votes,
            lambda vote, place: F.when(
                vote.isNotNull(),
                F.struct((-_others(votes, vote)).alias("others"), (-place).alias("place"), vote.alias("choice")),
            ),
        )
    )
    counted = F.coalesce(best["choice"], F.lit(0.0))
    return F.when(2 * _others(votes, first) < members, first).otherwise(counted)


def _others(votes: Column, vote: Column) -> Column:
    """Entries that differ from the vote; null for a null vote."""
    return F.array_size(F.array_remove(votes, vote))
