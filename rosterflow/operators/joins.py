"""Join helpers: lookups and left joins with a hot right side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to a dimension table.

    Without a hint: Spark broadcasts the lookup if its measured bytes allow it, and
    else shuffles both sides, where adaptive execution splits hot keys of ``df``.
    """
    return df.join(lookup, on, "left")


def anti_join(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Left rows whose key is not on the right; ``on`` may map left to right names.

    A null key matches nothing, on either side.  The right keys are made distinct,
    so a key that fills the right side is one row in the join.  The equality is
    null-safe (no right key is null any more) so that the distinct keys are shuffled
    once more, directly below the join: only then can adaptive execution split a key
    that fills the left side.
    """
    names = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    keys = right.select(*[F.col(r).alias(f"__{l}") for l, r in names.items()]).dropna().distinct()
    same = reduce(lambda a, b: a & b, (left[name].eqNullSafe(keys[f"__{name}"]) for name in names))
    return left.join(keys, same, "left_anti")


def left_join_hot_right(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join for a right side whose keys may repeat without bound.

    Adaptive execution can split the right side of an inner join, not of a left
    join.  So the matches come from an inner join, and the rows without a match
    from an anti join.
    """
    on = list(on)
    matched = left.join(right, on, "inner")
    return matched.unionByName(anti_join(left, right, on), allowMissingColumns=True)
