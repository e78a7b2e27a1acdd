"""Field comparison in three null logics."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MODES = ("sql", "legacy", "safe")


def differs(left: Column, right: Column, nulls: str = "safe") -> Column:
    """True where two fields differ.

    ``sql``: null on either side is unknown, and a filter or ``when`` drops it.
    ``legacy``: null on either side counts as different, even on both.
    ``safe``: two nulls are equal, one null is a difference.
    """
    if nulls == "sql":
        return left != right
    if nulls == "legacy":
        return F.coalesce(left != right, F.lit(True))
    if nulls == "safe":
        return ~left.eqNullSafe(right)
    raise ValueError(f"nulls must be one of {NULL_MODES}, not {nulls!r}")


def any_differs(pairs: Iterable[tuple[Column, Column]], nulls: str = "safe") -> Column:
    """True where at least one pair differs."""
    return reduce(lambda a, b: a | b, (differs(left, right, nulls) for left, right in pairs))
