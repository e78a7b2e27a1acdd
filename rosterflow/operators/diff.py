"""Difference reports between a master roster and a sheet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.compare import any_differs, differs
from rosterflow.functions.text import filled


def _paired(
    master: DataFrame,
    sheet: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    division: str,
    carry: Sequence[str],
) -> DataFrame:
    """Inner join on filled keys, with the compared fields as suffixed pairs.

    A key that repeats multiplies on both sides, as the report is defined; both
    sides are filtered and pruned first, and the join feeds no further shuffle, so
    adaptive execution can split a hot key on either side.
    """
    every_key = reduce(lambda a, b: a & b, (filled(F.col(k)) for k in keys))
    from_master = [c for c in carry if c in master.columns]
    from_sheet = [c for c in carry if c in sheet.columns and c not in from_master]
    left = master.filter(every_key).select(
        *keys, *from_master, *[F.col(f).alias(f"{f}_master") for f in fields]
    )
    right = sheet.filter(every_key).select(
        *keys, *from_sheet, *[F.col(f).alias(f"{f}_{division}") for f in fields]
    )
    return left.join(right, list(keys), "inner")


def field_diff(fields: Sequence[str], division: str = "sheet", nulls: str = "legacy") -> Column:
    """True where any of the suffixed pairs differs."""
    return any_differs([(F.col(f"{f}_master"), F.col(f"{f}_{division}")) for f in fields], nulls)


def roster_diff(
    master: DataFrame,
    sheet: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    division: str = "sheet",
    nulls: str = "legacy",
    carry: Sequence[str] = ("sheet_row",),
) -> DataFrame:
    """Rows whose fields differ, as ``<field>_master`` / ``<field>_<division>`` pairs."""
    pairs = _paired(master, sheet, keys, fields, division, carry)
    named = [n for f in fields for n in (f"{f}_master", f"{f}_{division}")]
    return pairs.filter(field_diff(fields, division, nulls)).select(*keys, *named, *carry)


def field_diff_each(
    master: DataFrame,
    sheet: DataFrame,
    keys: Sequence[str],
    fields: Mapping[str, str] | Sequence[str],
    nulls: str = "safe",
    carry: Sequence[str] = ("sheet_row",),
) -> DataFrame:
    """One boolean ``differences_<label>`` per field; ``fields`` may map field to label."""
    labels = dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}
    pairs = _paired(master, sheet, keys, list(labels), "sheet", carry)
    flags = [
        differs(F.col(f"{f}_master"), F.col(f"{f}_sheet"), nulls).alias(f"differences_{label}")
        for f, label in labels.items()
    ]
    return pairs.select(*pairs.columns, *flags)
