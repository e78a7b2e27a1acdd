"""Roster reconciliation: who is new on a sheet, and what has changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.compare import any_differs
from rosterflow.functions.text import filled
from rosterflow.model import ACTIVE_MARK, ACTIVE_STATUS, ROSTER_COLUMNS, Division, UpdateGroup
from rosterflow.operators.ordinal import BLOCK_ROWS, HOT_ROWS, nth_occurrence_join


def project_roster(df: DataFrame, columns: Sequence[str] = ROSTER_COLUMNS, keep: Sequence[str] = ()) -> DataFrame:
    """The roster's own columns, in order, plus ``keep`` (such as ``row_ord``)."""
    return df.select(*columns, *keep)


def division_filter(df: DataFrame, division: Division) -> DataFrame:
    """Master rows of a division that carry a name.

    The rules are SQL ``LIKE``: a null operand drops the row.  Run this on cell
    text as delivered, before blanks are turned into nulls.
    """
    return df.filter(division.predicate() & filled(F.col(division.key)))


def active_filter(
    df: DataFrame, status: str = "status", id_col: str = "id", exact: bool = False
) -> DataFrame:
    """Active staff: on the master a status mark and a filled id, on a sheet (``exact``) one status."""
    if exact:
        return df.filter(F.col(status) == ACTIVE_STATUS)
    return df.filter(F.col(status).contains(ACTIVE_MARK) & filled(F.col(id_col)))


def change_flags(
    df: DataFrame, groups: Sequence[UpdateGroup], partner: str = "n_sheet", suffix: str = "_sheet"
) -> list[Column]:
    """0/1 flags: ``insert_`` where there is no partner, one flag per update group.

    A null on either side of a field gives 0, so a row without a partner never
    carries an update flag.
    """
    flags = [F.when(F.col(partner).isNull(), 1).otherwise(0).alias("insert_")]
    for group in groups:
        pairs = [(F.col(f), F.col(f + suffix)) for f in group.compare]
        flags.append(F.when(any_differs(pairs, nulls="sql"), 1).otherwise(0).alias(group.name))
    return flags


def roster_sync_plan(
    master: DataFrame,
    sheet: DataFrame,
    division: Division,
    order: str = "row_ord",
    sheet_order: str = "sheet_row",
    hot_rows: int | None = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per master row of the division: its partner's row number and its flags.

    The sheet side is cut to the key and the compared fields before the shuffle.
    """
    own = division_filter(master, division)
    partners = sheet.select(division.key, sheet_order, *division.compared)
    joined = nth_occurrence_join(
        own,
        partners,
        division.key,
        order,
        sheet_order=sheet_order,
        hot_rows=hot_rows,
        block_rows=block_rows,
        null_keys="drop",  # none is left after division_filter
    )
    return joined.select(*own.columns, "n", sheet_order, *change_flags(joined, division.groups))


def split_by_flag(plan: DataFrame, flags: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per flag; a row may be in several."""
    return {flag: plan.filter(F.col(flag) == 1) for flag in flags}
