"""Small frame operators: renaming, dropping, stacking, filtering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Drop columns; ``strict`` refuses when one of them is absent."""
    if strict:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"columns to drop are absent: {missing}")
    return df.drop(*columns)


def columns_between(df: DataFrame, first: int = 0, last: int | None = None) -> DataFrame:
    """Columns by position, ``first`` included and ``last`` excluded."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns[first:last]])


def stack_frames(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def team_rows(df: DataFrame, team: str, column: str = "team_name") -> DataFrame:
    """Rows of one team; the value is a literal, never pasted into query text."""
    return df.filter(F.col(column) == F.lit(team))


def with_team(df: DataFrame, column: str = "team_name") -> DataFrame:
    """Rows that have a team."""
    return df.filter(F.col(column).isNotNull())


def distinct_teams(df: DataFrame, column: str = "team_name") -> DataFrame:
    """The teams in use, once each."""
    return with_team(df, column).select(column).distinct()


def known_team_rows(df: DataFrame, teams: DataFrame, column: str = "team_name") -> DataFrame:
    """Rows whose team is in ``teams``; the distinct teams are broadcast after a size check."""
    known = teams.select(F.col(teams.columns[0]).alias(column)).distinct()
    return df.join(known, column, "left_semi")
