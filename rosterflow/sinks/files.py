"""File exports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rosterflow.operators.frames import known_team_rows


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def stage_export(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Files on an object-store path for a warehouse to load."""
    df.write.mode("overwrite").format(fmt).save(path)


def route_by_team(df: DataFrame, teams: DataFrame, path: str, column: str = "team_name") -> None:
    """One directory per known team.

    Rebalancing by team gives each team few, evenly sized files, and lets adaptive
    execution split a team that holds most rows.
    """
    known = known_team_rows(df, teams, column)
    known.hint("rebalance", column).write.mode("overwrite").partitionBy(column).parquet(path)
