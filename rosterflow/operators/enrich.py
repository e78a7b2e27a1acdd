"""Employee, team and payroll enrichment."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.mapping import first_match, map_values, shadowed_rules
from rosterflow.functions.text import scale_hundredths
from rosterflow.operators.joins import left_join_hot_right, lookup_join


def explode_members(
    teams: DataFrame, members: str = "employee_ids", name: str = "name", out: str = "employee_id"
) -> DataFrame:
    """One row per (team, member); a team without members gives one row with a null member."""
    ids = F.col(members).cast("array<bigint>")
    return teams.select(F.col(name).alias("team_name"), F.explode_outer(ids).alias(out))


def employees_with_teams(
    employees: DataFrame,
    teams: DataFrame,
    id_col: str = "id",
    members: str = "employee_ids",
    name: str = "name",
) -> DataFrame:
    """Employees with ``team_name``: one row per team of theirs, or one with null."""
    pairs = explode_members(teams, members, name, id_col).filter(F.col(id_col).isNotNull())
    return left_join_hot_right(employees, pairs, [id_col])


def assign_split(employees: DataFrame, split: DataFrame, team: str = "team_name") -> DataFrame:
    """Add the ``split`` of the employee's team, looked up by team name."""
    lookup = split.select(F.col("team").alias(team), "split")
    return lookup_join(employees, lookup, team)


def with_company_name(
    df: DataFrame, companies: Mapping | DataFrame, id_col: str = "company_id", out: str = "company_name"
) -> DataFrame:
    """Replace the company id by its name; ids without a name stay, as text.

    ``companies`` is a small map, or a frame of (id, name) with one row for each id,
    however many those are.
    """
    if isinstance(companies, DataFrame):
        number, name = companies.columns[:2]
        lookup = companies.select(F.col(number).alias(id_col), F.col(name).cast("string").alias("__company"))
        named = lookup_join(df, lookup, id_col)
        columns = [F.col(f"`{c}`") for c in df.columns if c not in (id_col, out)]
        return named.select(*columns, F.coalesce("__company", F.col(id_col).cast("string")).alias(out))
    return df.withColumn(out, map_values(F.col(id_col), companies, "keep")).drop(
        *([id_col] if id_col != out else [])
    )


def scale_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Integer hundredths to decimals, in place."""
    return df.withColumns({c: scale_hundredths(F.col(c)) for c in columns})


def payroll_with_company(
    contracts: DataFrame,
    employees: DataFrame,
    columns: Sequence[str] = ("company_id",),
    on: str = "employee_id",
    id_col: str = "id",
) -> DataFrame:
    """Contract versions with ``columns`` of their employee; contracts without one stay.

    Only the key and the wanted columns of the employees are shuffled.  The side
    that may be hot is the left one, which adaptive execution can split.
    """
    staff = employees.select(F.col(id_col).alias(on), *columns)
    return contracts.join(staff, on, "left")


def contract_type(
    df: DataFrame,
    rules: Sequence[Sequence],
    company: str = "company_name",
    code: str = "contract_code",
    out: str = "contract_type",
) -> DataFrame:
    """Contract type by (company, code, type) rules: the first match wins, no match gives null.

    Rules that an earlier one hides are reported as a warning.
    """
    hidden = shadowed_rules(rules)
    if hidden:
        warnings.warn(f"rules that can never match: {hidden}", stacklevel=2)
    return df.withColumn(out, first_match([F.col(company), F.col(code)], rules))


def contract_supplements(
    contracts: DataFrame, supplements: DataFrame, on: str = "employee_id", amount: str = "amount_in_cents"
) -> DataFrame:
    """Contract versions with their employee's supplements as ``bonus``, in units."""
    bonus = supplements.select(on, scale_hundredths(F.col(amount)).alias("bonus"))
    return left_join_hot_right(contracts, bonus, [on])
