"""Latest contracts, new staff, and employees without a sheet row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import cast_key
from rosterflow.operators.joins import anti_join
from rosterflow.model import ACTIVE_MARK, JOINING_MARK, OPEN_END_SENTINEL

_LATEST = "__latest"


def latest_start(
    df: DataFrame, keys: Sequence[str], start: str, scope: Column | None = None, out: str = "latest_start"
) -> DataFrame:
    """Latest start per key, over the rows in ``scope``."""
    rows = df if scope is None else df.filter(scope)
    return rows.groupBy(*keys).agg(F.max(start).alias(out))


def rows_at_latest_start(
    df: DataFrame, keys: Sequence[str], start: str, scope: Column | None = None
) -> DataFrame:
    """Rows at their key's latest start; ties stay.

    The maximum comes from an aggregation that combines before the shuffle, and the
    join includes the start itself, so no task has to hold all rows of a key.
    """
    return df.join(latest_start(df, keys, start, scope, start), [*keys, start], "left_semi")


def latest_by_rank(df: DataFrame, key: str, day: str) -> DataFrame:
    """Rows of rank 1 per key by ``day`` descending; ties stay, null days rank last."""
    latest = df.groupBy(F.col(key).alias("__key")).agg(F.max(day).alias(_LATEST))
    on = df[key].eqNullSafe(latest["__key"]) & df[day].eqNullSafe(latest[_LATEST])
    return df.join(latest, on, "left_semi")


def latest_contract(
    df: DataFrame,
    keys: Sequence[str],
    group: Sequence[str],
    start: str,
    end: str,
    status: str = "status",
    largest: Sequence[str] = (),
    scope: Column | None = None,
    legacy_scope: bool = True,
    null_is_open: bool = True,
    sentinel: str = OPEN_END_SENTINEL,
) -> DataFrame:
    """State of each key at its latest start, one row per distinct ``group``.

    ``group`` holds the keys and the fields kept apart; the lowest status, the
    largest of ``largest`` and the latest end are taken per group.  An open end, the
    sentinel date, counts as the latest and comes out null; a null end counts as
    open unless ``null_is_open`` is off, which then ignores it.  ``scope`` limits the rows that decide the latest
    start; with ``legacy_scope`` the rows reported are not limited by it.

    The semi join comes first, so that only rows at a latest start are grouped by all
    of ``group``; a key with very many of those is split by adaptive execution, and
    its copies combine before the second shuffle.
    """
    far = F.lit(sentinel).cast("date")
    source = df if legacy_scope or scope is None else df.filter(scope)
    rows = source.join(latest_start(df, keys, start, scope, start), [*keys, start], "left_semi")
    last_end = F.max(F.coalesce(F.col(end), far) if null_is_open else F.col(end))
    return rows.groupBy(*group).agg(
        F.min(status).alias(status), F.nullif(last_end, far).alias(end), *[F.max(c).alias(c) for c in largest]
    )


def append_new_staff(
    master: DataFrame,
    sheet: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    marks: Sequence[str] = (ACTIVE_MARK, JOINING_MARK),
    status: str = "status",
    scope: Column | None = None,
    columns: Sequence[str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Distinct master rows with a wanted status that the sheet lacks.

    An anti join, so a null key on the sheet removes nothing.  With ``order`` (a
    unique BIGINT) each row keeps that of its first copy, by which ``append_rows``
    can number them.
    """
    wanted = F.lit(False)
    for mark in marks:
        wanted = wanted | F.col(status).contains(mark)
    rows = master.filter(wanted if scope is None else scope & wanted)
    names = [c for c in columns or rows.columns if c != order]
    rows = rows.groupBy(*names).agg(F.min(order).alias(order)) if order else rows.select(*names).distinct()
    return anti_join(rows, sheet, on)


def absent_employees(
    employees: DataFrame, existing: DataFrame, id_col: str = "id", existing_id: str = "id"
) -> DataFrame:
    """Employees whose id is not in ``existing``; ids are compared at full length, as text."""
    present = existing.select(cast_key(F.col(existing_id)).alias("__id")).distinct()
    return employees.join(present, cast_key(employees[id_col]) == present["__id"], "left_anti")


def with_active_master(
    employees: DataFrame,
    master: DataFrame,
    details: Sequence[str] = ("sub_team", "manager"),
    on: str = "national_id",
    team: str = "team_name",
) -> DataFrame:
    """Employees in a team, with ``details`` of their active master rows.

    The master is cut to distinct details per id first: further copies of a row
    would only give rows that the caller folds again.
    """
    active = master.filter(F.col("status").contains(ACTIVE_MARK)).select(on, *details).distinct()
    return employees.filter(F.col(team).isNotNull()).join(active, on)


def missing_contract_rows(
    employees: DataFrame,
    contracts: DataFrame,
    existing: DataFrame,
    employee_columns: Sequence[str],
    master: DataFrame | None = None,
    details: Sequence[str] = ("sub_team", "manager"),
    contract_columns: Sequence[str] = ("job_title",),
    id_col: str = "id",
    contract_id: str = "employee_id",
    contract_day: str = "effective_on",
    existing_id: str = "id",
) -> DataFrame:
    """Distinct employees with their latest contract who have no row in ``existing``.

    With ``master``, only employees in a team that have an active master row, along
    with its ``details``.  The anti join comes first.  Contract versions are ranked
    and then made distinct, so that the join sees each of them once per employee.
    """
    staff = absent_employees(employees, existing, id_col, existing_id)
    kept = list(dict.fromkeys([id_col, *employee_columns]))
    if master is not None:
        staff = with_active_master(staff, master, details)
        kept += list(details)
    versions = contracts.select(
        F.col(contract_id).alias(id_col), F.col(contract_day).alias("__day"), *contract_columns
    )
    latest = latest_by_rank(versions, id_col, "__day").drop("__day").distinct()
    return staff.select(*kept).join(latest, id_col).select(*kept, *contract_columns).distinct()
