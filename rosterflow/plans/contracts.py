"""Contract jobs: the latest-contract difference and the rows missing from team sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import date_text, end_date_or_sentinel, null_text, parse_amount, parse_date
from rosterflow.model import FIELD_CELLS, STAFF_COLUMNS, contains
from rosterflow.operators.contracts import append_new_staff, latest_contract, missing_contract_rows
from rosterflow.operators.diff import field_diff_each
from rosterflow.operators.ordinal import append_rows
from rosterflow.operators.patch import build_field_patches

# Fields kept apart, and fields that are compared and patched.
STATE_FIELDS = ["id", "job_title", "split", "team", "sub_team", "manager", "profile", "seniority"]
DIFF_FIELDS = [
    "end_date",
    "status",
    "split",
    "team",
    "sub_team",
    "job_title",
    "manager",
    "fix_salary",
    "bonus",
    "profile",
    "seniority",
]
PATCHED_FIELDS = DIFF_FIELDS[:9]


def division_scope(division: str) -> Column:
    """Rows of a division that decide the latest start: no dated or pending end."""
    return contains("division", division) & ~contains("end_date", "pe") & ~contains("end_date", "20")


def latest_contract_state(
    master: DataFrame,
    scope: Column,
    keys: Sequence[str] = ("full_name", "company"),
    state: Sequence[str] = STATE_FIELDS,
    legacy_scope: bool = True,
) -> DataFrame:
    """Latest contract per key from roster text.

    Dates and amounts are parsed before any maximum is taken; the text of the
    largest amount is kept beside it, as ``fix_salary_text`` and ``bonus_text``.
    """
    group = list(dict.fromkeys([*keys, *state]))
    amounts = [
        F.struct(parse_amount(F.col(c)).alias("amount"), F.col(c).alias("text")).alias(c)
        for c in ("fix_salary", "bonus")
    ]
    parsed = master.select(
        *group,
        "status",
        scope.alias("__scope"),
        parse_date(F.col("start_date")).alias("start_date"),
        end_date_or_sentinel(F.col("end_date")).alias("end_date"),
        *amounts,
    )
    latest = latest_contract(
        parsed,
        keys,
        group,
        "start_date",
        "end_date",
        largest=["fix_salary", "bonus"],
        scope=F.col("__scope"),
        legacy_scope=legacy_scope,
        null_is_open=False,
    )
    return latest.select(
        *group,
        "status",
        "end_date",
        date_text(F.col("end_date")).alias("end_date_text"),
        *[F.col(c)["amount"].alias(c) for c in ("fix_salary", "bonus")],
        *[F.col(c)["text"].alias(f"{c}_text") for c in ("fix_salary", "bonus")],
    )


def latest_contract_diff(
    master: DataFrame,
    sheet: DataFrame,
    division: str = "Solar",
    keys: Sequence[str] = ("full_name", "company"),
    latest_keys: Sequence[str] | None = None,
    state: Sequence[str] = STATE_FIELDS,
    fields: Sequence[str] = DIFF_FIELDS,
    legacy_scope: bool = True,
    nulls: str = "safe",
) -> DataFrame:
    """Latest contracts against the sheet: one boolean per field, with both values.

    ``keys`` pair a contract with the sheet; the latest start is taken per
    ``latest_keys`` (the same by default; (id, company) is the other form in use).
    Dates are compared as dates and amounts as amounts, a blank being null.
    """
    by = latest_keys or keys
    group = [*dict.fromkeys([*keys, *state])]
    latest = latest_contract_state(master, division_scope(division), by, group, legacy_scope)
    rows = sheet.withColumns(
        {
            "end_date": parse_date(F.col("end_date")),
            "fix_salary": parse_amount(F.col("fix_salary")),
            "bonus": parse_amount(F.col("bonus")),
        }
    )
    carry = ["sheet_row", "end_date_text", "fix_salary_text", "bonus_text"]
    return field_diff_each(latest, rows, keys, fields, nulls, carry)


def append_staff(
    master: DataFrame,
    sheet: DataFrame,
    division: str = "Solar",
    on: Sequence[str] = ("full_name", "company"),
    columns: Sequence[str] = STAFF_COLUMNS,
    order: str = "row_ord",
    sheet_row: str = "sheet_row",
) -> DataFrame:
    """New rows for a staff sheet, numbered after its last one: ``columns`` and ``sheet_row``.

    A division's master rows that are active or joining and whose name and company the
    sheet lacks, each different one once, in the order of their first copies.  Columns that the master
    lacks are null, so each value stands under its own name.
    """
    held = [c for c in columns if c in master.columns]
    fresh = append_new_staff(master, sheet, list(on), scope=contains("division", division), columns=held, order=order)
    numbered = append_rows(sheet, fresh.withColumnRenamed(order, "__order"), "__order", sheet_row)
    return numbered.select(*[F.col(c) if c in held else null_text().alias(c) for c in columns], sheet_row)


def latest_contract_patches(diff: DataFrame, fields: Sequence[str] = PATCHED_FIELDS) -> DataFrame:
    """One cell patch per differing field of :func:`latest_contract_diff`."""
    values = {f: f"{f}_text" if f in ("end_date", "fix_salary", "bonus") else f"{f}_master" for f in fields}
    return build_field_patches(diff, values, FIELD_CELLS)


def team_contract_rows(
    employees: DataFrame, master: DataFrame, contracts: DataFrame, existing: DataFrame
) -> DataFrame:
    """Rows the team sheets lack, ready for ``route_by_team``."""
    rows = missing_contract_rows(
        employees,
        contracts,
        existing,
        ["first_name", "last_name", "email", "team_name"],
        master=master,
    )
    return rows.select(
        "id", "first_name", "last_name", "email", "job_title", "manager", "team_name", "sub_team"
    )
