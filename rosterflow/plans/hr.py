"""HR tables: employees, payroll, team sheets, holidays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from rosterflow.operators.enrich import (
    assign_split,
    contract_type,
    employees_with_teams,
    payroll_with_company,
    scale_columns,
    with_company_name,
)
from rosterflow.operators.frames import distinct_teams, drop_columns, rename_columns
from rosterflow.sinks.files import stage_export
from rosterflow.sources.grid import TEAM_SHEET_PREFIX, union_team_sheets

# Private fields of the employee records.
PRIVATE_FIELDS = [
    "termination_reason",
    "state",
    "termination_observations",
    "bank_number",
    "postal_code",
    "swift_bic",
    "timeoff_manager_id",
    "social_security_number",
    "timeoff_policy_id",
    "phone_number",
    "address_line_1",
    "address_line_2",
    "updated_at",
    "identifier_type",
    "teams_id",
]
# Contract fields that the payroll table leaves out.
PAYROLL_UNUSED_FIELDS = [
    "has_payroll",
    "salary_frequency",
    "es_has_teleworking_contract",
    "es_cotization_group",
    "es_contract_observations",
    "es_job_description",
    "es_working_day_type_id",
    "es_education_level_id",
    "es_professional_category_id",
    "fr_employee_type",
    "fr_forfait_jours",
    "fr_jours_par_an",
    "fr_coefficient",
    "fr_contract_type_id",
    "fr_level_id",
    "fr_step_id",
    "fr_mutual_id",
    "fr_professional_category_id",
    "fr_work_type_id",
    "de_contract_type_id",
]
EMPLOYEE_NAMES = {"created_at": "start_date", "terminated_on": "end_date", "identifier": "national_id"}


def employees_table(
    employees: DataFrame, teams: DataFrame, split: DataFrame | None, companies: Mapping[int, str] | DataFrame
) -> DataFrame:
    """Employees with their team, company name and split; one row per team of theirs.

    Without a ``split`` table the split is left out.
    """
    public = drop_columns(employees, [*PRIVATE_FIELDS, "city", "country", "company_id", "team_ids"])
    staff = with_company_name(rename_columns(public, EMPLOYEE_NAMES), companies, "legal_entity_id")
    placed = employees_with_teams(staff, teams)
    return placed if split is None else assign_split(placed, split)


def payroll_table(
    contracts: DataFrame,
    employees: DataFrame,
    companies: Mapping[int, str] | DataFrame,
    rules: Sequence[Sequence],
    strict: bool = True,
) -> DataFrame:
    """Contract versions in units, with employee, company name and contract type.

    ``strict`` refuses records that lack one of the fields to leave out.
    """
    lean = drop_columns(contracts, PAYROLL_UNUSED_FIELDS, strict)
    scaled = scale_columns(lean, ["working_hours", "salary_amount"])
    joined = payroll_with_company(scaled, employees, ["first_name", "last_name", "legal_entity_id"])
    named = with_company_name(joined, companies, "legal_entity_id")
    return contract_type(named, rules, code="es_contract_type_id").drop("es_contract_type_id")


def team_sheet_table(
    grids: DataFrame, employees: DataFrame, columns: Sequence[str], prefix: str = TEAM_SHEET_PREFIX
) -> DataFrame:
    """The sheets of all teams that have employees, as one table."""
    return union_team_sheets(grids, distinct_teams(employees), columns, prefix)


def holiday_export(holidays: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Stage the holidays for the warehouse."""
    stage_export(holidays, path, fmt)
