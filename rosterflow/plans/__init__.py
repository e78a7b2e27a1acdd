from rosterflow.plans.contracts import append_staff, latest_contract_diff, team_contract_rows
from rosterflow.plans.hr import employees_table, holiday_export, payroll_table, team_sheet_table
from rosterflow.plans.report import roster_diff_report
from rosterflow.plans.sync import RosterSync, master_snapshot, roster_sync
from rosterflow.plans.talent import talent_matrix_table

__all__ = [
    "RosterSync",
    "append_staff",
    "employees_table",
    "holiday_export",
    "latest_contract_diff",
    "master_snapshot",
    "payroll_table",
    "roster_diff_report",
    "roster_sync",
    "talent_matrix_table",
    "team_contract_rows",
    "team_sheet_table",
]
