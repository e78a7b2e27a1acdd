"""Column names, divisions and update groups, all as data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels of the master roster, in sheet order, and the
# snake_case name each one gets at ingest.
ROSTER_LABELS: dict[str, str] = {
    "Gender": "gender",
    "Ubicación": "location",
    "Id": "id",
    "Id Req > DNI/NIE": "national_id",
    "Apellidos, Nombre": "full_name",
    "Job title": "job_title",
    "Supply/Solar/Tech": "division",
    "% EM": "pct_em",
    "% Solar": "pct_solar",
    "Split": "split",
    "Sociedad": "company",
    "Status": "status",
    "Tipo de contrato": "contract_kind",
    "New position or backfill": "position_kind",
    "Profile": "profile",
    "Seniority": "seniority",
    "Team": "team",
    "Sub Team": "sub_team",
    "CECO Num": "cost_center",
    "CECO FINANZAS": "cost_center_finance",
    "MANAGER": "manager",
    "Start date": "start_date",
    "End date": "end_date",
    "Fecha del cambio": "change_date",
    "31/12/2022": "year_end",
    "FTE según jornada": "fte_hours",
    "FTE según fecha alta + jornada": "fte_hired",
    "Jornada (%)": "workday_pct",
    "Fix Salary": "fix_salary",
    "Bonus": "bonus",
    "Dietas/Guardias centro control": "allowances",
    "KM": "mileage",
    "Total (Salary + Bonus)": "total_pay",
}

ROSTER_COLUMNS: list[str] = list(ROSTER_LABELS.values())

# How many columns are loaded from the master sheet and from each division's sheet.
SHEET_WIDTHS: dict[str, int] = {"master": 100, "tech": 26, "sales": 32, "corporate": 28, "solar": 32}

# What a new row of a staff sheet holds, in sheet order; the sheet has one column more than
# the master, ``q``, and lacks the two shares.
STAFF_COLUMNS: list[str] = [
    "gender", "location", "id", "national_id", "full_name", "job_title", "division", "split", "company", "status",
    "contract_kind", "position_kind", "profile", "seniority", "q", "team", "sub_team", "cost_center",
    "cost_center_finance", "manager", "start_date", "end_date", "change_date", "year_end", "fte_hours", "fte_hired",
    "workday_pct", "fix_salary", "bonus", "allowances", "mileage", "total_pay",
]

# The text forms the sheets use.
SHEET_DATE_FORMAT = "dd/MM/yyyy"
SHEET_DATE_PATTERN = "d/M/yyyy"  # reads both 1/2/2022 and 01/02/2022
SHEET_DATE_SHAPE = r"^\d{1,2}/\d{1,2}/\d{4}$"
OPEN_END_SENTINEL = "2040-01-01"
ACTIVE_MARK = "Activo"
ACTIVE_STATUS = "00 - Activo"
JOINING_MARK = "Join"


@dataclass(frozen=True)
class UpdateGroup:
    """Fields that are compared together and written together.

    ``compare`` decides whether the group is flagged; ``write`` is what a patch
    then carries, and may hold more fields.  ``cells`` gives the sheet column
    letter of each written field, left to right.
    """

    name: str
    compare: Sequence[str]
    write: Sequence[str] = ()
    cells: Mapping[str, str] = field(default_factory=dict)

    @property
    def fields(self) -> list[str]:
        return list(self.write or self.compare)

    @property
    def first_col(self) -> str | None:
        return next(iter(self.cells.values()), None)

    @property
    def last_col(self) -> str | None:
        letters = list(self.cells.values())
        return letters[-1] if letters else None


@dataclass(frozen=True)
class Division:
    """A division: which master rows are its own, and how its sheet is updated."""

    name: str
    predicate: Callable[[], Column]
    groups: Sequence[UpdateGroup]
    key: str = "full_name"

    @property
    def compared(self) -> list[str]:
        seen: dict[str, None] = {}
        for group in self.groups:
            seen.update(dict.fromkeys(group.compare))
        return list(seen)


def sync_groups(**cells: Mapping[str, str]) -> list[UpdateGroup]:
    """The five update groups of a roster sheet, laid out by ``cells``."""
    return [
        UpdateGroup(
            "update_1",
            ["job_title", "split", "status"],
            ["job_title", "division", "split", "company", "status"],
            cells.get("update_1", {}),
        ),
        UpdateGroup(
            "update_2", ["profile", "seniority", "team", "sub_team"], cells=cells.get("update_2", {})
        ),
        UpdateGroup("update_manager", ["manager"], cells=cells.get("update_manager", {})),
        UpdateGroup("update_end_date", ["end_date"], cells=cells.get("update_end_date", {})),
        UpdateGroup("update_salaries", ["fix_salary", "bonus"], cells=cells.get("update_salaries", {})),
    ]


# Column letters of the division sheets.
TECH_CELLS = {
    "update_1": {"job_title": "E", "division": "F", "split": "G", "company": "H", "status": "I"},
    "update_2": {"profile": "L", "seniority": "M", "team": "N", "sub_team": "O"},
    "update_manager": {"manager": "R"},
    "update_end_date": {"end_date": "T"},
    "update_salaries": {"fix_salary": "W", "bonus": "X"},
}
WIDE_CELLS = {
    "update_1": {"job_title": "F", "division": "G", "split": "H", "company": "I", "status": "J"},
    "update_2": {"profile": "M", "seniority": "N", "team": "P", "sub_team": "Q"},
    "update_manager": {"manager": "T"},
    "update_end_date": {"end_date": "V"},
    "update_salaries": {"fix_salary": "AB", "bonus": "AC"},
}
CORPORATE_CELLS = {**WIDE_CELLS, "update_salaries": {"fix_salary": "Z", "bonus": "AA"}}
FIELD_CELLS = {
    "status": "J",
    "end_date": "V",
    "split": "H",
    "team": "P",
    "sub_team": "Q",
    "job_title": "F",
    "manager": "T",
    "fix_salary": "Y",
    "bonus": "Z",
    "profile": "M",
    "seniority": "N",
}


def contains(name: str, text: str) -> Column:
    """SQL ``LIKE '%text%'``: case-sensitive, null in, null out."""
    return F.col(name).contains(text)


DIVISIONS: dict[str, Division] = {
    "tech": Division("tech", lambda: contains("division", "Technology"), sync_groups(**TECH_CELLS)),
    "solar": Division("solar", lambda: contains("division", "Solar"), sync_groups(**WIDE_CELLS)),
    "sales": Division(
        "sales",
        lambda: (
            contains("division", "Supply") & ~contains("end_date", "20") & (F.col("team") == "Sales")
        ),
        sync_groups(**WIDE_CELLS),
    ),
    "corporate": Division(
        "corporate",
        lambda: (
            contains("division", "Supply")
            & ~contains("team", "Sales")
            & ~contains("team", "People")
            & ~contains("job_title", "Ventas")
            & ~contains("job_title", "Founder")
            & ~contains("job_title", "Talent")
            & ~contains("end_date", "p")
            & ~contains("end_date", "TB")
        ),
        sync_groups(**CORPORATE_CELLS),
    ),
}
