from rosterflow.sources.grid import load_sheet, promote_header, roster_from_grid, union_team_sheets
from rosterflow.sources.records import (
    CONTRACT_VERSIONS_SCHEMA,
    EMPLOYEES_SCHEMA,
    SUPPLEMENTS_SCHEMA,
    TEAMS_SCHEMA,
    read_json_records,
    read_talent_scores,
)
from rosterflow.sources.tables import (
    CANDIDATE_COLUMNS,
    JOB_COLUMNS,
    jdbc_options,
    read_recruiting,
    read_table,
    read_with_row_ord,
)

__all__ = [
    "CANDIDATE_COLUMNS",
    "CONTRACT_VERSIONS_SCHEMA",
    "EMPLOYEES_SCHEMA",
    "JOB_COLUMNS",
    "SUPPLEMENTS_SCHEMA",
    "TEAMS_SCHEMA",
    "jdbc_options",
    "load_sheet",
    "promote_header",
    "read_json_records",
    "read_recruiting",
    "read_table",
    "read_talent_scores",
    "read_with_row_ord",
    "roster_from_grid",
    "union_team_sheets",
]
