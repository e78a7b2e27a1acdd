"""The difference report as one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from rosterflow.operators.diff import roster_diff
from rosterflow.operators.roster import active_filter

# The compared fields, in the order of the report.
REPORT_FIELDS = [
    "job_title",
    "sub_team",
    "team",
    "division",
    "status",
    "contract_kind",
    "profile",
    "seniority",
    "manager",
]
REPORT_FIELDS_BY_ID = ["job_title", "sub_team", "team", "split"]


def roster_diff_report(
    master: DataFrame,
    sheet: DataFrame,
    division: str,
    keys: Sequence[str] = ("full_name",),
    fields: Sequence[str] = REPORT_FIELDS,
    scope: Column | None = None,
    nulls: str = "legacy",
    active_sheet: bool = True,
) -> DataFrame:
    """Active staff whose sheet fields differ from the master's.

    ``scope`` narrows the master, for instance to a division.  For the report by
    (id, company) pass those keys, ``REPORT_FIELDS_BY_ID`` and ``active_sheet=False``.
    """
    left = active_filter(master)
    right = active_filter(sheet, exact=True) if active_sheet else sheet
    return roster_diff(left if scope is None else left.filter(scope), right, keys, fields, division, nulls)
