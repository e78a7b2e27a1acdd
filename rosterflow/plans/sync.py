"""The roster sync as one job."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import null_text
from rosterflow.model import Division
from rosterflow.operators.frames import stack_frames
from rosterflow.operators.ordinal import append_rows
from rosterflow.operators.patch import build_patches
from rosterflow.operators.roster import division_filter, project_roster, roster_sync_plan
from rosterflow.session import materialize


@dataclass(frozen=True)
class RosterSync:
    """``plan``: flags per master row; ``inserts``: new sheet rows with their row
    numbers; ``patches``: cells to write; ``new_sheet``: the sheet with all of it."""

    plan: DataFrame
    inserts: DataFrame
    patches: DataFrame
    new_sheet: DataFrame


def roster_sync(
    master: DataFrame,
    sheet: DataFrame,
    division: Division,
    order: str = "row_ord",
    sheet_order: str = "sheet_row",
    reuse: str | None = None,
    **numbering: int,
) -> RosterSync:
    """Bring a division's sheet up to date with the master.

    New rows are written by column name; sheet columns that the master lacks stay
    empty in them.  All four frames derive from one plan, and the new sheet reads it
    more than once.  ``reuse='table'`` writes the plan to the shared folder, so that
    its joins run once even when executors are lost; ``reuse='persist'`` caches it.
    """
    plan = roster_sync_plan(master, sheet, division, order, sheet_order, **numbering)
    if reuse == "persist":
        plan = plan.persist()
    elif reuse == "table":
        plan = materialize(plan, "roster-plan")
    elif reuse is not None:
        raise ValueError(f"reuse must be None, 'persist' or 'table', not {reuse!r}")

    patches = build_patches(plan, division.groups, sheet_order)
    new = plan.filter(F.col("insert_") == 1)
    columns = [c for c in sheet.columns if c != sheet_order]
    cells = [F.col(c) if c in master.columns else null_text().alias(c) for c in columns]
    rows = append_rows(sheet, new.select(*cells, F.col(order).alias("__order")), "__order", sheet_order)
    inserts = rows.select(*sheet.columns)

    new_sheet = stack_frames(_updated(sheet, plan, division, sheet_order), inserts)
    return RosterSync(plan, inserts, patches, new_sheet)


def _updated(sheet: DataFrame, plan: DataFrame, division: Division, sheet_order: str) -> DataFrame:
    """The sheet with the cells that the plan's flags name, which has a row for a sheet row at most.

    The same cells as ``patches`` lists, taken from the plan as it is instead of from
    cells folded to rows again.
    """
    flagged = {}
    for group in division.groups:
        for name in group.fields:
            if name in sheet.columns:
                test = F.col(group.name) == 1
                flagged[name] = flagged[name] | test if name in flagged else test
    if not flagged:
        return sheet
    updates = plan.filter(reduce(lambda a, b: a | b, flagged.values())).select(
        F.col(sheet_order).alias("__row"),
        *[F.when(test, F.struct(F.col(name).cast("string").alias("value"))).alias(f"__{name}") for name, test in flagged.items()],
    )
    joined = sheet.join(updates, sheet[sheet_order] == updates["__row"], "left")
    new = {
        name: F.when(F.col(f"__{name}").isNotNull(), F.col(f"__{name}.value").cast(sheet.schema[name].dataType)).otherwise(F.col(name))
        for name in flagged
    }
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in sheet.columns])


def master_snapshot(master: DataFrame, division: Division) -> DataFrame:
    """The division's master rows as they stand, each once, ready for ``publish_snapshot``."""
    return project_roster(division_filter(master, division))
