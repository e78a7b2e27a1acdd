"""Roster reconciliation, differences and patches."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.registry import query
from acceptance.standins import (
    DIVISION_SQL,
    NARROW_CTE,
    SHEET_CTE,
    URGENT,
    WIDE_CTE,
    division_cte,
    narrow_master,
    narrow_sheet,
    table,
    wide_master,
    wide_sheet,
)
from rosterflow.functions.text import filled
from rosterflow.model import DIVISIONS, ROSTER_COLUMNS, contains
from rosterflow.operators.diff import field_diff, field_diff_each as diff_each, roster_diff as diff_rows
from rosterflow.operators.ordinal import dense_ordinal, nth_occurrence_join as pair_rows, occurrence_number
from rosterflow.operators.patch import apply_patches as patched, build_patches as patches_of
from rosterflow.operators.roster import (
    active_filter as active,
    division_filter as own_rows,
    project_roster as projected,
    roster_sync_plan as sync_plan,
    split_by_flag,
)
from rosterflow.plans.report import REPORT_FIELDS, REPORT_FIELDS_BY_ID, roster_diff_report as report
from rosterflow.plans.sync import master_snapshot as snapshot, roster_sync as sync
from rosterflow.session import materialize

FLAGS = ["insert_", "update_1", "update_2", "update_manager", "update_salaries"]
TEXT_GROUPS = URGENT.groups[:3]


def _narrow_plan(spark, sf_dir):
    return sync_plan(narrow_master(spark, sf_dir), narrow_sheet(spark, sf_dir), URGENT, "ord")


@query(
    f"WITH {NARROW_CTE} SELECT emp_name, CAST(n AS BIGINT) AS n, sheet_row, insert_, update_1, update_2, "
    "update_manager, update_salaries FROM plan"
)
def roster_sync_plan(spark, sf_dir):
    return _narrow_plan(spark, sf_dir).select("emp_name", "n", "sheet_row", *FLAGS)


@query(
    f"""WITH {NARROW_CTE}
SELECT sheet_row, 'job_title' AS field, job_title AS value FROM plan WHERE update_1 = 1
UNION ALL SELECT sheet_row, 'status' AS field, status AS value FROM plan WHERE update_1 = 1
UNION ALL SELECT sheet_row, 'team' AS field, team AS value FROM plan WHERE update_2 = 1
UNION ALL SELECT sheet_row, 'manager' AS field, manager AS value FROM plan WHERE update_manager = 1"""
)
def build_patches(spark, sf_dir):
    return patches_of(_narrow_plan(spark, sf_dir), TEXT_GROUPS).drop("group")


@query(
    f"""WITH {NARROW_CTE}
SELECT s.sheet_row, s.name_tl AS emp_name,
  CASE WHEN p.update_1 = 1 THEN p.job_title ELSE s.job_title_tl END AS job_title,
  CASE WHEN p.update_1 = 1 THEN p.status ELSE s.status_tl END AS status,
  CASE WHEN p.update_2 = 1 THEN p.team ELSE s.team_tl END AS team,
  CASE WHEN p.update_manager = 1 THEN p.manager ELSE s.manager_tl END AS manager,
  CASE WHEN p.update_salaries = 1 THEN p.fix_salary ELSE s.fix_salary_tl END AS fix_salary
FROM sheet s LEFT JOIN plan p ON s.sheet_row = p.sheet_row"""
)
def apply_patches(spark, sf_dir):
    patches = patches_of(_narrow_plan(spark, sf_dir), URGENT.groups)
    return patched(narrow_sheet(spark, sf_dir), patches, ["job_title", "status", "team", "manager", "fix_salary"])


@query(
    f"""WITH {NARROW_CTE}
SELECT (SELECT max(sheet_row) FROM sheet) + row_number() OVER (ORDER BY ord) AS sheet_row, emp_name, job_title,
  status, team, manager FROM plan WHERE insert_ = 1"""
)
def roster_sync_inserts(spark, sf_dir):
    result = sync(narrow_master(spark, sf_dir), narrow_sheet(spark, sf_dir), URGENT, "ord", reuse="table")
    return result.inserts.select("sheet_row", "emp_name", "job_title", "status", "team", "manager")


@query(
    f"""WITH {NARROW_CTE}
SELECT s.sheet_row, s.name_tl AS emp_name,
  CASE WHEN p.update_1 = 1 THEN p.job_title ELSE s.job_title_tl END AS job_title,
  CASE WHEN p.update_1 = 1 THEN p.status ELSE s.status_tl END AS status,
  CASE WHEN p.update_2 = 1 THEN p.team ELSE s.team_tl END AS team,
  CASE WHEN p.update_manager = 1 THEN p.manager ELSE s.manager_tl END AS manager,
  CASE WHEN p.update_salaries = 1 THEN p.fix_salary ELSE s.fix_salary_tl END AS fix_salary
FROM sheet s LEFT JOIN plan p ON s.sheet_row = p.sheet_row
UNION ALL
SELECT (SELECT max(sheet_row) FROM sheet) + row_number() OVER (ORDER BY ord), emp_name, job_title, status, team,
  manager, fix_salary FROM plan WHERE insert_ = 1"""
)
def roster_sync(spark, sf_dir):
    return sync(narrow_master(spark, sf_dir), narrow_sheet(spark, sf_dir), URGENT, "ord", reuse="table").new_sheet


@query(
    f"""WITH {NARROW_CTE}
SELECT emp_name, ord, sheet_row, job_title AS job_title_master, job_title_tl AS job_title_sheet,
  manager AS manager_master, manager_tl AS manager_sheet
FROM master JOIN sheet ON emp_name = name_tl
WHERE status = 'O' AND status_tl = 'O'
  AND (coalesce(job_title <> job_title_tl, true) OR coalesce(manager <> manager_tl, true))"""
)
def roster_diff(spark, sf_dir):
    master = own_rows(narrow_master(spark, sf_dir), URGENT).filter("status = 'O'")
    sheet = narrow_sheet(spark, sf_dir).filter("status = 'O'")
    return diff_rows(master, sheet, ["emp_name"], ["job_title", "manager"], carry=["ord", "sheet_row"])


@query(
    f"""WITH {NARROW_CTE}
SELECT emp_name, ord, sheet_row, job_title IS DISTINCT FROM job_title_tl AS differences_jobtitle,
  manager IS DISTINCT FROM manager_tl AS differences_manager, status IS DISTINCT FROM status_tl AS differences_status
FROM master JOIN sheet ON emp_name = name_tl"""
)
def field_diff_each(spark, sf_dir):
    fields = {"job_title": "jobtitle", "manager": "manager", "status": "status"}
    master, sheet = own_rows(narrow_master(spark, sf_dir), URGENT), narrow_sheet(spark, sf_dir)
    diff = diff_each(master, sheet, ["emp_name"], fields, carry=["ord", "sheet_row"])
    return diff.select("emp_name", "ord", "sheet_row", *[f"differences_{v}" for v in fields.values()])


@query(
    f"""WITH {NARROW_CTE}
SELECT m.ord, m.n, h.sheet_row, h.manager_tl AS manager_sheet
FROM (SELECT *, row_number() OVER (PARTITION BY emp_name ORDER BY ord) AS n FROM all_master) m
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY name_tl ORDER BY sheet_row) AS n_tl FROM sheet) h
ON m.emp_name = h.name_tl AND m.n = h.n_tl"""
)
def nth_occurrence_join(spark, sf_dir):
    joined = pair_rows(narrow_master(spark, sf_dir), narrow_sheet(spark, sf_dir), "emp_name", "ord")
    return joined.select("ord", "n", "sheet_row", "manager_sheet")


@query(
    f"WITH {SHEET_CTE} SELECT sheet_row, row_number() OVER (PARTITION BY full_name ORDER BY sheet_row) AS n FROM sheet",
    name="occurrence_number",
)
def _occurrence_number(spark, sf_dir):
    return occurrence_number(wide_sheet(spark, sf_dir), "full_name", "sheet_row").select("sheet_row", "n")


@query(
    f"WITH {SHEET_CTE} SELECT sheet_row, row_number() OVER (PARTITION BY full_name ORDER BY sheet_row) AS n FROM sheet",
    name="occurrence_number_hot_keys",
)
def _occurrence_number_hot(spark, sf_dir):
    """The same numbering with the limits set low, so that the blank and the null name are split."""
    rows = wide_sheet(spark, sf_dir)
    return occurrence_number(rows, "full_name", "sheet_row", hot_rows=100, block_rows=500).select("sheet_row", "n")


@query(
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS place FROM orders",
    name="dense_ordinal",
)
def _dense_ordinal(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (-F.col("o_orderkey")).alias("back"))
    return dense_ordinal(orders, "back", "place", start=1, block_rows=4_000).drop("back")


@query(
    """SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey - 500 END AS ord,
  row_number() OVER (ORDER BY CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey - 500 END NULLS FIRST) AS place FROM orders"""
)
def dense_ordinal_null_order(spark, sf_dir):
    """Rows without an order come first; negative orders; many blocks."""
    orders = table(spark, sf_dir, "orders").selectExpr("CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey - 500 END AS ord")
    return dense_ordinal(orders, "ord", "place", start=1, block_rows=4_000)


@query(
    """WITH m AS (SELECT CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS name,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey - 500 END AS ord FROM orders),
  n AS (SELECT name, ord, row_number() OVER (PARTITION BY name ORDER BY ord NULLS FIRST) AS n FROM m),
  s AS (SELECT o_orderpriority AS name, o_orderkey + 2 AS sheet_row,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS n FROM orders WHERE o_orderpriority NOT LIKE '4%')
SELECT n.name, n.ord, n.n, s.sheet_row FROM n LEFT JOIN s ON n.name = s.name AND n.n = s.n"""
)
def nth_occurrence_join_hot(spark, sf_dir):
    """All names are hot, some rows have no name or no order, one name is not on the sheet."""
    orders = table(spark, sf_dir, "orders")
    master = orders.selectExpr(
        "CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS name", "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey - 500 END AS ord"
    )
    sheet = orders.selectExpr("CASE WHEN o_orderpriority NOT LIKE '4%' THEN o_orderpriority ELSE '' END AS name", "o_orderkey + 2 AS sheet_row")
    joined = pair_rows(master, sheet, "name", "ord", hot_rows=100, block_rows=500)
    return joined.select("name", "ord", "n", "sheet_row")


@query(f"WITH {WIDE_CTE} SELECT {', '.join(ROSTER_COLUMNS)} FROM wide")
def project_roster(spark, sf_dir):
    return projected(wide_master(spark, sf_dir))


def _register_division(name: str) -> None:
    division = DIVISIONS[name]

    @query(
        f"WITH {WIDE_CTE} SELECT row_ord, full_name, division, team, end_date FROM wide WHERE {DIVISION_SQL[name]}",
        name=f"division_filter_{name}",
    )
    def _filter(spark, sf_dir):
        rows = own_rows(wide_master(spark, sf_dir), division)
        return rows.select("row_ord", "full_name", "division", "team", "end_date")

    flags = ", ".join(
        f"CASE WHEN {' OR '.join(f'm.{f} <> s.{f}' for f in g.compare)} THEN 1 ELSE 0 END AS {g.name}"
        for g in division.groups
    )

    @query(
        f"""WITH {division_cte(name)}
SELECT m.row_ord, m.full_name, m.n, s.sheet_row, CASE WHEN s.n IS NULL THEN 1 ELSE 0 END AS insert_, {flags}
FROM (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY row_ord) AS n FROM own) m
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY sheet_row) AS n FROM sheet) s
ON m.full_name = s.full_name AND m.n = s.n""",
        name=f"change_flags_{name}",
    )
    def _flags(spark, sf_dir):
        plan = sync_plan(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, name), division)
        names = ["insert_", *[g.name for g in division.groups]]
        return plan.select("row_ord", "full_name", "n", "sheet_row", *names)

    @query(
        f"WITH {WIDE_CTE} SELECT {', '.join(ROSTER_COLUMNS)} FROM wide WHERE {DIVISION_SQL[name]}",
        name=f"master_snapshot_{name}",
    )
    def _snapshot(spark, sf_dir):
        return snapshot(wide_master(spark, sf_dir), division)

    mark = {"tech": "Technology", "solar": "Solar"}.get(name)
    scope_sql = f"m.division LIKE '%{mark}%'" if mark else "TRUE"
    tests = " OR ".join(f"coalesce(m.{f} <> s.{f}, TRUE)" for f in REPORT_FIELDS)
    pairs = ", ".join(f"m.{f} AS {f}_master, s.{f} AS {f}_{name}" for f in REPORT_FIELDS)

    @query(
        f"""WITH {division_cte(name)}
SELECT m.full_name, {pairs}, s.sheet_row FROM wide m JOIN sheet s ON m.full_name = s.full_name
WHERE m.full_name <> '' AND m.status LIKE '%Activo%' AND m.id <> '' AND s.status = '00 - Activo'
  AND {scope_sql} AND ({tests})""",
        name=f"roster_diff_report_{name}",
    )
    def _report(spark, sf_dir):
        scope = contains("division", mark) if mark else None
        return report(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, name), name, scope=scope)


for _name in DIVISIONS:
    _register_division(_name)


_BY_ID_PAIRS = ", ".join(f"m.{f} AS {f}_master, s.{f} AS {f}_sheet" for f in REPORT_FIELDS_BY_ID)
_BY_ID_TESTS = " OR ".join(f"coalesce(m.{f} <> s.{f}, TRUE)" for f in REPORT_FIELDS_BY_ID)


@query(
    f"""WITH {division_cte("tech")}
SELECT m.id, m.company, {_BY_ID_PAIRS}, s.sheet_row FROM wide m JOIN sheet s ON m.id = s.id AND m.company = s.company
WHERE m.id <> '' AND m.status LIKE '%Activo%' AND ({_BY_ID_TESTS})"""
)
def roster_diff_report_by_id(spark, sf_dir):
    master, sheet = wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, "tech")
    return report(master, sheet, "sheet", ["id", "company"], REPORT_FIELDS_BY_ID, active_sheet=False)


@query(
    f"""WITH {WIDE_CTE} SELECT row_ord, status, TRUE AS on_master FROM wide WHERE status LIKE '%Activo%' AND id IS NOT NULL AND id <> ''
UNION ALL SELECT row_ord, status, FALSE FROM wide WHERE status = '00 - Activo'"""
)
def active_filter(spark, sf_dir):
    rows = wide_master(spark, sf_dir)
    on_master = active(rows).select("row_ord", "status", F.lit(True).alias("on_master"))
    on_sheet = active(rows, exact=True).select("row_ord", "status", F.lit(False).alias("on_master"))
    return on_master.unionByName(on_sheet)


@query(
    f"WITH {NARROW_CTE} " + " UNION ALL ".join(f"SELECT '{f}' AS flag, ord FROM plan WHERE {f} = 1" for f in FLAGS),
    name="split_by_flag",
)
def _split_by_flag(spark, sf_dir):
    plan = materialize(_narrow_plan(spark, sf_dir).select("ord", *FLAGS), "flags")
    parts = split_by_flag(plan, FLAGS)
    frames = [df.select(F.lit(flag).alias("flag"), "ord") for flag, df in parts.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query(
    f"""WITH {WIDE_CTE} SELECT row_ord,
  coalesce(manager <> location, TRUE) OR coalesce(sub_team <> team, TRUE) AS legacy,
  manager IS DISTINCT FROM location OR sub_team IS DISTINCT FROM team AS safe,
  manager <> location OR sub_team <> team AS sql FROM wide""",
    name="field_diff",
)
def _field_diff(spark, sf_dir):
    rows = wide_master(spark, sf_dir).selectExpr(
        "row_ord",
        "manager AS a_master",
        "location AS a_sheet",
        "sub_team AS b_master",
        "team AS b_sheet",
    )
    return rows.select("row_ord", *[field_diff(["a", "b"], nulls=m).alias(m) for m in ("legacy", "safe", "sql")])


@query(
    f"WITH {WIDE_CTE} SELECT row_ord, full_name IS NOT NULL AND full_name <> '' AS named FROM wide",
    name="filled",
)
def _filled(spark, sf_dir):
    return wide_master(spark, sf_dir).select("row_ord", filled(F.col("full_name")).alias("named"))


_PATCH_SQL = " UNION ALL ".join(
    f"SELECT sheet_row, '{f}' AS field, {f} AS value, '{g.name}' AS \"group\", "
    f"concat('{g.first_col}', sheet_row, ':{g.last_col}', sheet_row) AS \"range\", "
    f"concat('{g.cells[f]}', sheet_row) AS cell FROM flagged WHERE {g.name} = 1"
    for g in DIVISIONS["solar"].groups
    for f in g.fields
)
_SOLAR_FLAGS = ", ".join(
    f"CASE WHEN {' OR '.join(f'm.{f} <> s.{f}' for f in g.compare)} THEN 1 ELSE 0 END AS {g.name}"
    for g in DIVISIONS["solar"].groups
)


@query(
    f"""WITH {division_cte("solar")}, flagged AS (SELECT m.*, s.sheet_row, {_SOLAR_FLAGS}
FROM (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY row_ord) AS n FROM own) m
JOIN (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY sheet_row) AS n FROM sheet) s
ON m.full_name = s.full_name AND m.n = s.n) {_PATCH_SQL}"""
)
def build_patches_with_ranges(spark, sf_dir):
    plan = sync_plan(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, "solar"), DIVISIONS["solar"])
    return patches_of(plan, DIVISIONS["solar"].groups, ranges=True)
