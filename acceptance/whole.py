"""Whole jobs and whole results: every row, field and column of what the operators give."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.hr import _LATEST_CTE, _PATCHED, _STATE_COLUMNS, _STATES, _as_double
from acceptance.io import fresh
from acceptance.registry import query
from acceptance.standins import (
    DIVISION_SQL,
    EMPLOYEES,
    NARROW_CTE,
    URGENT,
    WIDE_CTE,
    WIDE_MASTER,
    division_cte,
    employees,
    exprs,
    narrow_master,
    narrow_sheet,
    select_sql,
    table,
    wide_master,
    wide_sheet,
)
from rosterflow import sources
from rosterflow.model import DIVISIONS, ROSTER_COLUMNS, ROSTER_LABELS, SHEET_WIDTHS, STAFF_COLUMNS
from rosterflow.operators import contracts as contract_ops
from rosterflow.operators.diff import roster_diff
from rosterflow.operators.patch import build_patches
from rosterflow.operators.roster import division_filter, roster_sync_plan
from rosterflow.plans import contracts as contract_plans
from rosterflow.plans.sync import roster_sync
from rosterflow.sources.records import EMPLOYEES_SCHEMA

# ------------------------------------------------------------- sync, 33 columns


def _plan_cte(name: str) -> str:
    flags = ", ".join(
        f"CASE WHEN {' OR '.join(f'm.{f} <> s.{f}' for f in g.compare)} THEN 1 ELSE 0 END AS {g.name}" for g in DIVISIONS[name].groups
    )
    return f"""{division_cte(name)}, plan AS (
  SELECT m.*, s.sheet_row, CASE WHEN s.n IS NULL THEN 1 ELSE 0 END AS insert_, {flags}
  FROM (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY row_ord) AS n FROM own) m
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY sheet_row) AS n FROM sheet) s
  ON m.full_name = s.full_name AND m.n = s.n)"""


def _register(name: str) -> None:
    division = DIVISIONS[name]
    writes = {f: g.name for g in division.groups for f in g.fields}
    updated = ", ".join(f"CASE WHEN p.{writes[c]} = 1 THEN p.{c} ELSE s.{c} END AS {c}" if c in writes else f"s.{c}" for c in ROSTER_COLUMNS)

    @query(
        f"""WITH {_plan_cte(name)}
SELECT {updated}, s.sheet_row FROM sheet s LEFT JOIN plan p ON s.sheet_row = p.sheet_row
UNION ALL SELECT {", ".join(ROSTER_COLUMNS)}, coalesce((SELECT max(sheet_row) FROM sheet), 1) + row_number() OVER (ORDER BY row_ord)
FROM plan WHERE insert_ = 1""",
        name=f"roster_sync_{name}",
    )
    def _sync(spark, sf_dir):
        return roster_sync(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, name), division, reuse="table").new_sheet

    if name != "solar":  # registered as build_patches_with_ranges
        patches = " UNION ALL ".join(
            f"SELECT sheet_row, '{f}' AS field, {f} AS value, '{g.name}' AS \"group\", "
            f"concat('{g.first_col}', sheet_row, ':{g.last_col}', sheet_row) AS \"range\", concat('{g.cells[f]}', sheet_row) AS cell "
            f"FROM plan WHERE {g.name} = 1"
            for g in division.groups for f in g.fields
        )

        @query(f"WITH {_plan_cte(name)} {patches}", name=f"sheet_patches_{name}")
        def _patches(spark, sf_dir):
            plan = roster_sync_plan(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, name), division)
            return build_patches(plan, division.groups, ranges=True)

    @query(
        f"""WITH {division_cte(name)} SELECT {", ".join(f"coalesce({c}, '') AS {c}" for c in ROSTER_COLUMNS[: SHEET_WIDTHS[name]])}, row_ord + 2 AS sheet_row
FROM wide WHERE {DIVISION_SQL[name]}""",
        name=f"load_sheet_{name}",
    )
    def _load(spark, sf_dir):
        return sources.load_sheet(_grid(spark, sf_dir, name), name)


#: Columns to the right of the roster's, so that a declared width cuts some off.
_BEYOND = [f"extra_{i}" for i in range(34, 104)]


def _grid(spark, sf_dir, name):
    """A sheet as a grid: the header in row 0, each row as long as its sheet, with cells beyond any width."""
    rows = wide_master(spark, sf_dir)
    if name != "master":
        rows = division_filter(rows, DIVISIONS[name])
    further = _BEYOND if name == "master" else ["beyond"]
    # lambdas over the names: one expression for each cell makes a method too long for the JVM to compile
    named = lambda text: F.transform(F.array(*[F.lit(f"{c}-") for c in further]), lambda c: F.concat(c, text))
    beyond = F.flatten(F.transform(F.array(F.col("row_ord").cast("string")), named)) if name == "master" else F.array(F.lit("beyond"))
    cells = rows.select((F.col("row_ord") + 1).alias("row_ord"), F.concat(F.array(*ROSTER_COLUMNS), beyond).alias("cells"))
    labels = [*ROSTER_LABELS, *further]
    header = spark.createDataFrame([(0, labels)], "row_ord bigint, cells array<string>")
    return header.unionByName(cells)


for _name in DIVISIONS:
    _register(_name)


@query(
    f"""WITH {WIDE_CTE} SELECT {", ".join(f"coalesce({c}, '') AS {c}" for c in ROSTER_COLUMNS)},
  {", ".join(f"concat('{c}-', CAST(row_ord AS STRING)) AS {c}" for c in _BEYOND[: SHEET_WIDTHS["master"] - len(ROSTER_COLUMNS)])}, row_ord
FROM wide"""
)
def load_sheet_master(spark, sf_dir):
    return sources.load_sheet(_grid(spark, sf_dir, "master"), "master")


# ------------------------------------------------------------- differences, whole

_FIELDS = ["job_title", "manager", "status", "team", "fix_salary"]


@query(
    f"""WITH {NARROW_CTE}
SELECT emp_name, ord, sheet_row, {", ".join(f"{f} AS {f}_master, {f}_tl AS {f}_sheet" for f in _FIELDS)}
FROM master JOIN sheet ON emp_name = name_tl WHERE {" OR ".join(f"coalesce({f} <> {f}_tl, true)" for f in _FIELDS)}"""
)
def roster_diff_all(spark, sf_dir):
    """Rows of every status, with all fields."""
    master = division_filter(narrow_master(spark, sf_dir), URGENT)
    return roster_diff(master, narrow_sheet(spark, sf_dir), ["emp_name"], _FIELDS, carry=["ord", "sheet_row"])


@query(
    f"""WITH {NARROW_CTE}
SELECT DISTINCT a.emp_name, a.team, a.status, a.job_title, a.manager FROM all_master a LEFT JOIN sheet b ON a.emp_name = b.name_tl AND a.team = b.team_tl
WHERE b.name_tl IS NULL AND (a.status LIKE '%O%' OR a.status LIKE '%P%' OR a.status LIKE '%F%')"""
)
def append_new_staff_all(spark, sf_dir):
    """The whole master against the whole sheet."""
    columns = ["emp_name", "team", "status", "job_title", "manager"]
    return contract_ops.append_new_staff(
        narrow_master(spark, sf_dir), narrow_sheet(spark, sf_dir), ["emp_name", "team"], ["O", "P", "F"], columns=columns
    )


_HELD = [c for c in STAFF_COLUMNS if c != "q"]


@query(
    f"""WITH {division_cte("solar")}, fresh AS (
  SELECT {", ".join(f"m.{c}" for c in _HELD)}, min(m.row_ord) AS first FROM wide m LEFT JOIN sheet s ON m.full_name = s.full_name AND m.company = s.company
  WHERE m.division LIKE '%Solar%' AND s.full_name IS NULL AND (m.status LIKE '%Activo%' OR m.status LIKE '%Join%') GROUP BY ALL)
SELECT {", ".join(_HELD)}, CAST(NULL AS STRING) AS q, coalesce((SELECT max(sheet_row) FROM sheet), 1) + row_number() OVER (ORDER BY first) AS sheet_row FROM fresh"""
)
def append_staff(spark, sf_dir):
    """The append job: distinct new rows of all columns, by name, numbered after the sheet's last row."""
    return contract_plans.append_staff(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, "solar"))


@query(
    f"""WITH {_LATEST_CTE} SELECT {_STATE_COLUMNS}, status, end_date, strftime(end_date, '%d/%m/%Y') AS end_date_text,
  CAST(fix_salary AS DOUBLE) AS fix_salary, CAST(bonus AS DOUBLE) AS bonus, fix_salary_text, bonus_text FROM state"""
)
def latest_contract_state(spark, sf_dir):
    """With the texts of dates and amounts beside their values."""
    return _as_double(contract_plans.latest_contract_state(wide_master(spark, sf_dir), contract_plans.division_scope("Solar")))


_AMOUNTS = ("fix_salary", "bonus")
_TEXTS = ", ".join(f"{text} AS {field}_text" for field, text, _ in _PATCHED if field in ("end_date", *_AMOUNTS))


@query(
    f"""WITH {_LATEST_CTE} SELECT full_name, company, sheet_row, {", ".join(
        f"CAST({f}_{side} AS DOUBLE) AS {f}_{side}" if f in _AMOUNTS else f"{f}_{side}"
        for f in contract_plans.DIFF_FIELDS for side in ("master", "sheet"))},
  {", ".join(f"differences_{f}" for f in contract_plans.DIFF_FIELDS)}, {_TEXTS} FROM diff"""
)
def latest_contract_diff_all(spark, sf_dir):
    """Every field with both values, its difference, and the texts that a patch would write."""
    diff = contract_plans.latest_contract_diff(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, "solar"))
    return _as_double(diff, _AMOUNTS, ("_master", "_sheet"))


# ------------------------------------------------------------- contracts by employee

_BY_EMPLOYEE = {**_STATES, "emp": "o_custkey", "start_date": "CAST(o_orderdate AS DATE)"}
_CTE = f"src AS ({select_sql(_BY_EMPLOYEE, 'orders')})"
_LATEST = "latest AS (SELECT emp, max(start_date) AS latest_start FROM src GROUP BY emp)"


def _by_employee(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*exprs(_BY_EMPLOYEE))


@query(f"WITH {_CTE} SELECT emp, max(start_date) AS latest_start FROM src GROUP BY emp")
def latest_start_by_employee(spark, sf_dir):
    return contract_ops.latest_start(_by_employee(spark, sf_dir), ["emp"], "start_date")


@query(f"WITH {_CTE}, {_LATEST} SELECT s.* FROM src s JOIN latest l ON s.emp = l.emp AND s.start_date = l.latest_start")
def rows_at_latest_start_by_employee(spark, sf_dir):
    return contract_ops.rows_at_latest_start(_by_employee(spark, sf_dir), ["emp"], "start_date")


@query(
    f"""WITH {_CTE}, {_LATEST} SELECT s.emp, s.job_title, min(s.status) AS status,
  nullif(max(coalesce(s.end_date, DATE '2040-01-01')), DATE '2040-01-01') AS end_date, max(s.salary) AS salary
FROM src s JOIN latest l ON s.emp = l.emp AND s.start_date = l.latest_start GROUP BY s.emp, s.job_title"""
)
def latest_contract_by_employee(spark, sf_dir):
    rows = _by_employee(spark, sf_dir)
    return contract_ops.latest_contract(rows, ["emp"], ["emp", "job_title"], "start_date", "end_date", largest=["salary"])


@query(f"WITH {_CTE} SELECT * EXCLUDE (rn) FROM (SELECT *, rank() OVER (PARTITION BY emp ORDER BY start_date DESC) AS rn FROM src) t WHERE rn = 1")
def latest_by_rank_by_employee(spark, sf_dir):
    return contract_ops.latest_by_rank(_by_employee(spark, sf_dir), "emp", "start_date")


# ------------------------------------------------------------- records

_TEAM_IDS = "CASE WHEN c_custkey % 6 <> 0 THEN array(c_custkey % 7, CAST(c_nationkey AS BIGINT)) END"
_RECORDS = {c: e for c, e in EMPLOYEES.items() if c not in ("bank_number", "state")}


@query(
    f"""WITH e AS ({select_sql(_RECORDS, "customer")})
SELECT e.*, t.team_id FROM e LEFT JOIN (SELECT c_custkey AS member, c_custkey % 7 AS team_id FROM customer WHERE c_custkey % 6 <> 0
  UNION ALL SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 6 <> 0) t ON e.id = t.member"""
)
def read_json_records_lists(spark, sf_dir):
    """Records with their list of teams, one row for each entry; a record without a list stays."""
    path = fresh(spark, "employees")
    staff = table(spark, sf_dir, "customer").selectExpr(*exprs(EMPLOYEES), f"{_TEAM_IDS} AS team_ids")
    staff.write.json(path)
    read = sources.read_json_records(spark, path, EMPLOYEES_SCHEMA)
    return read.select(*_RECORDS, F.explode_outer("team_ids").alias("team_id"))
