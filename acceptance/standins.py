"""Stand-ins for people tables, derived from the whole of the driver's tables.

The expressions are portable SQL, so that a stand-in is the same in Spark (by
``selectExpr``) and in the oracle (as a CTE).  No stand-in leaves rows out by id:
where a sheet lacks an entry, the row is there with a blank name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.model import DIVISIONS, ROSTER_COLUMNS, Division, UpdateGroup
from rosterflow.operators.roster import division_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exprs(columns: Mapping[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in columns.items()]


def select_sql(columns: Mapping[str, str], source: str) -> str:
    return f"SELECT {', '.join(exprs(columns))} FROM {source}"


# ---------------------------------------------------------------- narrow roster

NARROW_MASTER = {
    "emp_name": "concat('emp-', CAST(o_custkey AS STRING))",
    "ord": "o_orderkey",
    "division": "o_orderpriority",
    "status": "o_orderstatus",
    "team": "CAST(o_custkey % 13 AS STRING)",
    "manager": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 17 AS STRING) END",
    "job_title": "CAST(o_orderkey % 19 AS STRING)",
    "fix_salary": "o_totalprice",
}
NARROW_SHEET = {
    "emp_name": "CASE WHEN ord % 7 = 0 THEN '' ELSE emp_name END",
    "sheet_row": "ord + 2",
    "status": "CASE WHEN ord % 5 = 0 THEN 'X' ELSE status END",
    "team": "team",
    "manager": "CASE WHEN ord % 6 = 0 THEN NULL WHEN ord % 8 = 0 THEN 'boss' ELSE manager END",
    "job_title": "CASE WHEN ord % 9 = 0 THEN 'chief' ELSE job_title END",
    "fix_salary": "fix_salary",
}
URGENT = Division(
    "urgent",
    lambda: F.col("division").contains("URGENT"),
    [
        UpdateGroup("update_1", ["job_title", "status"]),
        UpdateGroup("update_2", ["team"]),
        UpdateGroup("update_manager", ["manager"]),
        UpdateGroup("update_salaries", ["fix_salary"]),
    ],
    key="emp_name",
)

NARROW_CTE = f"""
all_master AS ({select_sql(NARROW_MASTER, "orders")}),
master AS (SELECT * FROM all_master WHERE division LIKE '%URGENT%' AND emp_name IS NOT NULL AND emp_name <> ''),
sheet AS (SELECT emp_name AS name_tl, sheet_row, status AS status_tl, team AS team_tl, manager AS manager_tl,
  job_title AS job_title_tl, fix_salary AS fix_salary_tl FROM ({select_sql(NARROW_SHEET, "master")}) s),
plan AS (SELECT m.*, h.sheet_row,
  CASE WHEN n_tl IS NULL THEN 1 ELSE 0 END AS insert_,
  CASE WHEN job_title_tl <> job_title OR status_tl <> status THEN 1 ELSE 0 END AS update_1,
  CASE WHEN team_tl <> team THEN 1 ELSE 0 END AS update_2,
  CASE WHEN manager_tl <> manager THEN 1 ELSE 0 END AS update_manager,
  CASE WHEN fix_salary <> fix_salary_tl THEN 1 ELSE 0 END AS update_salaries
  FROM (SELECT *, row_number() OVER (PARTITION BY emp_name ORDER BY ord) AS n FROM master) m
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY name_tl ORDER BY sheet_row) AS n_tl FROM sheet) h
  ON m.emp_name = h.name_tl AND m.n = h.n_tl)
"""


def narrow_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*exprs(NARROW_MASTER))


def narrow_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return division_filter(narrow_master(spark, sf_dir), URGENT).selectExpr(*exprs(NARROW_SHEET))


# ------------------------------------------------------------------ wide roster


def _text(number: str) -> str:
    return f"CAST({number} AS STRING)"


def _day(first: str) -> str:
    return f"concat('{first}/', lpad({_text('month(o_orderdate)')}, 2, '0'), '/', {_text('year(o_orderdate)')})"


_AMOUNT = (
    "concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), '.', "
    "lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0'), ',', "
    "lpad(CAST(o_orderkey % 100 AS STRING), 2, '0'))"
)
_DATE = (
    "concat(lpad(CAST(day(o_orderdate) AS STRING), 2, '0'), '/', "
    "lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '/', CAST(year(o_orderdate) AS STRING))"
)

WIDE_MASTER = {
    "gender": "CASE WHEN o_orderkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "location": "CASE o_custkey % 3 WHEN 0 THEN 'North' WHEN 1 THEN 'South' ELSE '' END",
    "id": f"CASE WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN NULL ELSE {_text('o_custkey')} END",
    "national_id": f"concat('N', {_text('o_custkey')})",
    "full_name": (
        "CASE WHEN o_orderkey % 31 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN NULL "
        f"ELSE concat('Surname', {_text('o_custkey')}, ', Name', {_text('o_custkey')}) END"
    ),
    "job_title": (
        "CASE o_orderkey % 7 WHEN 0 THEN 'Ventas' WHEN 1 THEN 'Founder' WHEN 2 THEN 'Talent' "
        "WHEN 3 THEN NULL ELSE 'Analyst' END"
    ),
    "division": (
        "CASE WHEN o_orderpriority LIKE '1%' THEN 'Technology' WHEN o_orderpriority LIKE '2%' THEN 'Solar' "
        "WHEN o_orderpriority LIKE '3%' THEN 'Supply Technology' ELSE 'Supply' END"
    ),
    "pct_em": _text("o_orderkey % 101"),
    "pct_solar": _text("100 - o_orderkey % 101"),
    "split": "CASE o_custkey % 4 WHEN 0 THEN 'HQ' WHEN 1 THEN 'Field' ELSE 'Remote' END",
    "company": "CASE o_custkey % 5 WHEN 0 THEN 'Alpha' WHEN 1 THEN 'Beta' ELSE 'Gamma' END",
    "status": "CASE o_orderstatus WHEN 'O' THEN '00 - Activo' WHEN 'P' THEN '01 - Join' ELSE '02 - Baja' END",
    "contract_kind": "CASE WHEN o_orderkey % 3 = 0 THEN 'permanent' ELSE 'temporary' END",
    "position_kind": "CASE WHEN o_orderkey % 4 = 0 THEN 'backfill' ELSE 'new' END",
    "profile": f"concat('P', {_text('o_custkey % 4')})",
    "seniority": f"concat('S', {_text('o_custkey % 3')})",
    "team": (
        "CASE o_custkey % 6 WHEN 0 THEN 'Sales' WHEN 1 THEN 'People' WHEN 2 THEN 'Sales Ops' "
        "WHEN 3 THEN '' ELSE 'Data' END"
    ),
    "sub_team": f"concat('sub-', {_text('o_custkey % 9')})",
    "cost_center": _text("o_custkey % 50"),
    "cost_center_finance": _text("o_custkey % 20"),
    "manager": f"CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('M', {_text('o_orderkey % 17')}) END",
    "start_date": (
        "CASE WHEN o_orderkey % 41 = 0 THEN '' WHEN o_orderkey % 43 = 0 THEN 'soon' "
        f"WHEN o_orderkey % 2 = 0 THEN {_day('1')} ELSE {_day('01')} END"
    ),
    "end_date": (
        f"CASE o_orderkey % 8 WHEN 0 THEN {_DATE} WHEN 1 THEN 'permanente' WHEN 2 THEN 'TBD' "
        "WHEN 3 THEN NULL ELSE '' END"
    ),
    "change_date": _DATE,
    "year_end": _text("o_orderkey % 2"),
    "fte_hours": "'1'",
    "fte_hired": "'0,5'",
    "workday_pct": "'100%'",
    "fix_salary": _AMOUNT,
    "bonus": f"CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'n/a' ELSE {_AMOUNT} END",
    "allowances": "''",
    "mileage": _text("o_orderkey % 300"),
    "total_pay": _AMOUNT,
}
assert list(WIDE_MASTER) == ROSTER_COLUMNS

WIDE_CHANGES = {
    "full_name": "CASE WHEN row_ord % 7 = 0 THEN '' ELSE full_name END",
    "job_title": "CASE WHEN row_ord % 9 = 0 THEN 'Chief' ELSE job_title END",
    "status": "CASE WHEN row_ord % 5 = 0 THEN '00 - Activo' ELSE status END",
    "seniority": "CASE WHEN row_ord % 13 = 0 THEN NULL WHEN row_ord % 14 = 0 THEN 'S9' ELSE seniority END",
    "manager": "CASE WHEN row_ord % 6 = 0 THEN NULL WHEN row_ord % 8 = 0 THEN 'boss' ELSE manager END",
    "end_date": "CASE WHEN row_ord % 10 = 0 THEN '' ELSE end_date END",
    "fix_salary": "CASE WHEN row_ord % 12 = 0 THEN '1.000,00' ELSE fix_salary END",
    "bonus": "CASE WHEN row_ord % 15 = 0 THEN '' ELSE bonus END",
}
WIDE_SHEET = {
    **{c: WIDE_CHANGES.get(c, c) for c in ROSTER_COLUMNS},
    "sheet_row": "row_ord + 2",
}

NAMED = "full_name IS NOT NULL AND full_name <> ''"
DIVISION_SQL = {
    "tech": f"division LIKE '%Technology%' AND {NAMED}",
    "solar": f"division LIKE '%Solar%' AND {NAMED}",
    "sales": f"division LIKE '%Supply%' AND end_date NOT LIKE '%20%' AND team = 'Sales' AND {NAMED}",
    "corporate": (
        "division LIKE '%Supply%' AND team NOT LIKE '%Sales%' AND job_title NOT LIKE '%Ventas%' "
        "AND team NOT LIKE '%People%' AND job_title NOT LIKE '%Founder%' AND job_title NOT LIKE '%Talent%' "
        f"AND end_date NOT LIKE '%p%' AND end_date NOT LIKE '%TB%' AND {NAMED}"
    ),
}

WIDE_CTE = f"wide AS ({select_sql({**WIDE_MASTER, 'row_ord': 'o_orderkey'}, 'orders')})"
SHEET_CTE = f"{WIDE_CTE}, sheet AS ({select_sql(WIDE_SHEET, 'wide')})"


def division_cte(name: str) -> str:
    """CTEs ``wide``, ``own`` (the division's master rows) and ``sheet`` (its sheet)."""
    return (
        f"{WIDE_CTE}, own AS (SELECT * FROM wide WHERE {DIVISION_SQL[name]}), "
        f"sheet AS ({select_sql(WIDE_SHEET, 'own')})"
    )


def wide_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*exprs(WIDE_MASTER), "o_orderkey AS row_ord")


def wide_sheet(spark: SparkSession, sf_dir: str, division: str | None = None) -> DataFrame:
    rows = wide_master(spark, sf_dir)
    if division:
        rows = division_filter(rows, DIVISIONS[division])
    return rows.selectExpr(*exprs(WIDE_SHEET))


# ------------------------------------------------------------------- HR records

EMPLOYEES = {
    "id": "c_custkey",
    "first_name": "concat('Name', CAST(c_custkey AS STRING))",
    "last_name": "c_name",
    "email": "concat(CAST(c_custkey AS STRING), '@example.org')",
    "birthday_on": "'1990-01-01'",
    "terminated_on": "CASE WHEN c_custkey % 10 = 0 THEN '2024-12-31' END",
    "identifier": "concat('N', CAST(c_custkey AS STRING))",
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "nationality": "CAST(c_nationkey AS STRING)",
    "country": "'XX'",
    "city": "'Somewhere'",
    "company_id": "CAST(1 AS BIGINT)",
    "created_at": "'2020-01-01'",
    "manager_id": "CAST(floor(c_custkey / 10) AS BIGINT)",
    "legal_entity_id": "CAST(c_nationkey AS BIGINT)",
    "bank_number": "'secret'",
    "state": "'active'",
}
MEMBER = "CASE WHEN user_id % 4 <> 0 AND (event_type <> 'click' OR user_id % 3 = 0) THEN user_id END"
MEMBERS_SQL = f"SELECT DISTINCT event_type AS team_name, {MEMBER} AS member FROM events"
PAGE_MEMBERS = 256

CONTRACTS = {
    "id": "o_orderkey",
    "employee_id": "o_custkey",
    "effective_on": "CAST(o_orderdate AS DATE)",
    "job_title": "o_orderpriority",
    "working_hours": "o_orderkey % 4001",
    "salary_amount": "CAST(floor(o_totalprice) AS BIGINT)",
    "es_contract_type_id": "o_orderkey % 5",
}
COMPANIES = {1: "North Co", 2: "South Co"}
COMPANY_SQL = "coalesce(CASE c_nationkey WHEN 1 THEN 'North Co' WHEN 2 THEN 'South Co' END, CAST(c_nationkey AS STRING))"
CONTRACT_RULES = [
    ("North Co", 1, "permanent"),
    ("North Co", 2, "temporary"),
    ("South Co", 3, "permanent"),
]


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*exprs(EMPLOYEES))


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team records as delivered in pages, so a member list holds at most ``PAGE_MEMBERS`` ids."""
    pages = (
        table(spark, sf_dir, "events")
        .selectExpr("event_type AS name", f"user_id div {PAGE_MEMBERS} AS page", f"{MEMBER} AS member")
        .groupBy("name", "page")
        .agg(F.collect_set("member").alias("employee_ids"))
    )
    return pages.drop("page")


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*exprs(CONTRACTS))


# ------------------------------------------------------------------ sheet grids


def team_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet per market segment, headers included; two sheets have their own column order."""
    customer = table(spark, sf_dir, "customer")
    name = (
        "CASE c_mktsegment WHEN 'FURNITURE' THEN concat('copy of chapter_lead_', c_mktsegment) "
        "ELSE concat('chapter_lead_', c_mktsegment) END"
    )
    swapped = "c_mktsegment IN ('BUILDING', 'MACHINERY')"
    headers = (
        customer.selectExpr(f"{name} AS sheet", f"{swapped} AS swapped")
        .distinct()
        .selectExpr(
            "sheet",
            "CAST(0 AS BIGINT) AS row_ord",
            "IF(swapped, array('name', 'id'), array('id', 'name', 'nation')) AS cells",
        )
    )
    rows = customer.selectExpr(
        f"{name} AS sheet",
        "c_custkey + 1 AS row_ord",
        f"CASE WHEN {swapped} THEN array(c_name, CAST(c_custkey AS STRING)) "
        "WHEN c_custkey % 2 = 0 THEN array(CAST(c_custkey AS STRING), c_name) "
        "ELSE array(CAST(c_custkey AS STRING), c_name, CAST(c_nationkey AS STRING)) END AS cells",
    )
    return headers.unionByName(rows)
