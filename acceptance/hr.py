"""Contracts, employees, payroll and the talent matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance.registry import ORACLES, query
from acceptance.standins import (
    COMPANIES,
    COMPANY_SQL,
    CONTRACT_RULES,
    CONTRACTS,
    EMPLOYEES,
    MEMBERS_SQL,
    NARROW_CTE,
    URGENT,
    WIDE_CTE,
    contracts,
    division_cte,
    employees,
    narrow_master,
    narrow_sheet,
    select_sql,
    table,
    teams,
    wide_master,
    wide_sheet,
)
from rosterflow.functions.mapping import compose_maps, map_values
from rosterflow.functions.talent import PERFORMANCE_LABELS, seven_box as box
from rosterflow.functions.text import (
    blank_to_null,
    date_text,
    end_date_or_sentinel,
    load_stamp,
    null_text,
    parse_amount,
    parse_date,
    sentinel_to_null,
    split_name as name_parts,
)
from rosterflow.operators import contracts as contract_ops
from rosterflow.operators import enrich, frames, matrix
from rosterflow.operators.roster import division_filter
from rosterflow.plans import contracts as contract_plans
from rosterflow.plans import hr as hr_plans
from rosterflow.plans.talent import talent_matrix_table as scores_table

# ------------------------------------------------------------------- contracts


@query(
    f"""WITH {NARROW_CTE}
SELECT DISTINCT a.emp_name, a.team, a.status FROM master a
LEFT JOIN (SELECT * FROM sheet WHERE status_tl = 'F') b ON a.emp_name = b.name_tl AND a.team = b.team_tl
WHERE b.name_tl IS NULL AND (a.status LIKE '%O%' OR a.status LIKE '%P%')"""
)
def append_new_staff(spark, sf_dir):
    master = division_filter(narrow_master(spark, sf_dir), URGENT)
    sheet = narrow_sheet(spark, sf_dir).filter("status = 'F'")
    return contract_ops.append_new_staff(
        master, sheet, ["emp_name", "team"], ["O", "P"], columns=["emp_name", "team", "status"]
    )


@query(
    f"""WITH {division_cte("solar")}
SELECT DISTINCT m.full_name, m.company, m.status, m.job_title FROM wide m
LEFT JOIN sheet s ON m.full_name = s.full_name AND m.company = s.company
WHERE m.division LIKE '%Solar%' AND s.full_name IS NULL AND (m.status LIKE '%Activo%' OR m.status LIKE '%Join%')"""
)
def append_new_staff_solar(spark, sf_dir):
    return contract_ops.append_new_staff(
        wide_master(spark, sf_dir),
        wide_sheet(spark, sf_dir, "solar"),
        ["full_name", "company"],
        scope=F.col("division").contains("Solar"),
        columns=["full_name", "company", "status", "job_title"],
    )


_STATES = {
    "emp": "o_custkey % 300",
    "status": "o_orderstatus",
    "start_date": "date_trunc('month', o_orderdate)",
    "end_date": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END",
    "salary": "o_totalprice",
    "job_title": "o_orderpriority",
}
_STATES_CTE = f"src AS ({select_sql(_STATES, 'orders')})"


def _states(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _STATES.items()])


@query(f"WITH {_STATES_CTE} SELECT emp, max(start_date) AS latest_start FROM src WHERE status = 'O' GROUP BY emp")
def latest_start(spark, sf_dir):
    return contract_ops.latest_start(_states(spark, sf_dir), ["emp"], "start_date", F.col("status") == "O")


@query(
    f"""WITH {_STATES_CTE}, latest AS (SELECT emp, max(start_date) AS latest_start FROM src GROUP BY emp)
SELECT s.* FROM src s JOIN latest l ON s.emp = l.emp AND s.start_date = l.latest_start"""
)
def rows_at_latest_start(spark, sf_dir):
    return contract_ops.rows_at_latest_start(_states(spark, sf_dir), ["emp"], "start_date")


@query(
    f"""WITH {_STATES_CTE}, latest AS (SELECT emp, max(start_date) AS latest_start FROM src GROUP BY emp)
SELECT s.emp, min(s.status) AS status,
  CASE WHEN max(coalesce(s.end_date, DATE '2040-01-01')) = DATE '2040-01-01' THEN NULL
       ELSE max(coalesce(s.end_date, DATE '2040-01-01')) END AS end_date,
  max(s.salary) AS salary
FROM src s JOIN latest l ON s.emp = l.emp AND s.start_date = l.latest_start GROUP BY s.emp"""
)
def latest_contract(spark, sf_dir):
    return contract_ops.latest_contract(
        _states(spark, sf_dir), ["emp"], ["emp"], "start_date", "end_date", largest=["salary"]
    )


@query(
    f"""WITH {_STATES_CTE} SELECT emp, start_date, job_title FROM (
  SELECT *, rank() OVER (PARTITION BY emp ORDER BY start_date DESC) AS rn FROM src) t WHERE rn = 1"""
)
def latest_by_rank(spark, sf_dir):
    rows = _states(spark, sf_dir).select("emp", "start_date", "job_title")
    return contract_ops.latest_by_rank(rows, "emp", "start_date")


_EXISTING = "CASE WHEN c_custkey % 3 = 0 THEN c_custkey END"


@query(
    f"""WITH p AS (SELECT o_custkey, o_orderpriority, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rn FROM orders),
  z AS (SELECT DISTINCT c_custkey AS id, c_name, o_orderpriority AS job_title FROM customer JOIN p ON c_custkey = o_custkey WHERE rn = 1)
SELECT z.id, z.c_name, z.job_title FROM z
LEFT JOIN (SELECT {_EXISTING} AS id FROM customer) b ON z.id = b.id WHERE b.id IS NULL"""
)
def missing_contract_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return contract_ops.missing_contract_rows(
        customer.withColumnRenamed("c_custkey", "id"),
        table(spark, sf_dir, "orders"),
        customer.selectExpr(f"CAST({_EXISTING} AS STRING) AS id"),
        ["c_name"],
        contract_id="o_custkey",
        contract_day="o_orderdate",
        contract_columns=["o_orderpriority"],
    ).withColumnRenamed("o_orderpriority", "job_title")


_AMOUNT_SQL = "TRY_CAST(nullif(replace(replace(trim({0}), '.', ''), ',', '.'), '') AS DECIMAL(12,2))"
_DATE_SQL = "CAST(try_strptime(nullif(trim({0}), ''), '%d/%m/%Y') AS DATE)"
_END_SQL = f"CASE WHEN {{0}} IS NULL OR trim({{0}}) = '' THEN DATE '2040-01-01' ELSE {_DATE_SQL} END"
_STATE_COLUMNS = "full_name, company, id, job_title, split, team, sub_team, manager, profile, seniority"
# the text of the largest amount; of equal amounts the larger text, a missing one being the smallest
_LARGEST_TEXT = (
    "nullif(struct_extract(max({{'a': coalesce(a.{0}, -1000000000000), 't': coalesce(a.{1}, chr(1))}}), 't'), chr(1))"
)
_LATEST_CTE = f"""{division_cte("solar")},
parsed AS (SELECT *, {_DATE_SQL.format("start_date")} AS started, {_END_SQL.format("end_date")} AS ended,
  {_AMOUNT_SQL.format("fix_salary")} AS salary_amount, {_AMOUNT_SQL.format("bonus")} AS bonus_amount FROM wide),
f AS (SELECT full_name, company, max(started) AS latest FROM parsed WHERE division LIKE '%Solar%'
  AND end_date NOT LIKE '%pe%' AND end_date NOT LIKE '%20%' GROUP BY full_name, company),
state AS (SELECT {", ".join("a." + c.strip() for c in _STATE_COLUMNS.split(","))}, min(a.status) AS status,
  nullif(max(a.ended), DATE '2040-01-01') AS end_date, max(a.salary_amount) AS fix_salary, max(a.bonus_amount) AS bonus,
  {_LARGEST_TEXT.format("salary_amount", "fix_salary")} AS fix_salary_text,
  {_LARGEST_TEXT.format("bonus_amount", "bonus")} AS bonus_text
  FROM f JOIN parsed a ON a.full_name = f.full_name AND a.company = f.company AND a.started = f.latest
  GROUP BY {", ".join("a." + c.strip() for c in _STATE_COLUMNS.split(","))}),
rows_ AS (SELECT full_name, company, sheet_row, status, split, team, sub_team, job_title, manager, profile, seniority,
  {_DATE_SQL.format("end_date")} AS end_date, {_AMOUNT_SQL.format("fix_salary")} AS fix_salary,
  {_AMOUNT_SQL.format("bonus")} AS bonus FROM sheet),
diff AS (SELECT m.full_name, m.company, s.sheet_row, m.fix_salary_text, m.bonus_text, {", ".join(
    f"m.{f} AS {f}_master, s.{f} AS {f}_sheet, m.{f} IS DISTINCT FROM s.{f} AS differences_{f}"
    for f in contract_plans.DIFF_FIELDS)}
  FROM state m JOIN rows_ s ON m.full_name = s.full_name AND m.company = s.company WHERE m.full_name <> '' AND m.company <> '')"""


def _as_double(df, columns=("fix_salary", "bonus"), suffixes=("",)):
    return df.withColumns({f"{c}{s}": F.col(f"{c}{s}").cast("double") for c in columns for s in suffixes})


@query(
    f"""WITH {_LATEST_CTE} SELECT {_STATE_COLUMNS}, status, end_date, CAST(fix_salary AS DOUBLE) AS fix_salary,
  CAST(bonus AS DOUBLE) AS bonus FROM state"""
)
def latest_contract_text(spark, sf_dir):
    state = contract_plans.latest_contract_state(wide_master(spark, sf_dir), contract_plans.division_scope("Solar"))
    return _as_double(state.drop("fix_salary_text", "bonus_text", "end_date_text"))


@query(
    f"""WITH {_LATEST_CTE} SELECT full_name, company, sheet_row, {", ".join(
        f"differences_{f}" for f in contract_plans.DIFF_FIELDS)},
  CAST(fix_salary_master AS DOUBLE) AS fix_salary_master, CAST(fix_salary_sheet AS DOUBLE) AS fix_salary_sheet,
  end_date_master, end_date_sheet FROM diff"""
)
def latest_contract_diff(spark, sf_dir):
    diff = contract_plans.latest_contract_diff(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, "solar"))
    return _as_double(diff, ["fix_salary"], ["_master", "_sheet"]).select(
        "full_name",
        "company",
        "sheet_row",
        *[f"differences_{f}" for f in contract_plans.DIFF_FIELDS],
        "fix_salary_master",
        "fix_salary_sheet",
        "end_date_master",
        "end_date_sheet",
    )


# Spelled out, as a check on the library's own lists: the fields, the columns of their texts, their letters.
_PATCHED = (
    ("status", "status_master", "J"), ("end_date", "strftime(end_date_master, '%d/%m/%Y')", "V"), ("split", "split_master", "H"),
    ("team", "team_master", "P"), ("sub_team", "sub_team_master", "Q"), ("job_title", "job_title_master", "F"),
    ("manager", "manager_master", "T"), ("fix_salary", "fix_salary_text", "Y"), ("bonus", "bonus_text", "Z"),
)


@query(
    f"WITH {_LATEST_CTE} "
    + " UNION ALL ".join(
        f"SELECT sheet_row, '{field}' AS field, {text} AS value, concat('{letter}', sheet_row) AS cell FROM diff WHERE differences_{field}"
        for field, text, letter in _PATCHED
    )
)
def build_field_patches(spark, sf_dir):
    diff = contract_plans.latest_contract_diff(wide_master(spark, sf_dir), wide_sheet(spark, sf_dir, "solar"))
    return contract_plans.latest_contract_patches(diff).drop("group")


# ----------------------------------------------------------- employees, payroll


@query(
    f"SELECT c.c_custkey AS id, c.c_name, t.team_name FROM customer c LEFT JOIN ({MEMBERS_SQL}) t ON c.c_custkey = t.member"
)
def employees_with_teams(spark, sf_dir):
    staff = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name")
    return enrich.employees_with_teams(staff, teams(spark, sf_dir))


@query(
    f"""SELECT DISTINCT team_name, member AS employee_id FROM ({MEMBERS_SQL}) t WHERE member IS NOT NULL
UNION ALL SELECT team_name, NULL FROM (SELECT DISTINCT event_type AS team_name FROM events) t"""
)
def explode_members(spark, sf_dir):
    """Members of every team, with one memberless page per team added."""
    pages = teams(spark, sf_dir)
    empty = pages.select("name").distinct().withColumn("employee_ids", F.array().cast("array<bigint>"))
    return enrich.explode_members(pages.unionByName(empty))


_SPLIT = [("BUILDING", "HQ"), ("MACHINERY", "Field")]
_SPLIT_SQL = " UNION ALL ".join(f"SELECT '{t}' AS team, '{s}' AS split" for t, s in _SPLIT)


def _split(spark):
    return spark.createDataFrame(_SPLIT, "team string, split string")


@query(
    f"""SELECT c.c_custkey AS id, c.c_mktsegment AS team_name, s.split, {COMPANY_SQL} AS company_name
FROM customer c LEFT JOIN ({_SPLIT_SQL}) s ON c.c_mktsegment = s.team"""
)
def assign_split(spark, sf_dir):
    staff = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS team_name", "c_nationkey")
    return enrich.assign_split(enrich.with_company_name(staff, COMPANIES, "c_nationkey"), _split(spark))


@query(
    """SELECT c.c_custkey AS id, n.n_name AS team_name, r.r_name AS split FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""
)
def assign_split_by_table(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    lookup = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr("n_name AS team", "r_name AS split")
    staff = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return enrich.assign_split(staff.selectExpr("c_custkey AS id", "n_name AS team_name"), lookup)


@query(
    f"""SELECT e.id, e.first_name, e.last_name, e.email, e.birthday_on, e.terminated_on AS end_date, e.identifier AS national_id,
  e.gender, e.nationality, e.created_at AS start_date, e.manager_id,
  coalesce(CASE e.legal_entity_id WHEN 1 THEN 'North Co' WHEN 2 THEN 'South Co' END, CAST(e.legal_entity_id AS STRING)) AS company_name,
  t.team_name, s.split
FROM ({select_sql(EMPLOYEES, "customer")}) e LEFT JOIN ({MEMBERS_SQL}) t ON e.id = t.member
LEFT JOIN (SELECT 'view' AS team, 'HQ' AS split UNION ALL SELECT 'click', 'Field') s ON t.team_name = s.team"""
)
def employees_table(spark, sf_dir):
    split = spark.createDataFrame([("view", "HQ"), ("click", "Field")], "team string, split string")
    return hr_plans.employees_table(employees(spark, sf_dir), teams(spark, sf_dir), split, COMPANIES)


def _companies(spark):
    """The companies as a frame, with many more that nobody works for."""
    more = spark.range(1000, 3000).selectExpr("id", "concat('company ', id) AS name")
    return spark.createDataFrame(list(COMPANIES.items()), "id bigint, name string").unionByName(more)


@query(ORACLES["employees_table"])
def employees_table_by_lookup(spark, sf_dir):
    split = spark.createDataFrame([("view", "HQ"), ("click", "Field")], "team string, split string")
    return hr_plans.employees_table(employees(spark, sf_dir), teams(spark, sf_dir), split, _companies(spark))


@query(
    """SELECT o.o_orderkey AS id, CAST(floor(o.o_totalprice) AS DOUBLE) / 100 AS salary_amount, c.c_mktsegment AS company_name,
  CASE WHEN c.c_mktsegment = 'BUILDING' AND o.o_orderkey % 5 = 1 THEN 'permanent'
       WHEN c.c_mktsegment = 'BUILDING' AND o.o_orderkey % 5 = 2 THEN 'temporary'
       WHEN c.c_mktsegment = 'MACHINERY' AND o.o_orderkey % 5 = 3 THEN 'permanent' END AS contract_type
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""
)
def contract_type(spark, sf_dir):
    versions = enrich.scale_columns(
        contracts(spark, sf_dir).selectExpr("id", "employee_id", "salary_amount", "es_contract_type_id AS contract_code"),
        ["salary_amount"],
    )
    staff = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS company_name")
    joined = enrich.payroll_with_company(versions, staff, ["company_name"])
    rules = [("BUILDING", 1, "permanent"), ("BUILDING", 2, "temporary"), ("MACHINERY", 3, "permanent")]
    typed = enrich.contract_type(joined, rules)
    return typed.select("id", F.col("salary_amount").cast("double"), "company_name", "contract_type")


@query(
    f"""SELECT o.o_orderkey AS id, o.o_custkey AS employee_id, {COMPANY_SQL} AS company_name FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""
)
def payroll_with_company(spark, sf_dir):
    joined = enrich.payroll_with_company(
        contracts(spark, sf_dir).select("id", "employee_id"), employees(spark, sf_dir), ["legal_entity_id"]
    )
    return enrich.with_company_name(joined, COMPANIES, "legal_entity_id")


@query(
    f"""SELECT p.id, p.employee_id, p.effective_on, p.job_title, CAST(p.working_hours AS DOUBLE) / 100 AS working_hours,
  CAST(p.salary_amount AS DOUBLE) / 100 AS salary_amount,
  CASE WHEN c.c_custkey IS NOT NULL THEN concat('Name', CAST(c.c_custkey AS STRING)) END AS first_name,
  c.c_name AS last_name, {COMPANY_SQL} AS company_name,
  CASE WHEN c.c_nationkey = 1 AND p.es_contract_type_id = 1 THEN 'permanent'
       WHEN c.c_nationkey = 1 AND p.es_contract_type_id = 2 THEN 'temporary'
       WHEN c.c_nationkey = 2 AND p.es_contract_type_id = 3 THEN 'permanent' END AS contract_type
FROM ({select_sql(CONTRACTS, "orders")}) p LEFT JOIN customer c ON p.employee_id = c.c_custkey"""
)
def payroll_table(spark, sf_dir):
    unused = {c: F.lit(None).cast("string") for c in hr_plans.PAYROLL_UNUSED_FIELDS}
    versions = contracts(spark, sf_dir).withColumns(unused)
    payroll = hr_plans.payroll_table(versions, employees(spark, sf_dir), COMPANIES, CONTRACT_RULES)
    return _as_double(payroll, ["working_hours", "salary_amount"])


@query(ORACLES["payroll_table"])
def payroll_table_by_lookup(spark, sf_dir):
    unused = {c: F.lit(None).cast("string") for c in hr_plans.PAYROLL_UNUSED_FIELDS}
    versions = contracts(spark, sf_dir).withColumns(unused)
    payroll = hr_plans.payroll_table(versions, employees(spark, sf_dir), _companies(spark), CONTRACT_RULES)
    return _as_double(payroll, ["working_hours", "salary_amount"])


@query(
    """SELECT o.o_orderkey AS id, o.o_custkey AS employee_id, CAST(e.event_id AS DOUBLE) / 100 AS bonus
FROM orders o LEFT JOIN events e ON o.o_custkey = e.user_id"""
)
def contract_supplements(spark, sf_dir):
    supplements = table(spark, sf_dir, "events").selectExpr("user_id AS employee_id", "event_id AS amount_in_cents")
    joined = enrich.contract_supplements(contracts(spark, sf_dir).select("id", "employee_id"), supplements)
    return _as_double(joined, ["bonus"])


@query(
    f"""WITH {WIDE_CTE}, e AS (SELECT c_custkey AS id, concat('Name', CAST(c_custkey AS STRING)) AS first_name, c_name AS last_name,
    concat(CAST(c_custkey AS STRING), '@example.org') AS email, concat('N', CAST(c_custkey AS STRING)) AS national_id,
    CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_mktsegment END AS team_name FROM customer),
  m AS (SELECT e.*, w.sub_team, w.manager FROM e JOIN wide w ON e.national_id = w.national_id
    WHERE e.team_name IS NOT NULL AND w.status LIKE '%Activo%'),
  p AS (SELECT o_custkey AS employee_id, o_orderpriority AS job_title,
    rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC) AS rn FROM orders)
SELECT DISTINCT m.id, m.first_name, m.last_name, m.email, p.job_title, m.manager, m.team_name, m.sub_team
FROM m JOIN p ON m.id = p.employee_id LEFT JOIN (SELECT {_EXISTING} AS id FROM customer) b ON m.id = b.id
WHERE p.rn = 1 AND b.id IS NULL"""
)
def team_contract_rows(spark, sf_dir):
    return _team_contract_rows(spark, sf_dir)


def _team_contract_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    staff = customer.selectExpr(
        *[f"{EMPLOYEES[c]} AS {c}" for c in ("id", "first_name", "last_name", "email")],
        f"{EMPLOYEES['identifier']} AS national_id",
        "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_mktsegment END AS team_name",
    )
    existing = customer.selectExpr(f"CAST({_EXISTING} AS STRING) AS id")
    return contract_plans.team_contract_rows(
        staff, wide_master(spark, sf_dir), contracts(spark, sf_dir), existing
    )


# ---------------------------------------------------------------------- talent

_SCORES = {"performance": "1 + CAST(c_custkey % 3 AS INT)", "potential": "1 + CAST(floor(c_custkey / 3) AS INT) % 3"}
_SCORES_CTE = f"t AS (SELECT c_custkey AS id, {_SCORES['performance']} AS perf, {_SCORES['potential']} AS pot FROM customer)"
_BOX_SQL = """CASE WHEN perf = 3 AND pot = 3 THEN 'rock_star' WHEN perf = 3 AND pot = 2 THEN 'singer_star'
    WHEN perf = 3 AND pot = 1 THEN 'vocal_coach' WHEN perf = 2 AND pot = 3 THEN 'future_rock_star'
    WHEN perf = 2 AND pot = 2 THEN 'choir_singer' WHEN perf = 2 AND pot = 1 THEN 'solist_solid'
    WHEN perf = 1 AND pot = 1 THEN 'out_of_tune' END"""


def _scores(spark, sf_dir, performance="perf", potential="pot"):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", f"{_SCORES['performance']} AS {performance}", f"{_SCORES['potential']} AS {potential}"
    )


@query(
    f"""WITH {_SCORES_CTE}, b AS (SELECT perf, pot, {_BOX_SQL} AS seven_box FROM t)
SELECT perf, pot, seven_box, count(*) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share
FROM b WHERE seven_box IS NOT NULL GROUP BY perf, pot, seven_box"""
)
def talent_matrix(spark, sf_dir):
    return matrix.talent_matrix(_scores(spark, sf_dir), "perf", "pot")


@query(
    f"""WITH {_SCORES_CTE} SELECT perf, count(*) FILTER (WHERE pot = 1) AS potential_1,
  count(*) FILTER (WHERE pot = 2) AS potential_2, count(*) FILTER (WHERE pot = 3) AS potential_3 FROM t GROUP BY perf"""
)
def talent_grid(spark, sf_dir):
    return matrix.talent_grid(_scores(spark, sf_dir), "perf", "pot")


@query(f"WITH {_SCORES_CTE} SELECT id, {_BOX_SQL} AS seven_box FROM t")
def seven_box(spark, sf_dir):
    return _scores(spark, sf_dir).select("id", box(F.col("perf"), F.col("pot")).alias("seven_box"))


@query(
    f"""WITH {_SCORES_CTE} SELECT id, {_BOX_SQL} AS seven_box,
  CASE perf WHEN 3 THEN 'High Performance' WHEN 2 THEN 'Achieve Performance' WHEN 1 THEN 'Low Performance' END AS performance,
  CASE pot WHEN 3 THEN 'High Potential' WHEN 2 THEN 'Potential' WHEN 1 THEN 'At Potential' END AS potential FROM t"""
)
def talent_matrix_table(spark, sf_dir):
    return scores_table(_scores(spark, sf_dir, "performance", "potential"))


# ------------------------------------------------------------ column expressions


@query(
    """SELECT p_partkey, CASE p_size WHEN 1 THEN 'Low Performance' WHEN 2 THEN 'Achieve Performance' WHEN 3 THEN 'High Performance' END AS strict,
  coalesce(CASE p_size WHEN 1 THEN 'One' WHEN 2 THEN 'Two' END, CAST(p_size AS STRING)) AS kept FROM part"""
)
def map_values_strict_and_keep(spark, sf_dir):
    two_steps = compose_maps({1: "one", 2: "two"}, {"one": "One", "two": "Two"})
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        map_values(F.col("p_size"), PERFORMANCE_LABELS).alias("strict"),
        map_values(F.col("p_size"), {k: v for k, v in two_steps.items() if isinstance(k, int)}, "keep").alias("kept"),
    )


@query("SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS DOUBLE) / 100 AS amount FROM orders")
def scale_hundredths(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CAST(floor(o_totalprice) AS BIGINT) AS amount")
    return _as_double(enrich.scale_columns(rows, ["amount"]), ["amount"])


@query(
    f"""WITH {WIDE_CTE} SELECT row_ord, split_part(full_name, ',', 1) AS last_name,
  CASE WHEN contains(full_name, ',') THEN ltrim(split_part(full_name, ',', 2)) END AS first_name FROM wide"""
)
def split_name(spark, sf_dir):
    return wide_master(spark, sf_dir).select("row_ord", *name_parts(F.col("full_name")))


@query(
    f"""WITH {WIDE_CTE} SELECT row_ord, {_DATE_SQL.format("start_date")} AS started,
  nullif({_END_SQL.format("end_date")}, DATE '2040-01-01') AS ended,
  strftime({_DATE_SQL.format("start_date")}, '%d/%m/%Y') AS started_text,
  strftime({_DATE_SQL.format("change_date")}, '%Y%m%d') AS stamp,
  CAST({_AMOUNT_SQL.format("bonus")} AS DOUBLE) AS bonus FROM wide"""
)
def parse_text(spark, sf_dir):
    started = parse_date(F.col("start_date"))
    return wide_master(spark, sf_dir).select(
        "row_ord",
        started.alias("started"),
        sentinel_to_null(end_date_or_sentinel(F.col("end_date"))).alias("ended"),
        date_text(started).alias("started_text"),
        load_stamp(parse_date(F.col("change_date"))).alias("stamp"),
        parse_amount(F.col("bonus")).cast("double").alias("bonus"),
    )


@query(f"WITH {WIDE_CTE} SELECT row_ord, nullif(full_name, '') AS full_name, nullif(team, '') AS team FROM wide")
def blanks_to_null(spark, sf_dir):
    return blank_to_null(wide_master(spark, sf_dir).select("row_ord", "full_name", "team"))


@query(f"WITH {WIDE_CTE} SELECT row_ord, full_name, CAST(NULL AS STRING) AS q FROM wide")
def literal_null_column(spark, sf_dir):
    return wide_master(spark, sf_dir).select("row_ord", "full_name", null_text().alias("q"))


# ---------------------------------------------------------------- frame operators


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def rename_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return frames.rename_columns(rows, {"c_custkey": "id", "c_name": "name", "absent": "ignored"})


@query("SELECT c_custkey, c_mktsegment FROM customer")
def drop_columns(spark, sf_dir):
    tolerant = frames.drop_columns(table(spark, sf_dir, "customer"), ["c_name", "absent"])
    return frames.drop_columns(tolerant, ["c_nationkey", "c_acctbal"], strict=True)


@query("SELECT c_name, c_nationkey FROM customer")
def columns_between(spark, sf_dir):
    return frames.columns_between(table(spark, sf_dir, "customer"), 1, 3)


@query(
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier"""
)
def stack_frames(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_name AS name", "s_suppkey AS id")
    return frames.stack_frames(customer, supplier)


@query("SELECT c_custkey, c_mktsegment AS team_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def team_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_mktsegment AS team_name")
    return frames.team_rows(rows, "BUILDING")


@query("SELECT DISTINCT event_type AS team_name FROM events WHERE event_type IS NOT NULL")
def distinct_teams(spark, sf_dir):
    return frames.distinct_teams(table(spark, sf_dir, "events").withColumnRenamed("event_type", "team_name"))


@query(
    """SELECT c_custkey, c_mktsegment AS team_name FROM customer WHERE c_mktsegment IN
(SELECT CASE WHEN p_size > 25 THEN 'BUILDING' ELSE 'FURNITURE' END FROM part)"""
)
def known_team_rows(spark, sf_dir):
    known = table(spark, sf_dir, "part").selectExpr("CASE WHEN p_size > 25 THEN 'BUILDING' ELSE 'FURNITURE' END AS team")
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_mktsegment AS team_name")
    return frames.known_team_rows(rows, known)
