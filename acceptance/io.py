"""Sources and sinks: what is written is read back and compared."""

from __future__ import annotations

import uuid

from acceptance.hr import _SCORES, _team_contract_rows
from acceptance.registry import ORACLES, query
from acceptance.standins import EMPLOYEES, employees, select_sql, table, team_grids
from rosterflow import sinks, sources
from rosterflow.plans import hr as hr_plans
from rosterflow.session import shared_dir
from rosterflow.sources.records import EMPLOYEES_SCHEMA


def fresh(spark, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def fresh_table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


# --------------------------------------------------------------------- sources


@query("SELECT CAST(c_custkey AS STRING) AS id, c_name AS name, '' AS name_2, c_custkey + 2 AS sheet_row FROM customer")
def promote_header(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    rows = customer.selectExpr("c_custkey + 1 AS row_ord", "array(CAST(c_custkey AS STRING), c_name) AS cells")
    header = customer.selectExpr("max(CAST(0 AS BIGINT)) AS row_ord", "max(array('id', 'name', 'name', 'left out')) AS cells")
    return sources.promote_header(header.unionByName(rows), max_cols=3)


_TEAM_SHEETS = """SELECT c_mktsegment AS team_name, c_custkey + 2 AS sheet_row, CAST(c_custkey AS STRING) AS id, c_name AS name,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN NULL WHEN c_custkey % 2 = 0 THEN '' ELSE CAST(c_nationkey AS STRING) END AS nation
FROM customer WHERE c_mktsegment IN ({0})"""


@query(_TEAM_SHEETS.format("'BUILDING', 'MACHINERY', 'AUTOMOBILE'"))
def union_team_sheets(spark, sf_dir):
    teams = table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_size < 10 THEN 'BUILDING' WHEN p_size < 20 THEN 'MACHINERY' WHEN p_size < 30 THEN 'AUTOMOBILE' "
        "ELSE 'FURNITURE' END AS team"
    )
    return sources.union_team_sheets(team_grids(spark, sf_dir), teams, ["id", "name", "nation"])


@query(_TEAM_SHEETS.format("SELECT c_mktsegment FROM customer WHERE c_mktsegment <> 'FURNITURE'"))
def team_sheet_table(spark, sf_dir):
    staff = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "team_name")
    return hr_plans.team_sheet_table(team_grids(spark, sf_dir), staff, ["id", "name", "nation"])


@query("SELECT s_suppkey, s_name FROM supplier")
def read_table(spark, sf_dir):
    return sources.read_table(spark, f"{sf_dir}/supplier.parquet", ["s_suppkey", "s_name"])


@query("SELECT o_orderkey, o_orderkey AS row_ord FROM orders")
def read_with_row_ord(spark, sf_dir):
    return sources.read_with_row_ord(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "row_ord")


_JOBS = {c: "CAST(NULL AS STRING)" for c in sources.JOB_COLUMNS} | {
    "id": "p_partkey",
    "title": "p_name",
    "code": "p_brand",
    "state": "p_type",
    "salary_from": "p_retailprice",
}
_CANDIDATES = {c: "CAST(NULL AS STRING)" for c in sources.CANDIDATE_COLUMNS} | {
    "id": "o_orderkey",
    "candidate_created_at": "o_orderdate",
    "job_title": "o_orderpriority",
    "disqualified": "o_orderstatus = 'F'",
    "recruiter_id": "o_custkey",
}


@query(select_sql(_JOBS, "part"))
def read_recruiting_jobs(spark, sf_dir):
    jobs = table(spark, sf_dir, "part").selectExpr("*", *[f"{e} AS {c}" for c, e in _JOBS.items()])
    return sources.read_recruiting(spark, "jobs", jobs)


@query(select_sql(_CANDIDATES, "orders"))
def read_recruiting_candidates(spark, sf_dir):
    candidates = table(spark, sf_dir, "orders").selectExpr("*", *[f"{e} AS {c}" for c, e in _CANDIDATES.items()])
    return sources.read_recruiting(spark, "candidates", candidates)


_RECORD_FIELDS = [c for c in EMPLOYEES if c not in ("bank_number", "state")]


@query(select_sql({c: EMPLOYEES[c] for c in _RECORD_FIELDS}, "customer"))
def read_json_records(spark, sf_dir):
    path = fresh(spark, "employees")
    employees(spark, sf_dir).write.json(path)
    return sources.read_json_records(spark, path, EMPLOYEES_SCHEMA).drop("team_ids")


@query(f"SELECT {_SCORES['performance']} AS performance, {_SCORES['potential']} AS potential FROM customer")
def read_talent_scores(spark, sf_dir):
    path = fresh(spark, "scores")
    scores = table(spark, sf_dir, "customer").selectExpr(
        f"{_SCORES['performance']} AS Performance", f"{_SCORES['potential']} AS Potential"
    )
    sinks.export_csv(scores, path)
    return sources.read_talent_scores(spark, path)


# ----------------------------------------------------------------------- sinks


@query("SELECT * FROM supplier")
def write_replace(spark, sf_dir):
    """Replaced twice: other columns first, then the rows that are read back."""
    name, root = fresh_table("supplier"), shared_dir(spark)
    supplier = table(spark, sf_dir, "supplier")
    sinks.write_replace(supplier.select("s_suppkey"), name, root)
    sinks.write_replace(supplier, name, root)
    return spark.table(name)


@query("SELECT CAST(s_suppkey AS STRING) AS s_suppkey, s_name FROM supplier")
def write_truncate_append(spark, sf_dir):
    """The table keeps its own column order and types."""
    name, root = fresh_table("supplier"), shared_dir(spark)
    supplier = table(spark, sf_dir, "supplier")
    sinks.write_replace(supplier.selectExpr("s_name", "CAST(s_suppkey AS STRING) AS s_suppkey"), name, root)
    sinks.write_truncate_append(supplier, name, root)
    return spark.table(name)


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def write_truncate_append_partitioned(spark, sf_dir):
    """A table in one directory per nation, first filled with other rows in other partitions."""
    name, root = fresh_table("supplier"), shared_dir(spark)
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    old = supplier.selectExpr("s_suppkey", "'old' AS s_name", "s_nationkey % 5 + 100 AS s_nationkey")
    sinks.write_replace(old, name, root, partition_by=["s_nationkey"])
    sinks.write_truncate_append(supplier, name, root, keep_versions=1)
    return spark.table(name)


@query("SELECT s_name, s_suppkey, s_nationkey FROM supplier")
def write_replace_partitioned(spark, sf_dir):
    """The new table keeps the partitioning and holds the new rows alone."""
    name, root = fresh_table("supplier"), shared_dir(spark)
    supplier = table(spark, sf_dir, "supplier")
    sinks.write_replace(supplier.selectExpr("s_suppkey", "s_nationkey % 5 AS s_nationkey"), name, root, partition_by=["s_nationkey"])
    sinks.write_replace(supplier.select("s_name", "s_suppkey", "s_nationkey"), name, root)
    return spark.table(name)


@query("SELECT n_nationkey, n_name FROM nation UNION ALL SELECT s_nationkey, s_name FROM supplier")
def append_rows(spark, sf_dir):
    name, root = fresh_table("names"), shared_dir(spark)
    sinks.write_replace(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), name, root)
    sinks.append_to(
        table(spark, sf_dir, "supplier").selectExpr("s_name AS n_name", "s_nationkey AS n_nationkey"), name
    )
    return spark.table(name)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def export_csv(spark, sf_dir):
    path = fresh(spark, "csv")
    sinks.export_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return spark.read.schema("c_custkey bigint, c_name string, c_mktsegment string").csv(path, header=True)


@query("SELECT * FROM events")
def stage_export(spark, sf_dir):
    path = fresh(spark, "stage")
    sinks.stage_export(table(spark, sf_dir, "events"), path)
    return spark.read.parquet(path)


@query("SELECT event_id, user_id, event_type FROM events")
def holiday_export(spark, sf_dir):
    path = fresh(spark, "holidays")
    rows = sources.read_table(spark, f"{sf_dir}/events.parquet", ["event_id", "user_id", "event_type"])
    hr_plans.holiday_export(rows, path)
    return spark.read.parquet(path)


@query(f"SELECT * FROM ({ORACLES['team_contract_rows']}) r WHERE team_name IN ('BUILDING', 'MACHINERY')")
def route_by_team(spark, sf_dir):
    path = fresh(spark, "teams")
    known = table(spark, sf_dir, "part").selectExpr("IF(p_size > 25, 'BUILDING', 'MACHINERY') AS team")
    sinks.route_by_team(_team_contract_rows(spark, sf_dir), known, path)
    return spark.read.parquet(path)


@query("SELECT c_custkey, c_name FROM customer")
def publish_snapshot(spark, sf_dir):
    """The second snapshot derives from the table it replaces."""
    name, root = fresh_table("snapshot"), shared_dir(spark)
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    sinks.publish_snapshot(rows.unionByName(rows), name, root)
    sinks.publish_snapshot(spark.table(name).distinct(), name, root)
    return spark.table(name)
