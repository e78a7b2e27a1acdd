"""Landed HR records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Fields of the HR records.
EMPLOYEES_SCHEMA = (
    "id bigint, first_name string, last_name string, email string, birthday_on string, "
    "terminated_on string, identifier string, gender string, nationality string, country string, "
    "city string, company_id bigint, created_at string, manager_id bigint, team_ids array<bigint>, "
    "legal_entity_id bigint"
)
TEAMS_SCHEMA = (
    "id bigint, name string, company_id bigint, employee_ids array<bigint>, lead_ids array<bigint>"
)
CONTRACT_VERSIONS_SCHEMA = (
    "id bigint, employee_id bigint, effective_on date, job_title string, working_hours bigint, "
    "salary_amount bigint, es_contract_type_id bigint"
)
SUPPLEMENTS_SCHEMA = (
    "id bigint, employee_id bigint, effective_on date, amount_in_cents bigint"
)
TALENT_SCORES_SCHEMA = "Performance int, Potential int"


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False
) -> DataFrame:
    """Records as delivered, by a given schema, so nothing is scanned to infer one.

    Files are JSON Lines, which split.  ``multiline=True`` reads files that hold one JSON
    array each: a file is then one task.  A record that can't be read fails the job.
    """
    return spark.read.schema(schema).json(path, multiLine=multiline, mode="FAILFAST")


def read_talent_scores(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Talent scores as ``performance``, ``potential``; a cell that is no number fails the job."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.schema(TALENT_SCORES_SCHEMA).option("header", True).option("mode", "FAILFAST")
    scores = reader.load(path)
    return scores.selectExpr(
        "CAST(Performance AS INT) AS performance", "CAST(Potential AS INT) AS potential"
    )
