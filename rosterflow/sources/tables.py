"""Relational tables, read over JDBC or from columnar files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


FETCH_SIZE = 160_000

# Columns of the recruiting tables.
JOB_COLUMNS = [
    "id",
    "job_created_at",
    "title",
    "code",
    "state",
    "city",
    "experience",
    "salary_from",
    "salary_to",
    "first_published_at",
    "last_published_at",
]
CANDIDATE_COLUMNS = [
    "id",
    "candidate_created_at",
    "job_title",
    "job_first_published_at",
    "application_method",
    "current_stage_id",
    "first_screened_at",
    "first_contacted_at",
    "first_interviewed_at",
    "first_offer_at",
    "first_hired_at",
    "disqualified",
    "disqualified_at",
    "recruiter_id",
    "firstname",
    "lastname",
    "email",
]
RECRUITING_COLUMNS = {"jobs": JOB_COLUMNS, "candidates": CANDIDATE_COLUMNS}


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    fetchsize: int = FETCH_SIZE,
    partition: tuple[str, int, int, int] | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options.  ``partition`` is (column, lower, upper, partitions).

    A partitioned read needs a table, so a query is wrapped as a subquery then.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetchsize), **extra}
    if partition is None:
        options["query" if query else "dbtable"] = query or table
        return options
    column, lower, upper, count = partition
    return {
        **options,
        "dbtable": f"({query}) AS source" if query else table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(count),
    }


def read_table(
    spark: SparkSession, source: str | dict[str, str], columns: Sequence[str] | None = None
) -> DataFrame:
    """A table from :func:`jdbc_options`, or from a Parquet path or a catalog name."""
    if isinstance(source, dict):
        df = spark.read.format("jdbc").options(**source).load()
    elif "/" in source:
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    return df.select(*columns) if columns else df


def read_recruiting(spark: SparkSession, which: str, source: str | dict[str, str] | DataFrame) -> DataFrame:
    """Jobs or candidates: the fixed projection of the warehouse table."""
    columns = RECRUITING_COLUMNS[which]
    if isinstance(source, DataFrame):
        return source.select(*columns)
    return read_table(spark, source, columns)


def read_with_row_ord(spark: SparkSession, path: str, out: str = "row_ord") -> DataFrame:
    """Parquet rows with their place in the table: files by path, rows by position.

    No row is sorted.  The row's place in its file comes from the scan; what is
    added is the row count of the earlier files, from a table with a row per file.
    """
    placed = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at")
    )
    files = placed.groupBy("__file").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("__file", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    return (
        placed.join(before, "__file")
        .withColumn(out, F.col("__at") + F.col("__before"))
        .drop("__file", "__at", "__before")
    )
