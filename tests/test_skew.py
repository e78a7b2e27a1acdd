"""A key with a third of all rows: adaptive execution must be able to split it."""

import pytest
from pyspark.sql import functions as F

from rosterflow.operators.contracts import latest_by_rank, latest_contract, rows_at_latest_start
from rosterflow.operators.diff import roster_diff
from rosterflow.operators.enrich import employees_with_teams, payroll_with_company
from rosterflow.operators.joins import anti_join, left_join_hot_right, lookup_join

ROWS = 120_000


@pytest.fixture
def skewed(spark):
    """A session that splits partitions over 64 kB and broadcasts nothing by itself."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",)}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)
    for key, value in before.items():
        spark.conf.set(key, value)


def many(spark, key="k"):
    """Many rows; key 0 has a third of them.  ``noise`` keeps the shuffled bytes up."""
    return spark.range(0, ROWS, 1, 8).selectExpr(
        f"CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS {key}",
        "id AS v",
        "date_add(DATE '2020-01-01', CAST(id % 2 AS INT)) AS day",
        "sha2(CAST(id AS STRING), 256) AS noise",
    )


def few(spark, key="k"):
    """Distinct keys; the expression hides that they come from a range, partitioned by itself."""
    return spark.range(0, ROWS, 1, 8).selectExpr(f"CAST(concat(id, '') AS BIGINT) AS {key}", "id AS w")


def ran_split(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


CASES = {
    "anti join, hot left": lambda s: anti_join(many(s), few(s).filter("k > 5"), ["k"]),
    "left join, hot right": lambda s: left_join_hot_right(few(s), many(s), ["k"]),
    "rows at latest start": lambda s: rows_at_latest_start(many(s), ["k"], "day"),
    "latest by rank": lambda s: latest_by_rank(many(s), "k", "day"),
    "latest contract": lambda s: latest_contract(
        many(s).withColumn("status", F.lit("s")), ["k"], ["k", "noise"], "day", "day", largest=["v"]
    ),
    "payroll, hot employee": lambda s: payroll_with_company(many(s, "employee_id"), few(s, "id"), ["w"]),
    "lookup, not broadcast": lambda s: lookup_join(many(s), few(s), "k"),
    "difference report, hot name": lambda s: roster_diff(
        many(s).select(F.concat(F.lit("n"), "k").alias("name"), "v", "noise", F.lit("a").alias("title")),
        few(s).select(F.concat(F.lit("n"), "k").alias("name"), F.lit("b").alias("title"), F.col("w").alias("sheet_row")),
        ["name"],
        ["title"],
        carry=["v", "noise", "sheet_row"],
    ),
    "employee in very many teams": lambda s: employees_with_teams(
        few(s, "id"),
        many(s).select(F.col("noise").alias("name"), F.array("k").alias("employee_ids")),
    ),
}


@pytest.mark.parametrize("case", list(CASES))
def test_hot_key_is_split(skewed, case):
    assert ran_split(CASES[case](skewed))


def test_a_plain_anti_join_with_distinct_keys_is_not_split(skewed):
    """Why ``anti_join`` is written as it is: here the aggregation stands below the join."""
    keys = few(skewed).filter("k > 5").select("k").distinct()
    assert not ran_split(many(skewed).join(keys, "k", "left_anti"))
