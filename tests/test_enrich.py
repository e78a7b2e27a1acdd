from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterflow.operators import enrich, frames, matrix
from rosterflow.operators.joins import left_join_hot_right, lookup_join
from rosterflow.plans.hr import PAYROLL_UNUSED_FIELDS, PRIVATE_FIELDS, employees_table, payroll_table
from rosterflow.plans.talent import talent_matrix_table


def teams(spark):
    return spark.createDataFrame(
        [(10, "Data", [1, 2]), (11, "Ops", [2, 99]), (12, "Empty", []), (13, "Null", None)],
        "id bigint, name string, employee_ids array<bigint>",
    )


def staff(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, first_name string")


def test_explode_keeps_teams_without_members(spark, rows):
    assert rows(enrich.explode_members(teams(spark))) == [
        ("Data", 1), ("Data", 2), ("Empty", None), ("Null", None), ("Ops", 2), ("Ops", 99)]


def test_employee_in_two_teams_and_in_none(spark, rows):
    out = enrich.employees_with_teams(staff(spark), teams(spark))
    assert rows(out) == [(1, "a", "Data"), (2, "b", "Data"), (2, "b", "Ops"), (3, "c", None)]


def test_member_ids_may_be_text(spark, rows):
    text = teams(spark).withColumn("employee_ids", F.col("employee_ids").cast("array<string>"))
    assert rows(enrich.employees_with_teams(staff(spark), text)) == rows(enrich.employees_with_teams(staff(spark), teams(spark)))


@pytest.mark.parametrize("limit", ["-1", "1m"])
def test_assign_split_is_the_same_with_and_without_broadcast(spark, rows, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    df = spark.createDataFrame([(1, "Data"), (2, "Ops"), (3, None)], "id bigint, team_name string")
    split = spark.createDataFrame([("HQ", "Data"), ("Field", "Data"), ("X", None)], "split string, team string")
    try:
        assert rows(enrich.assign_split(df, split), "id", "split") == [(1, "Field"), (1, "HQ"), (2, None), (3, None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_lookup_is_broadcast_by_its_bytes_alone(spark):
    df = spark.range(10).toDF("id")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    plans = []
    for limit in ("1m", "-1"):
        spark.conf.set(conf, limit)
        try:
            plans.append(lookup_join(df, spark.range(5).toDF("id"), "id")._jdf.queryExecution().executedPlan().toString())
        finally:
            spark.conf.unset(conf)
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1]


def test_companies_may_be_a_frame_of_any_size(spark, rows):
    df = spark.createDataFrame([(1, "a"), (700, "b"), (None, "c"), (9999, "d")], "company_id bigint, v string")
    table = spark.range(1000).selectExpr("id", "concat('c', id) AS name")
    named = enrich.with_company_name(df, table)
    assert rows(named, "v", "company_name") == [("a", "c1"), ("b", "c700"), ("c", None), ("d", "9999")]
    with pytest.raises(ValueError):
        enrich.with_company_name(df, {i: str(i) for i in range(1000)})


def test_left_join_hot_right_equals_a_left_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "n")], "k bigint, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "q")], "k bigint, w string")
    assert rows(left_join_hot_right(left, right, ["k"]), "k", "v", "w") == rows(left.join(right, "k", "left"), "k", "v", "w")


def test_payroll_table(spark, rows):
    contracts = spark.createDataFrame(
        [(1, 10, 4000, 123456, 7), (2, 10, 2000, 5, 8), (3, 11, None, None, 7), (4, 99, 100, 100, 7)],
        "id bigint, employee_id bigint, working_hours bigint, salary_amount bigint, es_contract_type_id bigint",
    )
    people = spark.createDataFrame([(10, "a", "b", 1), (11, "c", "d", 5)], "id bigint, first_name string, last_name string, legal_entity_id bigint")
    rules = [("North", 7, "permanent"), ("North", 8, "temporary"), ("North", 8, "never")]
    with pytest.raises(ValueError, match="has_payroll"):
        payroll_table(contracts, people, {1: "North"}, rules)
    full = contracts.withColumns({c: F.lit(1) for c in PAYROLL_UNUSED_FIELDS})
    with pytest.warns(UserWarning, match="never"):
        out = payroll_table(full, people, {1: "North"}, rules)
    assert not set(PAYROLL_UNUSED_FIELDS) & set(out.columns)
    assert rows(out, "id", "salary_amount", "working_hours", "company_name", "contract_type", "last_name") == [
        (1, Decimal("1234.56"), Decimal("40.00"), "North", "permanent", "b"),
        (2, Decimal("0.05"), Decimal("20.00"), "North", "temporary", "b"),
        (3, None, None, "5", None, "d"),
        (4, Decimal("1.00"), Decimal("1.00"), None, None, None),
    ]
    assert rows(payroll_table(contracts, people, {1: "North"}, rules, strict=False)) == rows(out)


def test_contract_supplements(spark, rows):
    contracts = spark.createDataFrame([(1, 10), (2, 10), (3, 11)], "id bigint, employee_id bigint")
    supplements = spark.createDataFrame([(10, 150), (10, 250), (12, 1)], "employee_id bigint, amount_in_cents bigint")
    assert rows(enrich.contract_supplements(contracts, supplements), "id", "bonus") == [
        (1, Decimal("1.50")), (1, Decimal("2.50")), (2, Decimal("1.50")), (2, Decimal("2.50")), (3, None)]


def test_employees_table_drops_private_fields(spark, rows):
    people = spark.createDataFrame(
        [(1, "a", "city", "2020", None, "N1", 1, "secret"), (3, "c", "city", "2021", "2022", "N3", 9, "secret")],
        "id bigint, first_name string, city string, created_at string, terminated_on string, identifier string, legal_entity_id bigint, bank_number string",
    )
    split = spark.createDataFrame([("HQ", "Data")], "split string, team string")
    out = employees_table(people, teams(spark), split, {1: "North"})
    assert not set(out.columns) & {*PRIVATE_FIELDS, "city", "created_at", "identifier", "legal_entity_id"}
    assert rows(out, "id", "start_date", "end_date", "national_id", "company_name", "team_name", "split") == [
        (1, "2020", None, "N1", "North", "Data", "HQ"),
        (3, "2021", "2022", "N3", "9", None, None),
    ]


def test_employees_table_without_split(spark):
    people = spark.createDataFrame([(1, 1)], "id bigint, legal_entity_id bigint")
    assert "split" not in employees_table(people, teams(spark), None, {1: "North"}).columns


def test_frames(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "T")], "id bigint, `x, y` string, team_name string")
    assert frames.rename_columns(df, {"x, y": "xy", "zz": "q"}).columns == ["id", "xy", "team_name"]
    assert frames.drop_columns(df, ["x, y", "zz"]).columns == ["id", "team_name"]
    with pytest.raises(ValueError):
        frames.drop_columns(df, ["x, y", "zz"], strict=True)
    assert frames.columns_between(df, 1, 3).columns == ["x, y", "team_name"]
    assert frames.columns_between(df, 1).columns == ["x, y", "team_name"]
    assert rows(frames.stack_frames(df.select("id"), df.select("team_name", "id"))) == [(1, None), (1, None), (2, None), (2, "T")]
    assert rows(frames.distinct_teams(df.unionByName(df))) == [("T",)]
    assert frames.with_team(df).count() == 1
    assert frames.team_rows(df, "T' OR '1'='1").count() == 0
    assert rows(frames.known_team_rows(df, spark.createDataFrame([("T",), ("T",)], "name string")), "id") == [(2,)]


def test_matrix(spark, rows):
    pairs = [(3, 3)] * 3 + [(1, 1)] + [(1, 2), (1, 3), (None, 3), (4, 4)]
    df = spark.createDataFrame(pairs, "performance int, potential int")
    assert rows(matrix.talent_matrix(df)) == [(1, 1, "out_of_tune", 1, 0.25), (3, 3, "rock_star", 3, 0.75)]
    grid = {r.performance: (r.potential_1, r.potential_2, r.potential_3) for r in matrix.talent_grid(df).collect()}
    assert grid == {1: (1, 1, 1), 3: (0, 0, 3), None: (0, 0, 1), 4: (0, 0, 0)}
    assert matrix.talent_matrix(df.filter("false")).count() == 0
    table = rows(talent_matrix_table(df).distinct())
    assert ("High Performance", "High Potential", "rock_star") in table
    assert ("Low Performance", "Potential", None) in table
    assert (None, None, None) in table
