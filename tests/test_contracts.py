import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from rosterflow.model import ROSTER_COLUMNS
from rosterflow.operators.contracts import (
    absent_employees,
    append_new_staff,
    latest_by_rank,
    latest_contract,
    latest_start,
    missing_contract_rows,
    rows_at_latest_start,
    with_active_master,
)
from rosterflow.operators.ordinal import append_rows
from rosterflow.plans.contracts import (
    division_scope,
    latest_contract_diff,
    latest_contract_patches,
    latest_contract_state,
    team_contract_rows,
)

D = datetime.date
STATES = "k string, status string, start date, end date, pay int, job string"


def states(spark):
    return spark.createDataFrame(
        [
            ("a", "1", D(2020, 1, 31), None, 5, "x"),
            ("a", "0", D(2022, 12, 1), D(2023, 1, 1), 7, "x"),
            ("a", "2", D(2022, 12, 1), D(2023, 6, 1), 6, "x"),
            ("a", "2", D(2022, 12, 1), None, 1, "y"),
            ("b", "1", None, None, 1, "x"),
            ("c", "1", D(2021, 1, 1), D(2021, 2, 1), 1, "x"),
            (None, "1", D(2021, 1, 1), None, 1, "x"),
        ],
        STATES,
    )


def test_latest_start_with_scope(spark, rows):
    assert rows(latest_start(states(spark), ["k"], "start", F.col("pay") < 7).filter("k = 'a'")) == [("a", D(2022, 12, 1))]
    out = latest_start(states(spark), ["k"], "start", F.col("pay") == 5)
    assert rows(out) == [("a", D(2020, 1, 31))]


def test_rows_at_latest_start_keeps_ties(spark, rows):
    out = rows_at_latest_start(states(spark), ["k"], "start")
    assert rows(out, "k", "pay") == [("a", 1), ("a", 6), ("a", 7), ("c", 1)]


def test_latest_contract_folds_each_state(spark, rows):
    out = latest_contract(states(spark), ["k"], ["k", "job"], "start", "end", largest=["pay"])
    assert rows(out) == [
        ("a", "x", "0", D(2023, 6, 1), 7),
        ("a", "y", "2", None, 1),
        ("c", "x", "1", D(2021, 2, 1), 1),
    ]


def test_scope_limits_the_start_and_optionally_the_rows(spark, rows):
    scope = F.col("status") == "2"
    legacy = latest_contract(states(spark), ["k"], ["k", "job"], "start", "end", largest=["pay"], scope=scope)
    assert rows(legacy) == [("a", "x", "0", D(2023, 6, 1), 7), ("a", "y", "2", None, 1)]
    both = latest_contract(
        states(spark), ["k"], ["k", "job"], "start", "end", largest=["pay"], scope=scope, legacy_scope=False
    )
    assert rows(both) == [("a", "x", "2", D(2023, 6, 1), 6), ("a", "y", "2", None, 1)]


def test_latest_by_rank_keeps_ties_and_null_only_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, D(2020, 1, 1), "a"), (1, D(2021, 1, 1), "b"), (1, D(2021, 1, 1), "c"), (1, None, "n"), (2, None, "d"), (None, D(2020, 1, 1), "e")],
        "k bigint, day date, job string",
    )
    assert rows(latest_by_rank(df, "k", "day"), "job") == [("b",), ("c",), ("d",), ("e",)]


def test_append_new_staff(spark, rows):
    master = spark.createDataFrame(
        [
            ("new", "A", "00 - Activo", "Solar"),
            ("new", "A", "00 - Activo", "Solar"),
            ("join", "A", "01 - Join", "Solar"),
            ("join elsewhere", "A", "01 - Join", "Tech"),
            ("left", "A", "02 - Baja", "Solar"),
            ("known", "A", "00 - Activo", "Solar"),
            ("known", "B", "00 - Activo", "Solar"),
            (None, "A", "00 - Activo", "Solar"),
        ],
        "name string, company string, status string, division string",
    )
    sheet = spark.createDataFrame([("known", "A"), ("known", "A"), (None, "A"), ("new", None)], "name string, company string")
    out = append_new_staff(master, sheet, ["name", "company"], scope=F.col("division") == "Solar")
    assert rows(out, "name", "company") == [(None, "A"), ("join", "A"), ("known", "B"), ("new", "A")]
    other = sheet.toDF("n", "c")
    renamed = append_new_staff(master, other, {"name": "n", "company": "c"}, scope=F.col("division") == "Solar")
    assert rows(renamed) == rows(out)


def test_new_staff_keep_the_order_of_their_first_copy(spark, rows):
    master = spark.createDataFrame(
        [("b", "00 - Activo", 5), ("a", "00 - Activo", 9), ("b", "00 - Activo", 2)], "name string, status string, row_ord bigint"
    )
    sheet = spark.createDataFrame([("z", 4)], "name string, sheet_row bigint")
    new = append_new_staff(master, sheet, ["name"], order="row_ord")
    assert rows(new, "name", "row_ord") == [("a", 9), ("b", 2)]
    assert rows(append_rows(sheet, new, "row_ord"), "name", "sheet_row") == [("a", 6), ("b", 5)]


def test_absent_employees_compares_whole_ids(spark, rows):
    staff = spark.createDataFrame([(1,), (12,), (123,)], "id bigint")
    existing = spark.createDataFrame([("12",), ("",), (None,), ("12",)], "id string")
    assert rows(absent_employees(staff, existing)) == [(1,), (123,)]


def hr(spark):
    staff = spark.createDataFrame(
        [(1, "N1", "Data", "A"), (2, "N2", None, "B"), (3, "N3", "Data", "C"), (4, "N4", "Ops", "D"), (5, "N5", "Ops", "E")],
        "id bigint, national_id string, team_name string, first_name string",
    ).withColumns({"last_name": F.lit("L"), "email": F.lit("e")})
    master = spark.createDataFrame(
        [("N1", "00 - Activo", "s1", "m"), ("N1", "00 - Activo", "s1", "m"), ("N1", "00 - Activo", "s2", "m"), ("N2", "00 - Activo", "s", "m"), ("N3", "02 - Baja", "s", "m"), ("N4", "00 - Activo", None, None), ("N5", "00 - Activo", "s", "m")],
        "national_id string, status string, sub_team string, manager string",
    )
    versions = spark.createDataFrame(
        [(1, D(2020, 1, 1), "old"), (1, D(2021, 1, 1), "new"), (2, D(2021, 1, 1), "b"), (3, D(2021, 1, 1), "c"), (4, D(2021, 1, 1), "d1"), (4, D(2021, 1, 1), "d2"), (4, D(2021, 1, 1), "d2"), (5, D(2021, 1, 1), "e")],
        "employee_id bigint, effective_on date, job_title string",
    )
    existing = spark.createDataFrame([("5",)], "id string")
    return staff, master, versions, existing


def test_with_active_master_needs_a_team_and_an_active_row(spark, rows):
    staff, master, _, _ = hr(spark)
    assert rows(with_active_master(staff, master), "id", "sub_team") == [(1, "s1"), (1, "s2"), (4, None), (5, "s")]


def test_missing_contract_rows(spark, rows):
    staff, _, versions, existing = hr(spark)
    out = missing_contract_rows(staff, versions, existing, ["first_name"])
    assert rows(out) == [(1, "A", "new"), (2, "B", "b"), (3, "C", "c"), (4, "D", "d1"), (4, "D", "d2")]


def test_team_contract_rows(spark, rows):
    out = team_contract_rows(*hr(spark))
    assert out.columns == ["id", "first_name", "last_name", "email", "job_title", "manager", "team_name", "sub_team"]
    assert rows(out, "id", "job_title", "sub_team") == [(1, "new", "s1"), (1, "new", "s2"), (4, "d1", None), (4, "d2", None)]


def roster(spark, *people, extra=""):
    blank = dict.fromkeys(ROSTER_COLUMNS, "")
    rows = [tuple({**blank, **p}.get(c) for c in ROSTER_COLUMNS) + ((p["sheet_row"],) if extra else ()) for p in people]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ROSTER_COLUMNS) + extra)


def solar(**fields):
    return {"full_name": "A", "company": "C", "division": "Solar", "status": "00 - Activo", "start_date": "1/2/2022", **fields}


def test_latest_contract_state_parses_before_it_compares(spark, rows):
    master = roster(
        spark,
        solar(start_date="31/01/2020", fix_salary="99.999,00"),
        solar(start_date="1/12/2022", fix_salary="9.000,00", bonus="1,5"),
        solar(start_date="01/12/2022", fix_salary="10.000,00", status="02 - Baja", end_date="3/4/2023", bonus="n/a"),
        solar(full_name="B", start_date="soon"),
        solar(full_name="D", start_date="1/1/2022", end_date="permanente"),
    )
    out = latest_contract_state(master, division_scope("Solar"))
    assert rows(out, "full_name", "status", "end_date", "fix_salary", "fix_salary_text", "bonus") == [
        ("A", "00 - Activo", None, Decimal("10000.00"), "10.000,00", Decimal("1.50"))
    ]


def test_latest_contract_diff_and_patches(spark, rows):
    master = roster(
        spark,
        solar(job_title="new", fix_salary="1.000,00", team="T"),
        solar(full_name="B", end_date="", manager="m"),
        solar(full_name="", job_title="x"),
    )
    sheet = roster(
        spark,
        solar(job_title="old", fix_salary="1000", team="T", end_date="31/12/2022", sheet_row=2),
        solar(full_name="B", end_date="", manager="m", sheet_row=3),
        solar(full_name="", job_title="y", sheet_row=4),
        solar(full_name="B", company="other", manager="z", sheet_row=5),
        extra=", sheet_row bigint",
    )
    diff = latest_contract_diff(master, sheet)
    flags = {r.sheet_row: [c[12:] for c in diff.columns if c.startswith("differences_") and r[c]] for r in diff.collect()}
    assert flags == {2: ["end_date", "job_title"], 3: []}
    assert rows(latest_contract_patches(diff)) == [
        (2, "end_date", None, "end_date", "V2"),
        (2, "job_title", "new", "job_title", "F2"),
    ]


def test_latest_contract_diff_by_id_and_without_profile(spark):
    master = roster(
        spark,
        solar(id="1", start_date="1/1/2020", status="02 - Baja"),
        solar(id="1", start_date="1/1/2021", profile="p"),
        solar(id="2", start_date="1/1/2019", status="01 - Join"),
    )
    sheet = roster(spark, solar(id="1", profile="q", sheet_row=2), extra=", sheet_row bigint")
    state = ["id", "job_title", "split", "team", "sub_team", "manager"]
    fields = ["end_date", "status", "split", "team", "sub_team", "job_title", "manager", "fix_salary", "bonus"]
    diff = latest_contract_diff(master, sheet, latest_keys=["id", "company"], state=state, fields=fields)
    assert sorted(r.status_master for r in diff.collect()) == ["00 - Activo", "01 - Join"]
    assert "differences_profile" not in diff.columns
    assert latest_contract_patches(diff, fields).count() == 1
