import pytest
from pyspark.sql import functions as F

from rosterflow.model import DIVISIONS, ROSTER_COLUMNS, ROSTER_LABELS, Division, UpdateGroup
from rosterflow.operators.roster import (
    active_filter,
    division_filter,
    project_roster,
    roster_sync_plan,
    split_by_flag,
)

FIELDS = ["division", "team", "job_title", "end_date", "full_name"]


def people(spark, *tuples):
    return spark.createDataFrame(list(tuples), ", ".join(f"{f} string" for f in FIELDS))


def test_roster_has_33_columns():
    assert len(ROSTER_COLUMNS) == len(set(ROSTER_COLUMNS)) == 33
    assert list(ROSTER_LABELS)[4] == "Apellidos, Nombre"


@pytest.mark.parametrize(
    "division, kept",
    [
        ("tech", {"t1", "t2"}),
        ("solar", {"s1"}),
        ("sales", {"v1"}),
        ("corporate", {"c1", "t2"}),
    ],
)
def test_division_rules(spark, division, kept):
    df = people(
        spark,
        ("Technology", "Data", "Dev", "", "t1"),
        ("Supply Technology", "Data", "Dev", "", "t2"),
        ("technology", "Data", "Dev", "", "lower case"),
        ("Solar", "Data", "Dev", None, "s1"),
        ("Supply", "Sales", "Rep", "", "v1"),
        ("Supply", "Sales", "Rep", "31/12/2022", "v dated"),
        ("Supply", "Sales", "Rep", None, "v null end"),
        ("Supply", "Sales Ops", "Rep", "", "v other team"),
        ("Supply", "Data", "Analyst", "", "c1"),
        ("Supply", "Data", "Ventas B2B", "", "c ventas"),
        ("Supply", "Data", "Founder", "", "c founder"),
        ("Supply", "Data", "Talent lead", "", "c talent"),
        ("Supply", "People", "Analyst", "", "c people"),
        ("Supply", "Data", "Analyst", "pending", "c p"),
        ("Supply", "Data", "Analyst", "TBD", "c tb"),
        ("Supply", None, "Analyst", "", "c null team"),
        ("Supply", "Data", None, "", "c null title"),
        ("Solar", "Data", "Dev", "", ""),
        ("Technology", "Data", "Dev", "", None),
        ("Supply", "Sales", "Rep", "", ""),
        (None, "Data", "Dev", "", "no division"),
    )
    got = division_filter(df, DIVISIONS[division]).collect()
    assert {r.full_name for r in got} == kept


def test_active_filter_on_master_and_sheet(spark, rows):
    df = spark.createDataFrame(
        [("00 - Activo", "1"), ("05 - Activo baja", "2"), ("00 - Activo", ""), ("00 - Activo", None), ("01 - Join", "3"), (None, "4")],
        "status string, id string",
    )
    assert rows(active_filter(df), "id") == [("1",), ("2",)]
    assert active_filter(df, exact=True).count() == 3


def test_project_roster_order(spark):
    df = spark.createDataFrame([tuple("x" for _ in ROSTER_COLUMNS) + (1, "y")], ", ".join(f"{c} string" for c in reversed(ROSTER_COLUMNS)) + ", row_ord bigint, other string")
    assert project_roster(df).columns == ROSTER_COLUMNS
    assert project_roster(df, keep=["row_ord"]).columns == [*ROSTER_COLUMNS, "row_ord"]


MINI = Division(
    "mini",
    lambda: F.lit(True),
    [UpdateGroup("update_1", ["title", "status"], ["title", "status", "company"]), UpdateGroup("update_manager", ["manager"])],
    key="name",
)


def mini_plan(spark, master, sheet, **kw):
    m = spark.createDataFrame(master, "name string, row_ord bigint, title string, status string, company string, manager string")
    s = spark.createDataFrame(sheet, "name string, sheet_row bigint, title string, status string, company string, manager string")
    return roster_sync_plan(m, s, MINI, **kw)


def test_flags_follow_sql_null_logic(spark, rows):
    plan = mini_plan(
        spark,
        [
            ("same", 1, "t", "s", "c", "m"),
            ("title", 2, "t2", "s", "c", "m"),
            ("null master", 3, None, "s", "c", None),
            ("null sheet", 4, "t", "s", "c", "m"),
            ("one null one diff", 5, None, "s2", "c", "m"),
            ("manager", 6, "t", "s", "c", "m2"),
            ("company only", 7, "t", "s", "c2", "m"),
            ("new", 8, "t", "s", "c", "m"),
        ],
        [
            ("same", 2, "t", "s", "c", "m"),
            ("title", 3, "t", "s", "c", "m"),
            ("null master", 4, "t", "s", "c", "m"),
            ("null sheet", 5, None, "s", "c", None),
            ("one null one diff", 6, "t", "s", "c", "m"),
            ("manager", 7, "t", "s", "c", "m"),
            ("company only", 8, "t", "s", "c", "m"),
            ("on sheet only", 9, "t", "s", "c", "m"),
        ],
    )
    assert rows(plan, "row_ord", "sheet_row", "insert_", "update_1", "update_manager") == [
        (1, 2, 0, 0, 0),
        (2, 3, 0, 1, 0),
        (3, 4, 0, 0, 0),
        (4, 5, 0, 0, 0),
        (5, 6, 0, 1, 0),
        (6, 7, 0, 0, 1),
        (7, 8, 0, 0, 0),
        (8, None, 1, 0, 0),
    ]


def test_repeated_names_pair_by_occurrence(spark, rows):
    plan = mini_plan(
        spark,
        [("two v one", 1, "a", "s", "c", "m"), ("two v one", 2, "b", "s", "c", "m"), ("one v two", 3, "a", "s", "c", "m")],
        [("two v one", 5, "a", "s", "c", "m"), ("one v two", 6, "z", "s", "c", "m"), ("one v two", 4, "a", "s", "c", "m")],
    )
    assert rows(plan, "row_ord", "sheet_row", "insert_", "update_1") == [(1, 5, 0, 0), (2, None, 1, 0), (3, 4, 0, 0)]


def test_empty_sheet_makes_everything_an_insert(spark, rows):
    plan = mini_plan(spark, [("a", 1, "t", "s", "c", "m")], [])
    assert rows(plan, "insert_", "update_1") == [(1, 0)]


def test_split_by_flag_overlaps(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0)], "u1 int, u2 int")
    parts = split_by_flag(df, ["u1", "u2"])
    assert {k: v.count() for k, v in parts.items()} == {"u1": 2, "u2": 1}


def test_group_ranges_are_read_from_the_cells():
    groups = {g.name: g for g in DIVISIONS["corporate"].groups}
    assert (groups["update_1"].first_col, groups["update_1"].last_col) == ("F", "J")
    assert (groups["update_2"].first_col, groups["update_2"].last_col) == ("M", "Q")
    assert (groups["update_salaries"].first_col, groups["update_salaries"].last_col) == ("Z", "AA")
    assert groups["update_1"].fields == ["job_title", "division", "split", "company", "status"]
    assert groups["update_2"].fields == ["profile", "seniority", "team", "sub_team"]
    assert UpdateGroup("g", ["a"]).first_col is None
