import pytest
from pyspark.errors import PySparkException

from rosterflow.model import UpdateGroup
from rosterflow.operators.patch import apply_patches, build_field_patches, build_patches, rejected_patches

GROUPS = [
    UpdateGroup("u1", ["title"], ["title", "company"], {"title": "F", "company": "H"}),
    UpdateGroup("u2", ["manager"], cells={"manager": "AB"}),
]
PLAN = "sheet_row bigint, u1 int, u2 int, title string, company string, manager string"


def plan(spark):
    return spark.createDataFrame(
        [(2, 1, 0, "t", "c", "m"), (3, 0, 1, "t", "c", None), (4, 1, 1, "x", None, "y"), (5, 0, 0, "n", "n", "n"), (None, 0, 0, "new", "c", "m")],
        PLAN,
    )


def test_a_group_writes_all_its_fields(spark, rows):
    out = build_patches(plan(spark), GROUPS)
    assert rows(out) == [
        (2, "company", "c", "u1"),
        (2, "title", "t", "u1"),
        (3, "manager", None, "u2"),
        (4, "company", None, "u1"),
        (4, "manager", "y", "u2"),
        (4, "title", "x", "u1"),
    ]


def test_ranges_and_cells(spark, rows):
    out = build_patches(plan(spark), GROUPS, ranges=True)
    assert rows(out, "field", "range", "cell") == [
        ("company", "F2:H2", "H2"),
        ("company", "F4:H4", "H4"),
        ("manager", "AB3:AB3", "AB3"),
        ("manager", "AB4:AB4", "AB4"),
        ("title", "F2:H2", "F2"),
        ("title", "F4:H4", "F4"),
    ]


def test_no_flag_gives_no_patch(spark):
    assert build_patches(plan(spark).filter("sheet_row = 5"), GROUPS).count() == 0


def test_field_patches(spark, rows):
    diff = spark.createDataFrame(
        [(2, True, False, "a", "b"), (3, True, True, None, "d"), (4, False, None, "e", "f")],
        "sheet_row bigint, differences_x boolean, differences_y boolean, x_new string, y_new string",
    )
    out = build_field_patches(diff, {"x": "x_new", "y": "y_new"}, {"x": "J", "y": "K"})
    assert rows(out) == [(2, "x", "a", "x", "J2"), (3, "x", None, "x", "J3"), (3, "y", "d", "y", "K3")]


def sheet(spark):
    return spark.createDataFrame(
        [(2, "a", "old", 1), (3, "b", "old", 2), (4, "c", None, 3)], "sheet_row bigint, name string, title string, level bigint"
    )


def patches(spark, *items):
    return spark.createDataFrame(list(items), "sheet_row bigint, field string, value string, seq int")


def test_apply_keeps_unpatched_cells_and_can_set_null(spark, rows):
    todo = patches(spark, (2, "title", "new", 1), (3, "title", None, 1), (4, "level", "9", 1), (99, "title", "nowhere", 1))
    out = apply_patches(sheet(spark), todo, ["title", "level"], unknown="skip")
    assert out.schema == sheet(spark).schema
    assert rows(out) == [(2, "a", "new", 1), (3, "b", None, 2), (4, "c", None, 9)]


def test_two_patches_for_a_cell_fail(spark):
    todo = patches(spark, (2, "title", "one", 1), (2, "title", "two", 2))
    with pytest.raises(PySparkException, match="more than one patch for title in row 2"):
        apply_patches(sheet(spark), todo, ["title"]).collect()


def test_or_the_last_by_order_wins(spark, rows):
    todo = patches(spark, (2, "title", "one", 2), (2, "title", "first", 1), (3, "title", "x", 1), (3, "title", None, 2))
    out = apply_patches(sheet(spark), todo, ["title"], duplicates="last", order="seq")
    assert rows(out, "sheet_row", "title") == [(2, "one"), (3, None), (4, None)]


def test_bad_arguments(spark):
    todo = patches(spark, (2, "title", "one", 1))
    with pytest.raises(ValueError):
        apply_patches(sheet(spark), todo, ["title"], duplicates="first")
    with pytest.raises(ValueError):
        apply_patches(sheet(spark), todo, ["title"], duplicates="last")


def test_no_patches_leave_the_sheet_alone(spark, rows):
    assert rows(apply_patches(sheet(spark), patches(spark, (2, "x", "", 1)).filter("false"), ["title"])) == rows(sheet(spark))


def test_patches_for_unknown_rows_and_fields(spark, rows):
    for todo, text in ((patches(spark, (99, "title", "x", 1)), "99"), (patches(spark, (2, "nothing", "x", 1)), "unknown field")):
        with pytest.raises(Exception, match=text):
            apply_patches(sheet(spark), todo, ["title"]).collect()
        assert rows(apply_patches(sheet(spark), todo, ["title"], unknown="skip")) == rows(sheet(spark))
        assert rejected_patches(sheet(spark), todo, ["title"]).count() == 1


def test_the_last_patch_wins_without_an_order_and_in_a_tie(spark, rows):
    todo = patches(spark, (2, "title", "a", None), (2, "title", "b", None))
    got = {r.sheet_row: r.title for r in apply_patches(sheet(spark), todo, ["title"], duplicates="last", order="seq").collect()}
    assert got[2] == "b"
