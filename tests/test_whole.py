"""Loaders at their declared widths, and the append job."""

import pytest

from rosterflow.model import ROSTER_LABELS, SHEET_WIDTHS, STAFF_COLUMNS
from rosterflow.plans import append_staff
from rosterflow.sources import load_sheet

LABELS = list(ROSTER_LABELS)


def grid(spark, header, *rows):
    cells = [(0, header), *((i, list(r)) for i, r in enumerate(rows, 1))]
    return spark.createDataFrame(cells, "row_ord bigint, cells array<string>")


@pytest.mark.parametrize("name", list(SHEET_WIDTHS))
def test_loaders_keep_the_declared_width(spark, name):
    width = SHEET_WIDTHS[name]
    header = [*LABELS, *(f"more {i}" for i in range(120))]
    loaded = load_sheet(grid(spark, header, [str(i) for i in range(153)], ["short"]), name)
    assert len(loaded.columns) == width + 1
    first, second = loaded.collect()
    assert first[0] == "0" and first[width - 1] == str(width - 1)
    assert (first[width], second[width]) == ((0, 1) if name == "master" else (2, 3))
    assert loaded.columns[-1] == ("row_ord" if name == "master" else "sheet_row")
    assert second[0] == "short" and set(second[1:width]) == {""}


def test_loaders_take_narrow_and_empty_sheets_and_refuse_unknown_ones(spark):
    assert load_sheet(grid(spark, LABELS[:3], ["a", "b", "c"]), "sales").columns == ["gender", "location", "id", "sheet_row"]
    assert load_sheet(grid(spark, LABELS), "tech").count() == 0
    with pytest.raises(ValueError, match="no width is declared"):
        load_sheet(grid(spark, LABELS), "marketing")
    two = grid(spark, LABELS).selectExpr("'A' AS sheet", "*").unionByName(grid(spark, LABELS, ["x"]).selectExpr("'B' AS sheet", "*"))
    assert load_sheet(two, "tech", sheet="B").head().gender == "x"


MASTER = "row_ord bigint, full_name string, company string, division string, status string, split string, pct_em string"


def test_append_job(spark):
    master = spark.createDataFrame(
        [
            (5, "New", "A", "Solar", "01 - Join", "HQ", "10"),
            (3, "New", "A", "Solar", "01 - Join", "HQ", "20"),  # differs in a column that the sheet lacks
            (4, "Old", "A", "Solar", "00 - Activo", "HQ", "0"),
            (1, "Old", "B", "Solar", "00 - Activo", "HQ", "0"),
            (2, "Gone", "A", "Solar", "02 - Baja", "HQ", "0"),
            (6, "Other", "A", "Supply", "00 - Activo", "HQ", "0"),
            (7, None, "A", "Solar", "00 - Activo", None, "0"),
        ],
        MASTER,
    )
    sheet = spark.createDataFrame([(9, "Old", "A"), (4, None, "B")], "sheet_row bigint, full_name string, company string")
    new = append_staff(master, sheet)
    assert new.columns == [*STAFF_COLUMNS, "sheet_row"]
    rows = [(r.sheet_row, r.full_name, r.company, r.split, r.q, r.gender) for r in new.orderBy("sheet_row").collect()]
    assert rows == [(10, "Old", "B", "HQ", None, None), (11, "New", "A", "HQ", None, None), (12, None, "A", None, None, None)]
    empty = append_staff(master, sheet.limit(0))
    assert [r.sheet_row for r in empty.orderBy("sheet_row").collect()] == [2, 3, 4, 5]
    assert append_staff(master.limit(0), sheet).count() == 0


def test_the_master_grid_has_every_cell_and_no_method_too_long_to_compile(spark, tmp_path):
    from acceptance import whole

    rows = [(1, 7, "O", 1234.5, "1-URGENT"), (2, None, None, None, None), (None, 8, "F", 2.0, "2-HIGH")]
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string")
    orders.selectExpr("*", "timestamp '1995-03-04 00:00:00' AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    grid = {r.row_ord: r.cells for r in whole._grid(spark, str(tmp_path), "master").collect()}
    assert grid[2][33:] == [f"extra_{i}-1" for i in range(34, 104)] and grid[3][33:] == [f"extra_{i}-2" for i in range(34, 104)]
    assert len(grid[2]) == 103 and grid[2][6] == "Technology" and grid[None][33:] == [None] * 70
    loaded = whole.load_sheet_master(spark, str(tmp_path))
    assert {(r.row_ord, r.extra_34, r.extra_100) for r in loaded.collect()} == {(1, "extra_34-1", "extra_100-1"), (2, "extra_34-2", "extra_100-2")}
    codes = loaded._jdf.queryExecution().debug().codegenToSeq()
    assert all(codes.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(codes.size()))
