import json

import pytest
from pyspark.sql import functions as F

from rosterflow import sources
from rosterflow.sources.grid import header_names
from rosterflow.sources.records import EMPLOYEES_SCHEMA, TEAMS_SCHEMA

GRID = "sheet string, row_ord bigint, cells array<string>"


def test_header_names():
    assert header_names(["a", "", None, "a", "A", "b "]) == ["a", "column_2", "column_3", "a_2", "A_3", "b"]
    with pytest.raises(ValueError):
        header_names(["a", "a"], "fail")


def grid(spark):
    return spark.createDataFrame(
        [
            ("s", 0, ["Id", "Apellidos, Nombre", "", "Id", "cut"]),
            ("s", 1, ["1", "Doe, J", "x", "9", "z"]),
            ("s", 2, ["2"]),
            ("s", 3, ["3", None, "", "", "z", "more"]),
        ],
        GRID,
    )


def test_promote_header(spark, rows):
    out = sources.promote_header(grid(spark), max_cols=4)
    assert out.columns == ["Id", "Apellidos, Nombre", "column_3", "Id_2", "sheet_row"]
    assert [tuple(r) for r in out.orderBy("sheet_row").collect()] == [
        ("1", "Doe, J", "x", "9", 2), ("2", "", "", "", 3), ("3", "", "", "", 4)]
    assert len(sources.promote_header(grid(spark), row_col=None).columns) == 5


def test_promote_header_needs_a_header(spark):
    with pytest.raises(ValueError):
        sources.promote_header(grid(spark).filter("row_ord > 0"))
    assert sources.promote_header(grid(spark).filter("row_ord = 0")).count() == 0


def test_union_team_sheets(spark, rows):
    grids = spark.createDataFrame(
        [
            ("chapter_lead_Data", 0, ["id", "name"]),
            ("chapter_lead_Data", 1, ["1", "a"]),
            ("chapter_lead_Data", 2, ["2"]),
            ("chapter_lead_Ops", 0, [" name", "id", "other"]),
            ("chapter_lead_Ops", 1, ["b", "3", "second"]),
            ("chapter_lead_Short", 0, ["id"]),
            ("chapter_lead_Short", 1, ["4", "beyond the header"]),
            ("chapter_lead_Unknown", 0, ["id", "name"]),
            ("chapter_lead_Unknown", 1, ["5", "c"]),
            ("my chapter_lead_Data", 0, ["id", "name"]),
            ("my chapter_lead_Data", 1, ["6", "d"]),
        ],
        GRID,
    )
    teams = spark.createDataFrame([("Data",), ("Data",), ("Ops",), ("Short",), ("Headless",), (None,)], "team string")
    out = sources.union_team_sheets(grids, teams, ["id", "name"])
    assert rows(out) == [("Data", 2, "1", "a"), ("Data", 3, "2", ""), ("Ops", 2, "3", "b"), ("Short", 2, "4", None)]


def test_json_records_in_both_forms(spark, tmp_path, rows):
    records = [{"id": 1, "name": "Data", "employee_ids": [1, 2], "unknown": True}, {"id": 2, "name": "Ops", "employee_ids": []}]
    (tmp_path / "array.json").write_text(json.dumps(records, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in records))
    whole = sources.read_json_records(spark, str(tmp_path / "array.json"), TEAMS_SCHEMA, multiline=True)
    lines = sources.read_json_records(spark, str(tmp_path / "lines.json"), TEAMS_SCHEMA)
    assert rows(whole, "id", "name", F.size("employee_ids")) == [(1, "Data", 2), (2, "Ops", 0)]
    assert rows(lines, "id", "name", F.size("employee_ids")) == rows(whole, "id", "name", F.size("employee_ids"))
    assert "legal_entity_id" in EMPLOYEES_SCHEMA


def test_talent_scores(spark, tmp_path, rows):
    (tmp_path / "scores.csv").write_text("Performance,Potential\n3,2\n1,\n,3\n")
    out = sources.read_talent_scores(spark, str(tmp_path / "scores.csv"))
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "int"]
    assert rows(out) == [(None, 3), (1, None), (3, 2)]


def test_jdbc_options():
    base = sources.jdbc_options("jdbc:x:y", query="select 1", user="u")
    assert base == {"url": "jdbc:x:y", "fetchsize": "160000", "user": "u", "query": "select 1"}
    assert sources.jdbc_options("jdbc:x:y", table="t", fetchsize=1_000)["dbtable"] == "t"
    split = sources.jdbc_options("jdbc:x:y", query="select 1", partition=("id", 0, 100, 8))
    assert "query" not in split
    assert split["dbtable"] == "(select 1) AS source"
    assert [split[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["id", "0", "100", "8"]
    with pytest.raises(ValueError):
        sources.jdbc_options("jdbc:x:y")
    with pytest.raises(ValueError):
        sources.jdbc_options("jdbc:x:y", query="q", table="t")


def test_read_table_from_path_and_catalog(spark, tmp_path, rows):
    spark.range(3).selectExpr("id", "id * 2 AS twice").write.parquet(str(tmp_path / "t"))
    assert rows(sources.read_table(spark, str(tmp_path / "t"), ["twice"])) == [(0,), (2,), (4,)]
    sources.read_table(spark, str(tmp_path / "t")).createOrReplaceTempView("some_table")
    assert sources.read_table(spark, "some_table").columns == ["id", "twice"]


def test_row_ord_counts_through_files(spark, tmp_path):
    for i, n in enumerate([3, 0, 5, 1]):
        frame = spark.range(n).selectExpr(f"concat('{i}-', id) AS v").coalesce(1)
        frame.write.parquet(str(tmp_path / f"in/part={i}"))
    out = sources.read_with_row_ord(spark, str(tmp_path / "in"))
    got = [(r.row_ord, r.v) for r in out.orderBy("row_ord").collect()]
    assert [o for o, _ in got] == list(range(9))
    assert [v for _, v in got] == ["0-0", "0-1", "0-2", "2-0", "2-1", "2-2", "2-3", "2-4", "3-0"]


def test_read_recruiting(spark):
    wide = spark.createDataFrame([tuple(range(20))], ", ".join(f"{c} int" for c in dict.fromkeys([*sources.CANDIDATE_COLUMNS, "x", "y", "z"])))
    assert sources.read_recruiting(spark, "candidates", wide).columns == sources.CANDIDATE_COLUMNS
    assert len(sources.JOB_COLUMNS) == 11 and len(sources.CANDIDATE_COLUMNS) == 17
    with pytest.raises(KeyError):
        sources.read_recruiting(spark, "other", wide)


def test_a_filled_cell_beyond_the_header_fails(spark):
    grid = spark.createDataFrame([("s", 0, ["id"]), ("s", 1, ["1", "lost"]), ("s", 2, ["2", " "])], "sheet string, row_ord bigint, cells array<string>")
    with pytest.raises(Exception, match="beyond the header"):
        sources.promote_header(grid).collect()
    assert sources.promote_header(grid, max_cols=1).count() == 2
    assert sources.promote_header(grid.filter("row_ord <> 1")).count() == 1


def test_two_sheets_are_not_mixed(spark):
    grid = spark.createDataFrame(
        [("s", 0, ["id", "n"]), ("s", 1, ["1", "a"]), ("t", 0, ["n", "id"]), ("t", 1, ["b", "2"])], "sheet string, row_ord bigint, cells array<string>")
    with pytest.raises(ValueError, match="more than one header"):
        sources.promote_header(grid)
    assert [(r.id, r.n) for r in sources.promote_header(grid, sheet="t").collect()] == [("2", "b")]


def test_team_sheets_need_one_clear_header(spark):
    teams = spark.createDataFrame([("X",)], "team string")
    grid = lambda *rows: spark.createDataFrame([("chapter_lead_X", *r) for r in rows], "sheet string, row_ord bigint, cells array<string>")
    with pytest.raises(Exception, match="no header"):
        sources.union_team_sheets(grid((1, ["1"])), teams, ["id"]).collect()
    with pytest.raises(Exception, match="used twice"):
        sources.union_team_sheets(grid((0, ["id", " id "]), (1, ["1", "2"])), teams, ["id"]).collect()
    assert [r.id for r in sources.union_team_sheets(grid((0, ["n", " id "]), (1, ["1", "2"])), teams, ["id"]).collect()] == ["2"]


def test_broken_records_fail(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": broken}\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_json_records(spark, str(tmp_path / "a.json"), "id bigint").collect()
    (tmp_path / "a.csv").write_text("Performance,Potential\n1,2\nhigh,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_talent_scores(spark, str(tmp_path / "a.csv")).collect()
