import os
import uuid

import pytest

from rosterflow import sinks
from rosterflow.session import materialize, release, shared_dir


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_replace_changes_the_definition(spark, tmp_path, rows, name):
    sinks.write_replace(spark.range(2), name, str(tmp_path))
    assert rows(spark.table(name)) == [(0,), (1,)]
    sinks.write_replace(spark.range(3, 4).selectExpr("CAST(id AS STRING) AS id", "1 AS `x, y`"), name, str(tmp_path))
    assert spark.table(name).columns == ["id", "x, y"]
    assert rows(spark.table(name)) == [("3", 1)]


def test_truncate_append_keeps_the_definition(spark, tmp_path, rows, name):
    sinks.write_replace(spark.createDataFrame([("old", "1")], "b string, a string"), name, str(tmp_path))
    sinks.write_truncate_append(spark.createDataFrame([(5, "new", 0)], "a int, b string, extra int"), name, str(tmp_path))
    assert spark.table(name).dtypes == [("b", "string"), ("a", "string")]
    assert rows(spark.table(name)) == [("new", "5")]
    with pytest.raises(ValueError):
        sinks.write_truncate_append(spark.createDataFrame([(5,)], "a int"), name, str(tmp_path))


def test_a_failed_reload_leaves_the_old_rows(spark, tmp_path, rows, name):
    sinks.write_replace(spark.createDataFrame([(1,)], "a int"), name, str(tmp_path))
    broken = spark.createDataFrame([("1",), ("word",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|FAILED|word"):
        sinks.write_truncate_append(broken, name, str(tmp_path))
    assert rows(spark.table(name)) == [(1,)]


def test_a_table_can_be_replaced_by_what_is_read_from_it(spark, tmp_path, rows, name):
    sinks.publish_snapshot(spark.range(4), name, str(tmp_path))
    sinks.publish_snapshot(spark.table(name).filter("id > 1"), name, str(tmp_path))
    assert rows(spark.table(name)) == [(2,), (3,)]


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_a_reload_of_a_partitioned_table_holds_the_new_rows_alone(spark, tmp_path, rows, name, fmt):
    spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string").write.format(fmt).partitionBy("p").option(
        "path", str(tmp_path / "first")).saveAsTable(name)
    sinks.write_truncate_append(spark.createDataFrame([("a", 5), ("c", 6)], "p string, n int"), name, str(tmp_path))
    assert rows(spark.table(name), "n", "p") == [(5, "a"), (6, "c")]
    sinks.write_replace(spark.createDataFrame([("d", 7), ("c", 8)], "p string, n int"), name, str(tmp_path))
    assert rows(spark.table(name), "n", "p") == [(7, "d"), (8, "c")]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["p"]
    assert rows(spark.table(name).where("p = 'c'"), "n") == [(8,)]
    sinks.append_to(spark.createDataFrame([("e", 9)], "p string, n int"), name)
    assert spark.table(name).count() == 3


def test_a_reload_keeps_comment_and_properties(spark, tmp_path, rows, name):
    spark.sql(f"CREATE TABLE {name} (n INT COMMENT 'a number') USING parquet COMMENT 'it''s here' TBLPROPERTIES ('owner.team' = 'x')")
    sinks.write_truncate_append(spark.createDataFrame([(1,)], "n int"), name, str(tmp_path))
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert info["Comment"] == "it's here" and info["Provider"].lower() == "parquet"
    assert ("owner.team", "x") in [tuple(r) for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()]
    assert [c.description for c in spark.catalog.listColumns(name)] == ["a number"]
    assert rows(spark.table(name)) == [(1,)]


def test_a_managed_table_is_replaced_after_the_new_one_is_written(spark, tmp_path, rows, name):
    spark.createDataFrame([(1,)], "n int").write.saveAsTable(name)
    with pytest.raises(Exception, match="boom"):
        sinks.write_replace(spark.range(1).selectExpr("raise_error('boom') AS s"), name, str(tmp_path))
    assert rows(spark.table(name)) == [(1,)]
    sinks.write_replace(spark.createDataFrame([("x",)], "s string"), name, str(tmp_path))
    assert rows(spark.table(name)) == [("x",)]


def test_old_versions_go(spark, tmp_path, rows, name):
    for n in range(4):
        sinks.write_replace(spark.range(n, n + 1), name, str(tmp_path), keep_versions=2)
        assert rows(spark.table(name)) == [(n,)]
    assert len(list((tmp_path / name).glob("version=*"))) == 2


def test_append_to_goes_by_name(spark, tmp_path, rows, name):
    sinks.write_replace(spark.createDataFrame([(1, "a")], "n int, s string"), name, str(tmp_path))
    sinks.append_to(spark.createDataFrame([("b", 2)], "s string, n int"), name)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]


def test_export_csv_has_a_header_and_no_index(spark, tmp_path):
    sinks.export_csv(spark.createDataFrame([("Doe, J", 1)], "`full name` string, n int").coalesce(1), str(tmp_path / "c"))
    (part,) = (tmp_path / "c").glob("part-*.csv")
    assert part.read_text().splitlines() == ["full name,n", '"Doe, J",1']


def test_stage_export(spark, tmp_path):
    sinks.stage_export(spark.range(3), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3


def test_route_by_team_writes_known_teams_only(spark, tmp_path):
    df = spark.createDataFrame([("Data", 1), ("Ops", 2), ("Data", 3), ("Old", 4), (None, 5)], "team_name string, id int")
    teams = spark.createDataFrame([("Data",), ("Ops",), ("Idle",)], "name string")
    sinks.route_by_team(df, teams, str(tmp_path / "r"))
    assert sorted(p.name for p in (tmp_path / "r").glob("team_name=*")) == ["team_name=Data", "team_name=Ops"]
    assert spark.read.parquet(str(tmp_path / "r")).count() == 3


def test_shared_dir_is_stable(spark):
    assert shared_dir(spark) == shared_dir(spark)


def test_materialize_keeps_rows_and_schema(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (2, [3], "b")], "n int, ids array<bigint>, `x, y` string")
    out = materialize(df)
    assert out.schema == df.schema
    assert rows(out, "n", "x, y") == rows(df, "n", "x, y")
    assert "Scan parquet" in out._jdf.queryExecution().executedPlan().toString()


def test_released_frames_leave_no_files(spark):
    frame = materialize(spark.range(5), "gone")
    path = frame.materialized_at.removeprefix("file://")
    assert os.path.isdir(path) and frame.count() == 5
    release(frame)
    assert not os.path.exists(path)
