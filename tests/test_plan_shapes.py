"""Physical plans: what must not be in them, and how often they shuffle."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (fills the registry)
from acceptance.registry import QUERIES
from acceptance.standins import URGENT, narrow_master, narrow_sheet, table
from rosterflow.operators.contracts import latest_by_rank
from rosterflow.operators.joins import anti_join
from rosterflow.operators.ordinal import dense_ordinal
from rosterflow.operators.roster import roster_sync_plan

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def large_plans(spark):
    """Plan as for tables too large to broadcast, before adaptive execution."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range|single|Single|RoundRobin)", text))


WINDOWS_OVER_COUNTS = {
    # Their one-partition windows run over block, file or box counts, not over rows.
    "dense_ordinal", "dense_ordinal_null_order", "occurrence_number_hot_keys", "read_with_row_ord", "roster_sync", "roster_sync_inserts",
    "talent_matrix",
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_no_python_no_global_window(large_plans, name):
    text = plan_of(QUERIES[name](large_plans, SMALL))
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text
    assert not re.search(r"Python|Pandas|Arrow", text)
    if name not in WINDOWS_OVER_COUNTS:
        assert "SinglePartition" not in text or "Window" not in text


def test_the_default_searches_hot_keys_once(large_plans, monkeypatch):
    """One aggregation over the keys of both sides, then one shuffle of the rows and no join."""
    from rosterflow.operators import ordinal

    searches = []
    search = ordinal.hot_keys
    monkeypatch.setattr(ordinal, "hot_keys", lambda *a, **k: searches.append(a) or search(*a, **k))
    plan = roster_sync_plan(narrow_master(large_plans, SMALL), narrow_sheet(large_plans, SMALL), URGENT, "ord")
    assert len(searches) == 1
    assert shuffles(plan_of(plan)) == 1 and "Join" not in plan_of(plan)


def test_the_new_sheet_is_not_folded_from_cells(large_plans):
    from rosterflow.plans import roster_sync

    sync = roster_sync(narrow_master(large_plans, SMALL), narrow_sheet(large_plans, SMALL), URGENT, "ord", reuse="table")
    text = plan_of(sync.new_sheet)
    assert "Generate" not in text and "SortAggregate" not in text


def test_sync_shuffles_each_side_once_and_joins_nothing(large_plans):
    plan = roster_sync_plan(
        narrow_master(large_plans, SMALL), narrow_sheet(large_plans, SMALL), URGENT, "ord", hot_rows=None
    )
    assert shuffles(plan_of(plan)) == 1  # of both sides together
    assert "Join" not in plan_of(plan)
    flags = plan_of(plan.select("ord", "insert_"))
    assert "o_totalprice" not in flags  # columns that nobody reads are not shuffled


def test_a_hot_left_side_can_be_split(large_plans):
    """Both children of the anti join are shuffles, as adaptive skew handling needs."""
    left = table(large_plans, SMALL, "orders").select("o_custkey", "o_orderstatus")
    right = table(large_plans, SMALL, "events").select(F.col("user_id").alias("o_custkey"))
    text = plan_of(anti_join(left, right, ["o_custkey"]))
    below = text[text.index("SortMergeJoin"):].splitlines()
    assert len([x for x in below if re.match(r"^\W*(\*\(\d+\) )?Sort ", x)]) == 2
    for i, line in enumerate(below):
        if re.match(r"^\W*(\*\(\d+\) )?Sort ", line):
            assert "Exchange" in below[i + 1]


def test_hot_keys_are_joined_on_key_and_place(large_plans):
    plan = roster_sync_plan(
        narrow_master(large_plans, SMALL), narrow_sheet(large_plans, SMALL), URGENT, "ord", hot_rows=3, block_rows=10
    )
    text = plan_of(plan)
    assert len(re.findall(r"Exchange hashpartitioning\(emp_name#\d+, n#\d+L?, \d+\), REPARTITION_BY_COL", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(emp_name_sheet#\d+, n_sheet#\d+L?, \d+\), REPARTITION_BY_COL", text)) == 1


def test_sheet_side_is_pruned_and_filters_reach_the_scan(large_plans):
    plan = roster_sync_plan(
        table(large_plans, SMALL, "orders").selectExpr(
            "o_orderkey AS row_ord", "o_orderpriority AS division", "o_orderstatus AS emp_name", "o_orderstatus AS status",
            "o_orderpriority AS team", "o_orderpriority AS job_title", "o_orderpriority AS manager", "o_totalprice AS fix_salary",
        ),
        narrow_sheet(large_plans, SMALL),
        URGENT,
        "row_ord",
        hot_rows=None,
    )
    text = plan_of(plan)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", text)
    assert any("StringContains(o_orderpriority,URGENT)" in p for p in pushed)
    assert "o_orderdate" not in text


def test_latest_by_rank_has_no_window(large_plans):
    orders = table(large_plans, SMALL, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    text = plan_of(latest_by_rank(orders, "o_custkey", "o_orderdate"))
    assert "Window" not in text
    assert "partial_max" in text


def test_dense_ordinal_shuffles_rows_once(large_plans):
    orders = table(large_plans, SMALL, "orders").withColumn("x", F.col("o_orderkey"))
    text = plan_of(dense_ordinal(orders, "x"))
    wide = [line for line in text.splitlines() if "Exchange" in line]
    assert len(wide) == 4  # rows by block; block counts: combined, gathered, and back to their blocks
