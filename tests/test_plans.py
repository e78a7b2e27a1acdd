"""Whole jobs, and what must always hold for them."""

import random

import pytest
from pyspark.sql import functions as F

from rosterflow.model import DIVISIONS, ROSTER_COLUMNS, ROSTER_LABELS
from rosterflow.operators.roster import division_filter
from rosterflow.plans import master_snapshot, roster_diff_report, roster_sync, team_sheet_table
from rosterflow.plans.report import REPORT_FIELDS, REPORT_FIELDS_BY_ID
from rosterflow.session import materialize
from rosterflow.sources import roster_from_grid

MASTER = ", ".join(f"{c} string" for c in ROSTER_COLUMNS) + ", row_ord bigint"
SHEET = ", ".join(f"{c} string" for c in ROSTER_COLUMNS) + ", sheet_row bigint"


def random_rosters(spark, seed, n=80, division="Solar"):
    rng = random.Random(seed)

    def person(i):
        row = {c: rng.choice(["a", "b"]) for c in ROSTER_COLUMNS}
        row.update(
            full_name=rng.choice(["hot"] * 10 + [f"p{j}" for j in range(25)] + ["", None]),
            division=rng.choice([division, division, "Other"]),
            status=rng.choice(["00 - Activo", "01 - Join"]),
            manager=rng.choice(["m1", "m2", None]),
            id=rng.choice(["1", "2", "", None]),
            end_date="",
        )
        return row

    master = [person(i) for i in range(n)]
    sheet = []
    for row in master:
        if row["division"] == division and rng.random() < 0.7:
            changed = dict(row)
            for field in ("job_title", "manager", "team", "fix_salary", "end_date"):
                if rng.random() < 0.2:
                    changed[field] = rng.choice(["changed", None])
            sheet.append(changed)
    rng.shuffle(sheet)
    m = spark.createDataFrame([tuple(r[c] for c in ROSTER_COLUMNS) + (i * 3,) for i, r in enumerate(master)], MASTER)
    s = spark.createDataFrame([tuple(r[c] for c in ROSTER_COLUMNS) + (i + 2,) for i, r in enumerate(sheet)], SHEET)
    return m, s


@pytest.mark.parametrize("seed, numbering", [(1, {}), (2, {"hot_rows": 3, "block_rows": 20})])
def test_sync_invariants(spark, rows, seed, numbering):
    division = DIVISIONS["solar"]
    master, sheet = random_rosters(spark, seed)
    sync = roster_sync(master, sheet, division, reuse="table", **numbering)
    plan = sync.plan.collect()
    flags = [g.name for g in division.groups]

    assert len(plan) == division_filter(master, division).count()
    assert not [r for r in plan if r.insert_ and any(r[f] for f in flags)]
    assert all((r.sheet_row is None) == bool(r.insert_) for r in plan)
    assert sync.inserts.count() == sum(r.insert_ for r in plan)

    sizes = {g.name: len(g.fields) for g in division.groups}
    assert sync.patches.count() == sum(sizes[f] for r in plan for f in flags if r[f])

    new_sheet = sync.new_sheet
    assert new_sheet.columns == sheet.columns
    last = sheet.agg(F.max("sheet_row")).first()[0]
    numbers = sorted(r.sheet_row for r in new_sheet.select("sheet_row").collect())
    assert numbers == list(range(2, last + 1 + sync.inserts.count()))

    # Inserts are in the master's order, so a second run pairs the same rows.  What it
    # still finds is a field that is null on the master: SQL null logic flags none.
    again = roster_sync(master, materialize(new_sheet), division, reuse="table", **numbering)
    assert again.inserts.count() == 0
    assert again.patches.count() == 0


def test_sync_equals_brute_force(spark):
    division = DIVISIONS["solar"]
    master, sheet = random_rosters(spark, 3)
    by_name = {}
    for r in sorted(sheet.collect(), key=lambda r: r.sheet_row):
        by_name.setdefault(r.full_name, []).append(r)
    expected, seen = {}, {}
    for m in sorted(master.collect(), key=lambda r: r.row_ord):
        if "Solar" not in (m.division or "") or not m.full_name:
            continue
        n = seen[m.full_name] = seen.get(m.full_name, 0) + 1
        partners = by_name.get(m.full_name, [])
        s = partners[n - 1] if n <= len(partners) else None
        ne = lambda f: s is not None and None not in (m[f], s[f]) and m[f] != s[f]
        expected[m.row_ord] = (
            s.sheet_row if s else None,
            int(s is None),
            *[int(any(ne(f) for f in g.compare)) for g in division.groups],
        )
    columns = ["sheet_row", "insert_", *[g.name for g in division.groups]]
    plan = roster_sync(master, sheet, division).plan
    assert {r.row_ord: tuple(r[c] for c in columns) for r in plan.collect()} == expected


@pytest.mark.parametrize("reuse", ["persist", "table"])
def test_reuse_does_not_change_results(spark, rows, reuse):
    master, sheet = random_rosters(spark, 4)
    lazy = roster_sync(master, sheet, DIVISIONS["solar"])
    kept = roster_sync(master, sheet, DIVISIONS["solar"], reuse=reuse)
    assert rows(kept.new_sheet) == rows(lazy.new_sheet)
    if reuse == "persist":
        kept.plan.unpersist()
    with pytest.raises(ValueError):
        roster_sync(master, sheet, DIVISIONS["solar"], reuse="other")


def test_sheet_only_columns_stay_empty_in_inserts(spark, rows):
    master, sheet = random_rosters(spark, 5)
    noted = sheet.filter("false").withColumn("note", F.lit("n"))
    out = roster_sync(master, noted, DIVISIONS["solar"]).inserts
    assert {r.note for r in out.collect()} == {None}


def test_snapshot_holds_each_master_row_once(spark):
    master, _ = random_rosters(spark, 6)
    out = master_snapshot(master, DIVISIONS["solar"])
    assert out.columns == ROSTER_COLUMNS
    assert out.count() == division_filter(master, DIVISIONS["solar"]).count()


def test_report_equals_brute_force(spark):
    master, sheet = random_rosters(spark, 7)
    expected = []
    for m in master.collect():
        for s in sheet.collect():
            if not m.full_name or m.full_name != s.full_name or "Activo" not in m.status or not m.id:
                continue
            if s.status != "00 - Activo":
                continue
            if any(m[f] is None or s[f] is None or m[f] != s[f] for f in REPORT_FIELDS):
                expected.append((m.full_name, s.sheet_row, m.job_title, s.job_title))
    out = roster_diff_report(master, sheet, "solar")
    got = [(r.full_name, r.sheet_row, r.job_title_master, r.job_title_solar) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected)) and expected


def test_report_by_id_and_scope(spark):
    master, sheet = random_rosters(spark, 8)
    by_id = roster_diff_report(master, sheet, "sheet", ["id", "company"], REPORT_FIELDS_BY_ID, active_sheet=False)
    assert by_id.columns[:4] == ["id", "company", "job_title_master", "job_title_sheet"]
    assert by_id.filter("id = '' OR id IS NULL").count() == 0
    none = roster_diff_report(master, sheet, "solar", scope=F.col("division") == "nowhere")
    assert none.count() == 0


def test_team_sheet_table(spark, rows):
    grids = spark.createDataFrame(
        [("chapter_lead_T", 0, ["id"]), ("chapter_lead_T", 1, ["1"]), ("chapter_lead_U", 0, ["id"]), ("chapter_lead_U", 1, ["2"])],
        "sheet string, row_ord bigint, cells array<string>",
    )
    staff = spark.createDataFrame([("T",), ("T",), (None,)], "team_name string")
    assert rows(team_sheet_table(grids, staff, ["id"])) == [("T", 2, "1")]


def as_grid(spark, name, labels, cells):
    rows = [(name, 0, list(labels))] + [(name, i, row) for i, row in enumerate(cells, start=1)]
    return spark.createDataFrame(rows, "sheet string, row_ord bigint, cells array<string>")


def test_from_grids_to_a_new_sheet(spark, rows):
    """Two sheets as delivered, through the sync, to the rows the sheet then holds."""
    labels = [label for label in ROSTER_LABELS if label != "% EM"]

    def cells(**fields):
        return [fields.get(ROSTER_LABELS[label], "") for label in labels]

    ana = {"full_name": "Doe, Ana", "division": "Technology", "status": "00 - Activo", "company": "A"}
    master = roster_from_grid(
        as_grid(
            spark,
            "Master",
            labels,
            [cells(**ana, job_title="Lead"), cells(**ana, job_title="Dev"), cells(full_name="", division="Technology"), cells(full_name="X", division="Solar")],
        ),
        100,
        row_col="row_ord",
    )
    sheet = roster_from_grid(as_grid(spark, "Tech", [*labels, "Note"], [[*cells(**ana, job_title="Dev"), "keep"]]))
    sync = roster_sync(master, sheet, DIVISIONS["tech"])
    assert rows(sync.patches, "sheet_row", "field", "value") == [
        (2, "company", "A"), (2, "division", "Technology"), (2, "job_title", "Lead"), (2, "split", ""), (2, "status", "00 - Activo")]
    assert rows(sync.new_sheet, "sheet_row", "full_name", "job_title", "Note") == [
        (2, "Doe, Ana", "Lead", "keep"), (3, "Doe, Ana", "Dev", None)]
