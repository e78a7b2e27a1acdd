import random

import pytest
from pyspark.sql import functions as F

from rosterflow.operators.ordinal import (
    append_rows,
    dense_ordinal,
    hot_keys,
    nth_occurrence_join,
    occurrence_number,
)


def numbered(pairs):
    """Brute force: (key, order) to place within key."""
    seen, out = {}, {}
    for key, order in sorted(pairs, key=lambda p: p[1]):
        seen[key] = seen.get(key, 0) + 1
        out[(key, order)] = seen[key]
    return out


def skewed(seed, n=600):
    rng = random.Random(seed)
    orders = rng.sample(range(-500, 5_000), n)
    keys = ["hot"] * (n // 3) + [None] * (n // 6) + [""] * (n // 6)
    keys += [f"k{rng.randrange(60)}" for _ in range(n - len(keys))]
    return list(zip(keys, orders))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot_rows, block_rows", [(None, 100), (10, 64), (150, 1_000), (10_000, 10)])
def test_occurrence_number_equals_brute_force(spark, seed, hot_rows, block_rows):
    pairs = skewed(seed)
    df = spark.createDataFrame(pairs, "k string, o bigint")
    got = occurrence_number(df, "k", "o", hot_rows=hot_rows, block_rows=block_rows).collect()
    assert {(r.k, r.o): r.n for r in got} == numbered(pairs)
    assert len(got) == len(pairs)


def test_occurrence_number_can_drop_null_keys(spark):
    pairs = skewed(3)
    df = spark.createDataFrame(pairs, "k string, o bigint")
    for hot_rows in (None, 20):
        got = occurrence_number(df, "k", "o", hot_rows=hot_rows, block_rows=50, null_keys="drop").collect()
        assert {(r.k, r.o): r.n for r in got} == {p: n for p, n in numbered(pairs).items() if p[0] is not None}
    with pytest.raises(ValueError):
        occurrence_number(df, "k", "o", null_keys="other")


def test_occurrence_number_by_two_keys(spark):
    rng = random.Random(4)
    triples = [(rng.choice(["a", None]), rng.choice(["x", "y", None]), o) for o in range(300)]
    df = spark.createDataFrame(triples, "k string, l string, o bigint")
    got = occurrence_number(df, ["k", "l"], "o", hot_rows=20, block_rows=30).collect()
    assert {((r.k, r.l), r.o): r.n for r in got} == numbered([((k, l), o) for k, l, o in triples])


def test_hot_keys_are_all_found(spark):
    df = spark.createDataFrame([(k,) for k, n in [("a", 9), ("b", 5), ("c", 7), ("d", 1)] for _ in range(n)], "k string")
    assert sorted(r.k for r in hot_keys(df, ["k"], hot_rows=4).collect()) == ["a", "b", "c"]
    assert hot_keys(df, ["k"], hot_rows=9) is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_size_of_a_key_does_not_change_its_numbers(spark, seed):
    """Null keys, partly null keys, a null order and negative orders, with and without hot keys."""
    rng = random.Random(seed)
    orders = rng.sample(range(-200, 200), 150)
    triples = [(rng.choice(["a", "b", None]), rng.choice(["x", None]), o) for o in orders]
    # one row without an order for each key: several would have no order among themselves
    triples += [(k, l, None) for k in ("a", None) for l in ("x", None)]
    df = spark.createDataFrame(triples, "k string, l string, o bigint")
    for keys in (["k"], ["k", "l"]):
        some = df if len(keys) == 2 else df.filter("o IS NOT NULL OR (l IS NULL)")
        plain = sorted(occurrence_number(some, keys, "o", hot_rows=None).collect(), key=str)
        hot = sorted(occurrence_number(some, keys, "o", hot_rows=5, block_rows=20).collect(), key=str)
        assert plain == hot and len(plain) == some.count()


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_pairing_keeps_rows_without_key_or_order(spark, hot_rows):
    master = spark.createDataFrame([("a", None), ("a", -5), ("a", 3), (None, None), (None, 1), ("b", 2)], "name string, row_ord bigint")
    sheet = spark.createDataFrame([("a", 9), ("a", 4), ("a", 6), ("a", 8), (None, 1), ("", 2)], "name string, sheet_row bigint")
    out = nth_occurrence_join(master, sheet, "name", "row_ord", hot_rows=hot_rows, block_rows=2)
    got = {(r.name, r.row_ord): (r.n, r.sheet_row) for r in out.collect()}
    assert got == {("a", None): (1, 4), ("a", -5): (2, 6), ("a", 3): (3, 8), (None, None): (1, None), (None, 1): (2, None), ("b", 2): (1, None)}


def test_sides_that_share_a_column_name_are_refused(spark):
    rows = spark.createDataFrame([("a", 1)], "name string, sheet_row bigint")
    with pytest.raises(ValueError, match="sheet_row"):
        nth_occurrence_join(rows, rows, "name", "sheet_row")


def test_dense_ordinal_counts_rows_without_an_order(spark):
    df = spark.createDataFrame([(None,), (-7,), (5,), (900,), (-1,)], "o bigint")
    got = {r.o: r.row_ord for r in dense_ordinal(df, "o", block_rows=10).collect()}
    assert got == {None: 0, -7: 1, -1: 2, 5: 3, 900: 4}


@pytest.mark.parametrize("block_rows", [7, 1_000_000])
def test_dense_ordinal_has_no_gaps(spark, block_rows):
    rng = random.Random(5)
    orders = rng.sample(range(-1_000, 100_000), 500)
    df = spark.createDataFrame([(o,) for o in orders], "o bigint")
    got = {r.o: r.row_ord for r in dense_ordinal(df, "o", block_rows=block_rows).collect()}
    assert got == {o: i for i, o in enumerate(sorted(orders))}


def test_dense_ordinal_of_nothing(spark):
    df = spark.createDataFrame([], "o bigint")
    assert dense_ordinal(df, "o").count() == 0


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_nth_occurrence_join_pairs_in_order(spark, rows, hot_rows):
    master = spark.createDataFrame(
        [("a", 1), ("a", 5), ("b", 2), ("c", 3), ("", 4), (None, 6)], "name string, row_ord bigint"
    )
    sheet = spark.createDataFrame(
        [("a", 10, "a1"), ("b", 11, "b1"), ("b", 12, "b2"), ("", 13, "blank"), (None, 14, "null")],
        "name string, sheet_row bigint, v string",
    )
    out = nth_occurrence_join(master, sheet, "name", "row_ord", hot_rows=hot_rows, block_rows=2)
    assert rows(out, "row_ord", "n", "sheet_row", "v_sheet") == [
        (1, 1, 10, "a1"),
        (2, 1, 11, "b1"),
        (3, 1, None, None),
        (4, 1, None, None),
        (5, 2, None, None),
        (6, 1, None, None),
    ]


def test_nth_occurrence_join_with_other_key_name(spark, rows):
    master = spark.createDataFrame([("a", 1)], "name string, ord bigint")
    sheet = spark.createDataFrame([("a", 2)], "name_tl string, pos bigint")
    out = nth_occurrence_join(master, sheet, "name", "ord", sheet_key="name_tl", sheet_order="pos")
    assert rows(out, "name", "pos", "n_sheet") == [("a", 2, 1)]


def test_append_rows_continues_after_the_last_row(spark, rows):
    sheet = spark.createDataFrame([("x", 2), ("y", 7)], "name string, sheet_row bigint")
    new = spark.createDataFrame([("b", 20), ("a", 3)], "name string, row_ord bigint")
    assert rows(append_rows(sheet, new, "row_ord"), "name", "sheet_row") == [("a", 8), ("b", 9)]
    empty = sheet.filter("false")
    assert rows(append_rows(empty, new, "row_ord"), "name", "sheet_row") == [("a", 2), ("b", 3)]
    assert append_rows(sheet, new.filter("false"), "row_ord").count() == 0


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_a_sheet_may_derive_from_its_master(spark, rows, hot_rows):
    master = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "name string, row_ord bigint")
    sheet = master.filter("row_ord <> 2").withColumn("sheet_row", F.col("row_ord") + 10)
    out = nth_occurrence_join(master, sheet, "name", "row_ord", hot_rows=hot_rows, block_rows=2)
    assert rows(out, "row_ord", "n", "sheet_row") == [(1, 1, 11), (2, 2, 13), (3, 3, None), (4, 1, 14)]
