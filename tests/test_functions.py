import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterflow.functions import (
    any_differs,
    blank_to_null,
    cast_key,
    compose_maps,
    date_text,
    differs,
    end_date_or_sentinel,
    filled,
    first_match,
    load_stamp,
    map_values,
    parse_amount,
    parse_date,
    scale_hundredths,
    sentinel_to_null,
    seven_box,
    sheet_team,
    split_name,
)
from rosterflow.functions.mapping import shadowed_rules

D = datetime.date


def one(spark, values, fn, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
    out = df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in out]


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("sql", [False, True, None, None, None]),
        ("legacy", [False, True, True, True, True]),
        ("safe", [False, True, True, True, False]),
    ],
)
def test_differs_in_three_null_logics(spark, mode, expected):
    df = spark.createDataFrame(
        [(0, "a", "a"), (1, "a", "b"), (2, None, "b"), (3, "a", None), (4, None, None)], "i int, l string, r string"
    )
    got = df.select("i", differs(F.col("l"), F.col("r"), mode).alias("d")).orderBy("i").collect()
    assert [r.d for r in got] == expected


def test_differs_refuses_other_modes(spark):
    with pytest.raises(ValueError):
        differs(F.lit(1), F.lit(2), "other")


def test_any_differs_is_true_when_one_pair_is(spark):
    df = spark.createDataFrame([("a", "a", None, "x")], "a string, b string, c string, d string")
    pairs = [(F.col("a"), F.col("b")), (F.col("c"), F.col("d"))]
    assert df.select(any_differs(pairs, "safe")).first()[0] is True
    assert df.select(any_differs(pairs, "sql")).first()[0] is None


def test_parse_date_takes_both_forms_and_never_fails(spark):
    values = ["01/02/2022", "1/2/2022", "31/12/2020", " 3/4/2021 ", "", "  ", "soon", "31/02/2022", None]
    expected = [D(2022, 2, 1), D(2022, 2, 1), D(2020, 12, 31), D(2021, 4, 3), None, None, None, None, None]
    assert one(spark, values, parse_date) == expected


def test_end_date_sentinel_stands_for_blank_only(spark):
    values = ["", None, "1/2/2022", "permanente"]
    assert one(spark, values, end_date_or_sentinel) == [D(2040, 1, 1), D(2040, 1, 1), D(2022, 2, 1), None]
    back = one(spark, values, lambda c: sentinel_to_null(end_date_or_sentinel(c)))
    assert back == [None, None, D(2022, 2, 1), None]


def test_date_text_and_load_stamp(spark):
    assert one(spark, [D(2022, 2, 1), None], date_text, "date") == ["01/02/2022", None]
    assert one(spark, [D(2022, 2, 1)], load_stamp, "date") == ["20220201"]


def test_parse_amount_reads_locale_text(spark):
    values = ["12.345,67", "1.234.567,80", "99", "0,5", "", "n/a", None, "-10,25"]
    expected = [Decimal("12345.67"), Decimal("1234567.80"), Decimal("99.00"), Decimal("0.50"), None, None, None, Decimal("-10.25")]
    assert one(spark, values, parse_amount) == expected


def test_scale_hundredths_is_exact(spark):
    assert one(spark, [4000, 1, 0, None, 123456789], scale_hundredths, "bigint") == [
        Decimal("40.00"), Decimal("0.01"), Decimal("0.00"), None, Decimal("1234567.89")]


def test_split_name(spark):
    df = spark.createDataFrame([("Doe, Jane Ann",), ("Solo",), ("A,  B, C",), (None,)], "n string")
    got = [tuple(r) for r in df.select(*split_name(F.col("n"))).collect()]
    assert got == [("Doe", "Jane Ann"), ("Solo", None), ("A", "B, C"), (None, None)]


def test_sheet_team_needs_the_prefix_at_the_start(spark):
    values = ["chapter_lead_Data", "copy of chapter_lead_Data", "chapter_lead_", "other", None]
    assert one(spark, values, lambda c: sheet_team(c, "chapter_lead_")) == ["Data", None, "", None, None]


def test_cast_key_keeps_all_characters(spark):
    assert one(spark, [12345678901, 1], cast_key, "bigint") == ["12345678901", "1"]


def test_filled_and_blank_to_null(spark, rows):
    assert one(spark, ["a", "", None, " "], filled) == [True, False, False, True]
    df = spark.createDataFrame([("", 1, ""), ("a", 2, None)], "x string, n int, y string")
    assert rows(blank_to_null(df)) == [(None, 1, None), ("a", 2, None)]
    assert rows(blank_to_null(df, "x")) == [(None, 1, ""), ("a", 2, None)]


def test_map_values_null_and_keep(spark):
    mapping = {1: "one", 2: "two"}
    assert one(spark, [1, 2, 3, None], lambda c: map_values(c, mapping), "bigint") == ["one", "two", None, None]
    assert one(spark, [1, 3, None], lambda c: map_values(c, mapping, "keep"), "bigint") == ["one", "3", None]
    assert one(spark, [1], lambda c: map_values(c, {}, "keep"), "bigint") == ["1"]
    with pytest.raises(ValueError):
        map_values(F.lit(1), {i: "x" for i in range(1_000)})
    with pytest.raises(ValueError):
        map_values(F.lit(1), mapping, "other")


def test_compose_maps_applies_in_turn():
    assert compose_maps({1: "a", 2: "b"}, {"a": "A", "z": "Z"}) == {1: "A", 2: "b", "a": "A", "z": "Z"}


def test_first_match_takes_the_first_rule(spark, rows):
    rules = [("A", 1, "x"), ("A", 1, "never"), ("B", 2, "y")]
    df = spark.createDataFrame([("A", 1), ("B", 2), ("B", 1), (None, 1)], "c string, n int")
    got = [r[0] for r in df.select(first_match([F.col("c"), F.col("n")], rules)).collect()]
    assert got == ["x", "y", None, None]
    assert shadowed_rules(rules) == [("A", 1, "never")]
    with pytest.raises(ValueError):
        first_match([F.col("c")], rules)


def test_seven_box_covers_all_pairs(spark):
    pairs = [(p, q) for p in (1, 2, 3, 4, None) for q in (1, 2, 3, None)]
    df = spark.createDataFrame(pairs, "p int, q int")
    got = {(r.p, r.q): r.b for r in df.select("p", "q", seven_box(F.col("p"), F.col("q")).alias("b")).collect()}
    named = {k: v for k, v in got.items() if v}
    assert named == {
        (3, 3): "rock_star", (3, 2): "singer_star", (3, 1): "vocal_coach", (2, 3): "future_rock_star",
        (2, 2): "choir_singer", (2, 1): "solist_solid", (1, 1): "out_of_tune",
    }
    assert len(got) == 20
