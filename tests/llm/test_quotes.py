import pytest

from rosterflow.llm import queries
from rosterflow.llm.quotes import reply_ordered

SCHEMA = "conv_id bigint, turn bigint, role string, text string, parent string, root string, lines string, block string"


def ordered(spark, rows):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    return {(r.conv_id, r.turn): r for r in reply_ordered(df).collect()}


def test_nested_levels_link_to_their_authors(spark):
    got = ordered(spark, [
        (1, 0, "user", "First line.\nSecond  LINE."),
        (1, 1, "assistant", "> first line.\n> second line.\n\nAn answer."),
        (1, 2, "user", "On Monday X wrote:\n>> First line.\n> An answer.\nThanks."),
        (1, 3, "user", "> First line.\nAnother answer to the first."),
    ])
    assert [got[1, t].parent_turn for t in range(4)] == [None, 0, 1, 0]
    assert [got[1, t].text for t in range(4)] == ["First line.\nSecond  LINE.", "An answer.", "Thanks.", "Another answer to the first."]
    assert [got[1, t].depth for t in range(4)] == [0, 1, 2, 1]
    assert got[1, 2].quoted == 2 and got[1, 2].linked == 2
    assert got[1, 1].formatted == "<|assistant|>\nAn answer."


def test_a_quote_of_nothing_known_starts_a_thread_and_threads_stay_together(spark):
    got = ordered(spark, [
        (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "user", "> a\nc"), (1, 3, "user", "> b\nd"), (1, 4, "user", "> unheard\ne"),
    ])
    assert [got[1, t].root_turn for t in range(5)] == [0, 1, 0, 1, 4]
    assert [got[1, t].position for t in range(5)] == [0, 2, 1, 3, 4]


PARAGRAPH = "We meet on Tuesday at nine in the old hall. Bring the signed papers and two pens. Parking is behind the house."


def test_a_quote_with_other_line_breaks_finds_its_passage(spark):
    got = ordered(spark, [
        (1, 0, "user", f"Hello all,\n\n{PARAGRAPH}\n\nBye"),
        (1, 1, "user", "> We meet on Tuesday at nine in\n> the old hall. Bring the signed\n> papers and two   pens. Parking\n> is behind the house.\nFine."),
        (1, 2, "user", ">> We meet on Tuesday at nine in the old\n>> hall. Bring the signed papers and two pens. Parking is\n>> behind the house.\n> Fine.\nGood."),
    ])
    assert [got[1, t].parent_turn for t in range(3)] == [None, 0, 1]
    assert [(got[1, t].quoted, got[1, t].linked) for t in range(3)] == [(0, 0), (4, 4), (4, 4)]
    assert got[1, 2].text == "Good." and got[1, 2].depth == 2


def test_parts_of_a_passage_are_found_by_lines_and_sentences(spark):
    got = ordered(spark, [
        (1, 0, "user", f"{PARAGRAPH}\nA second line of the same passage\nand a third one"),
        (1, 1, "user", "> A second line of the same passage\nWhy?"),  # one line of it
        (1, 2, "user", "> Bring the signed papers\n> and two pens.\nWhich papers?"),  # a sentence, broken anew
        (1, 3, "user", "> Bring the\n> keys and a lamp.\nNo."),  # nobody wrote that
        (2, 4, "user", "> Bring the signed papers and two pens.\nIn another conversation."),
        (1, 5, "user", "> A second line of the same passage\n> and something else\nHm."),  # known and unknown lines
    ])
    assert [got[1, t].parent_turn for t in (0, 1, 2, 3, 5)] == [None, 0, 0, None, 0] and got[2, 4].parent_turn is None
    assert [got[1, t].linked for t in (1, 2, 3, 5)] == [1, 2, 0, 1] and got[1, 5].quoted == 2


def test_an_announcement_is_in_no_passage(spark):
    got = ordered(spark, [(1, 0, "u", "One two three four."), (1, 1, "u", "Some words of mine\nOn Monday X wrote:\n> One two three four."), (1, 2, "u", "> Some words of mine\nYes.")])
    assert got[1, 1].text == "Some words of mine" and got[1, 1].parent_turn == 0 and got[1, 2].parent_turn == 1


def test_the_later_of_two_equal_originals_and_never_a_later_message(spark):
    got = ordered(spark, [(1, 0, "u", "same"), (1, 1, "u", "same"), (1, 2, "u", "> same\nx"), (1, 3, "u", "same"), (2, 5, "u", "> same\ny")])
    assert got[1, 2].parent_turn == 1
    assert got[2, 5].parent_turn is None


def test_odd_rows(spark):
    got = ordered(spark, [(1, 0, None, None), (1, 1, "u", ""), (1, 2, "u", ">\n>\n"), (None, 3, "u", "> a"), (1, None, "u", "a")])
    assert got[1, 0].text == "" and got[1, 0].formatted == "<|unknown|>\n"
    assert got[1, 2].text == "" and got[1, 2].quoted == 0
    assert got[None, 3].parent_turn is None and got[1, None].position == 0
    assert reply_ordered(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_stay(spark):
    df = spark.createDataFrame([(1, 0, "u", "a")] * 3 + [(1, 1, "u", "> a\nb")] * 2, "conv_id bigint, turn bigint, role string, text string")
    rows = reply_ordered(df).collect()
    assert sorted((r.turn, r.position) for r in rows) == [(0, 0), (0, 1), (0, 2), (1, 3), (1, 4)]
    assert {r.parent_turn for r in rows if r.turn == 1} == {0}


def test_a_long_chain_over_many_blocks(spark, monkeypatch):
    from rosterflow.llm import quotes

    monkeypatch.setattr(quotes, "TURNS", 4)
    rows = [(7, t, "u", f"> line {t - 1}\nline {t}" if t else "line 0") for t in range(41)]
    got = ordered(spark, rows)
    assert [got[7, t].depth for t in range(41)] == list(range(41))
    assert [got[7, t].position for t in range(41)] == list(range(41))
    assert {r.root_turn for r in got.values()} == {0}


@pytest.mark.parametrize("text", ["x" * 200_000 + "\n> q", "> " * 50 + "deep"])
def test_long_texts_and_deep_quotes(spark, text):
    got = ordered(spark, [(1, 0, "u", text)])
    assert got[1, 0].quoted == 1 and got[1, 0].linked == 0


def test_no_python_in_the_plan(spark, sf):
    plan = queries.QUERIES["op1_quotes"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("last, times", [("> b", 1), ("> unheard", 2)])
def test_messages_are_taken_apart_once_and_again_only_for_lost_passages(spark, monkeypatch, last, times):
    from rosterflow.llm import quotes

    written, plain = [], quotes.materialize
    monkeypatch.setattr(quotes, "materialize", lambda df, name="frame": written.append(df) or plain(df, name))
    ordered(spark, [(1, 0, "u", "a"), (1, 1, "u", "> a\nb"), (1, 2, "u", f"{last}\nc")])
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in written]
    assert sum(p.count("Generate explode(zip_with(") for p in plans) == times
