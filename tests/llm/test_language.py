import pytest
from pyspark.sql import functions as F

from rosterflow.llm import queries
from rosterflow.llm.language import FitLimits, WordScores, fit, identify, predict

ENGLISH = ["the cat and the dog", "this is the house that", "there was the other one"]
GERMAN = ["der hund und die katze", "das ist das haus und", "nicht mit der anderen"]


@pytest.fixture
def corpus(spark, docs):
    return docs([(i, t) for i, t in enumerate(ENGLISH)]).unionByName(docs([(i + 10, t) for i, t in enumerate(GERMAN)], lang="de"))


def test_known_words_then_shorter_grams(spark, corpus):
    model = fit(corpus)
    scores = WordScores(model)
    assert model.languages == ["de", "en"]
    assert predict("the house", scores)[0] == "en" and predict("DAS HAUS", scores)[0] == "de"
    assert "hundkatze" not in model.words and predict("hundkatze", scores)[0] == "de"
    assert predict("thouse", scores)[0] == "en"
    languages = {x: i for i, x in enumerate(model.languages)}
    known = model.score_word("the")
    assert known[languages["en"]] > known[languages["de"]]


def test_backoff_takes_the_longest_known_grams(corpus, spark):
    model = fit(corpus)
    word = "qqq"
    assert not any(word[i : i + n] in model.grams[n] for n in range(1, 6) for i in range(3))
    assert model.score_word("qtheq").tolist() == model.table[[model.grams[3]["the"]]].mean(axis=0).tolist()


def test_odd_texts(spark, corpus, docs):
    model = fit(corpus)
    df = docs([(1, None), (2, ""), (3, "123 !? _ ²"), (4, "日本語"), (5, "the " * 200_000), (6, "the"), (6, "the"), (None, "der"), (7, "x" * 500_000)])
    rows = [(r.key, r.lang_pred, r.score) for r in identify(df, model).collect()]
    by = {k: (p, s) for k, p, s in rows}
    assert by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[4][0] in ("de", "en") and by[5][0] == "en" and by[None][0] == "de" and by[7][0] in ("de", "en")
    assert len([r for r in rows if r[0] == 6]) == 2 and all(0 <= s <= 1 for _, _, s in rows)
    assert identify(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark, docs):
    empty = docs([(1, "a b c")], lang=None)
    assert fit(empty) is None
    assert [(r.lang_pred, r.score) for r in identify(empty, None).collect()] == [("und", 0.0)]


def test_limits_bound_the_model(spark, corpus):
    model = fit(corpus, limits=FitLimits(docs_per_language=2, words=6, grams=20))
    assert len(model.words) <= 6 and sum(map(len, model.grams[1:])) <= 20


def test_held_out_accuracy_and_the_fold(spark, documents, sf):
    got = queries.QUERIES["op7_language"](spark, sf).join(documents.select("doc_id", "lang"), "doc_id")
    assert got.where((F.crc32(F.col("doc_id").cast("string")) % 4 == 2) != F.col("held_out")).count() == 0
    held = got.where("held_out AND lang_pred <> 'und'")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()


def test_predictions_do_not_see_other_columns(spark, corpus, documents):
    model = fit(documents.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    a = identify(documents, model).select("key", "lang_pred", "score")
    b = identify(documents.withColumns({"lang": F.lit("xx"), "source": F.lit("")}), model).select("key", "lang_pred", "score")
    assert a.exceptAll(b).count() == 0
