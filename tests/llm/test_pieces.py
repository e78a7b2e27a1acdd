import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from rosterflow.llm import queries
from rosterflow.llm.pieces import PieceModel, decode_pieces, encode_pieces, tiles

PATH = queries.tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def split(flat, lengths):
    ends = np.cumsum(lengths)
    return [flat[a:b].tolist() for a, b in zip(ends - lengths, ends, strict=True)]


ODD = [
    "", " ", "   ", "a", " a", "a ", "  a   b ", "▁", "▁▁ a", "x\ny\t\r\n", "日本語 テスト", "😀👩‍👩‍👧 é é", "\x00\x01", "<s>hi</s><unk> <0x41>",
    "a" * 999, "ab" * 500, " " * 5003 + "x", "the" * 200, "=" * 77 + "-" * 77, "�",
]


def test_equals_the_library_on_odd_texts(both):
    model, library = both
    flat, lengths = model.encode(ODD)
    assert split(flat, lengths) == [[*library.encode(t), 2] for t in ODD]
    assert model.decode(flat, lengths) == library.decode([[*library.encode(t), 2] for t in ODD])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"abeinorst .,\n▁é日=-_/01", "the", "  "]), max_size=60).map("".join), min_size=1, max_size=5))
def test_equals_the_library_on_any_text(both, values):
    model, library = both
    flat, lengths = model.encode(values, end=False)
    assert split(flat, lengths) == [library.encode(v) for v in values]


def test_decodes_any_ids_as_the_library_does(both):
    model, library = both
    pick = random.Random(5)
    kinds = [lambda: pick.randrange(32000), lambda: pick.randrange(3, 259), lambda: pick.choice([0, 1, 2, 259, 28705])]
    for _ in range(500):
        ids = [pick.choice(kinds)() for _ in range(pick.randrange(9))]
        assert model.decode(np.array(ids, np.int32), np.array([len(ids)])) == [library.decode(ids)]
    with pytest.raises(ValueError):
        model.decode(np.array([32000]), np.array([1]))


def test_whole_documents_and_round_trip(spark, documents, both):
    _, library = both
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    rows = decode_pieces(encode_pieces(documents, PATH), PATH).collect()
    assert {r.key: r.ids for r in rows} == {k: [*library.encode(t), 2] for k, t in texts.items()}
    assert {r.key: r.text for r in rows} == texts


def test_odd_rows(spark, docs):
    df = docs([(1, None), (1, None), (None, ""), (2, "a" * 300_000)])
    rows = {(r.key, len(r.ids)) for r in encode_pieces(df, PATH).collect()}
    assert (1, 1) in rows and (None, 1) in rows and len(rows) == 3
    assert encode_pieces(docs([(1, "x")]).limit(0), PATH).count() == 0
    lists = spark.createDataFrame([(1, None), (2, []), (3, [None])], "key bigint, ids array<int>")
    assert {r.key: r.text for r in decode_pieces(lists, PATH).collect()} == {1: "", 2: "", 3: " ⁇ "}


def test_runs_of_spaces_are_cut_only_where_that_is_right():
    assert tiles({2, 3, 4}, 4) and tiles({2, 4, 5}, 5) and not tiles({2, 5}, 5)
