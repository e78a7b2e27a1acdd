import binascii
import re
import string
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from rosterflow.llm import queries
from test_jaccard import brute as near_brute
from test_packing import PATHS, check
from test_secrets import expected

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_ten_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    assert {re.match(r"op\d+", n)[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert set(queries.QUERIES) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "secret scans", "packing"]


def brute(rows):
    """The texts that reach the packing, by id."""
    rows = {i: t for i, t in rows if t and any(c.isalpha() for c in t)}
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    copies = defaultdict(list)
    for i, t in rows.items():
        copies[t.translate(low)].append(i)
    rows = {max(ids): rows[max(ids)] for ids in copies.values()}
    kept = {i for i, _, smallest in near_brute(list(rows.items())) if i == smallest}
    result = {}
    for i in kept:
        text, at, out = rows[i], 0, []
        for _, a, b in sorted(expected(text), key=lambda s: (s[1], s[2])):
            if a >= at:
                out += [text[at:a], "[secret]"]
            at = max(at, b)
        result[i] = "".join(out) + text[at:]
    return result


def test_run_equals_brute_force(spark, sf, documents):
    want = brute([(r.doc_id, r.text) for r in documents.collect()])
    library = Tokenizer.from_file(PATHS[0])
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in want.items()}
    rows = corpus_pipeline.run(spark, sf).collect()
    check([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in rows], {i: len(x) for i, x in ids.items()}, 1024)
    for r in rows:
        assert r.ids_crc32 == binascii.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes())


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_and_empty_tables(spark, sf, docs, number):
    stage = corpus_pipeline.STAGES[number][1]
    text = "one two three four five six seven token=abcdefgh"
    df = docs([(1, text), (2, text.upper()), (3, None), (4, ""), (5, "123 !"), (6, text + " eight"), (7, text + " eight")])
    out = stage(spark, df, sf)
    if number < 4:
        assert out.columns == COLUMNS
    kept = sorted({r.doc_id for r in out.collect()})
    assert kept == [[1, 2, 6, 7], [2, 4, 5, 7], [1, 3, 4, 5], list(range(1, 8)), list(range(1, 8))][number]
    assert stage(spark, df.limit(0), sf).count() == 0


@pytest.mark.parametrize("lang", [None, "en"])
def test_language_stage_keeps_every_text_with_letters_when_nothing_can_be_learned(spark, docs, lang):
    """Without a language, or with one in held-out documents alone."""
    held_out = [i for i in range(40) if binascii.crc32(str(i).encode()) % 4 == 2][0]
    learnable = [i for i in range(40) if binascii.crc32(str(i).encode()) % 4 != 2]
    texts = ["plain words", "été", "слово", "語", None, "", "12 !", "_"]
    df = docs([*zip(learnable, texts)], None).unionByName(docs([(held_out, "held out")], lang))
    out = corpus_pipeline.language_id(spark, df, "")
    assert out.columns == COLUMNS
    assert sorted(r.doc_id for r in out.collect()) == sorted([*learnable[:4], held_out])
