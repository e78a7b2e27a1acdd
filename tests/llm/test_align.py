import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rosterflow.llm import batches, queries
from rosterflow.llm.align import CachedPieces, PlainByteTokenizer, align, chunks, common_ends, group_digests, overlaps, sums_by

FILES = [queries.tokenizer_file(f) for f in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FILES[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES[2])
    # the letters that stand for bytes: printable ones for themselves, the others from U+0100 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    entries = {i: bytes(letters[c] for c in t) for t, i in first.get_vocab().items() if all(c in letters for c in t)}

    def tokens(text):
        a = [(i, entries[i]) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    return tokens


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def plain(tokens, values):
    """The contract by comparing all tokens with all, document by document."""
    docs, linked = [], Counter()
    for text in values:
        a, b = tokens(text) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        a, b = spans(a), spans(b)
        links = Counter((i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f))
        linked.update(set(links))
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        inside = lambda side, low, high: ",".join(str(i) for i, s, e in side if low <= s and e <= high)  # noqa: E731, B023
        groups = ";".join(f"{inside(a, low, high)}|{inside(b, low, high)}" for low, high in zip([0, *cuts], cuts, strict=False))
        docs.append((len(a), len(b), len(cuts), links, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    most = {}
    for (i, _), n in linked.items():
        most[i] = max(n, most.get(i, 0))
    return [
        (na, nb, ng, sum(links.values()), sum(n for (i, j), n in links.items() if linked[i, j] == most[i]), sum(n * linked[p] for p, n in links.items()), sha)
        for na, nb, ng, links, sha in docs
    ]


ODD = [
    None, "", " ", "  a", "a", "\n", "a  b\t c", "▁", "a▁b", "日本語 テスト", "😀👩‍👩‍👧 é é", "<|endoftext|>", "x <|endoftext|>y", "<s> </s> <unk> <0x41>", "\x00\x01",
    "don't I'm we've", "aaaa" * 40, "The quick brown fox.", "The quick brown fox.", "  a", "unbelievable unbelievably", "½ ² Ⅷ a", "\x1c a",
]


@pytest.mark.parametrize("chunk_bytes", [1, 8 << 20])
def test_odd_texts_by_the_contract(spark, docs, libraries, chunk_bytes):
    pick = random.Random(2)
    alphabet = [*"ab c  \n'1½., ▁日é", " the", " in", "tion", "ing"]
    values = ODD + ["".join(pick.choice(alphabet) for _ in range(pick.randrange(60))) for _ in range(120)]
    found = align(docs(list(enumerate(values))), *FILES, chunk_bytes=chunk_bytes)
    rows = {r.key: tuple(r[c] for c in COLUMNS) for r in found.collect()}
    assert rows == dict(enumerate(plain(libraries, values)))


def test_whole_table_by_the_contract(spark, sf, documents, libraries):
    held = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    short = [(i, t) for i, t in held if len(t or "") < 20_000]
    expected = dict(zip([i for i, _ in short], plain(libraries, [t for _, t in short]), strict=True))
    rows = {r.doc_id: r for r in queries.QUERIES["op11_align"](spark, sf).collect()}
    assert set(rows) == {i for i, _ in held}
    if len(short) == len(held):
        assert {i: tuple(r[c] for c in COLUMNS) for i, r in rows.items()} == expected
    for i, t in held:
        a, b = libraries(t) if t else ([], [])
        assert (rows[i].n_a, rows[i].n_b, rows[i].n_links) in {(len(a), len(b), len(a) + len(b) - rows[i].n_groups), (0, 0, 0)}


def test_rows(spark, docs):
    given = [(1, "some words"), (1, "some words"), (None, "some words"), (2, None), (3, "")]
    rows = align(docs(given), *FILES).collect()
    assert sorted((r.key or 0, r.n_links > 0) for r in rows) == [(0, True), (1, True), (1, True), (2, False), (3, False)]
    assert {r.count_sum for r in rows if r.n_links} == {3 * r.n_links for r in rows if r.n_links}
    assert align(docs(given).limit(0), *FILES).count() == 0
    assert [tuple(r)[1:] for r in align(docs([(7, None)]), *FILES).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_parts():
    first, second = np.array([2, 3, 7, 9]), np.array([1, 3, 8, 9])
    assert [x.tolist() for x in common_ends(first, second)] == [[1, 3], [1, 3]]
    assert [x.tolist() for x in overlaps(first, second)] == [[0, 0, 1, 2, 3, 3], [0, 1, 1, 2, 2, 3]]
    assert sums_by(pa.array([0, 0, 2]), np.array([1, 2, 5]), 4).tolist() == [3, 0, 5, 0]
    names = pa.array([str(i) for i in range(10)])
    digest = group_digests(np.array([1, 2, 3]), np.array([4, 5, 6]), np.array([1, 2]), np.array([0, 2]), np.array([1, 1]), 3, names)
    assert digest == ["", hashlib.sha256(b"1,2|4;3|5,6").hexdigest(), ""]


def test_no_row_holds_more_than_a_text_and_its_share_of_pairs(spark, docs):
    values = [(i, f"word{i} and some more of text {i * 7} here" * (1 + i % 3)) for i in range(40)] + [(40, None), (None, "")]
    rows = chunks(docs(values), *FILES, "doc_id", "text", 8 << 20).collect()
    assert len(rows) == len(values)
    of = {}
    for r in rows:
        of.setdefault(r.chunk, []).append(r)
        assert r.key is None or len(r.places) == len(r.times) <= r.n_links
    for rs in of.values():
        rs.sort(key=lambda r: r.base)
        pairs = [p for r in rs for p in r.pairs]
        assert pairs == sorted(set(pairs))
        assert all(r.base == sum(len(x.pairs) for x in rs if x.base < r.base) for r in rs if r.pairs)
        assert max(len(r.pairs) for r in rs) <= -(-len(pairs) // len(rs))


@pytest.mark.parametrize("batch_rows", [1, 7, 1000])
def test_answers_and_texts_in_any_batches(spark, docs, libraries, batch_rows):
    values = [*ODD, "a few words of a longer text, in which more pairs are linked than a batch has rows"] * 3
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        rows = {r.key: tuple(r[c] for c in COLUMNS) for r in align(docs(list(enumerate(values))).repartition(3), *FILES, chunk_bytes=200).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert rows == dict(enumerate(plain(libraries, values)))


def test_workers_give_the_tokenizers_back_before_they_add_up(spark, docs, monkeypatch):
    """The last stage fills the heap most, and needs no tokenizer."""
    import sys

    module, owners = sys.modules["rosterflow.llm.align"], []
    monkeypatch.setattr(module, "in_turn", lambda owner, read: owners.append(owner) or batches.in_turn(owner, read))
    assert align(docs([(1, "some words")]), *FILES).count() == 1
    monkeypatch.setattr(batches, "_HELD", {"tokenizers": 1})
    monkeypatch.setattr(batches, "_OWNER", ["align"])
    assert len(owners) == 1 and list(batches.in_turn(owners[0], iter)([7])) == [7]
    assert batches._HELD == {}


def test_words_remembered_are_bounded_and_change_nothing():
    """What a worker holds must not follow the words of its input: 600,000 on each side were too many beside a full heap."""
    first, second = PlainByteTokenizer(*FILES[:2]), CachedPieces(FILES[2])
    texts = [" ".join(f"{i:x}n{j}" for j in range(100)) for i in range(4000)]
    for at in range(0, len(texts), 400):
        for text in texts[at : at + 400]:
            first.encode_spaced(text)
        second.encode(texts[at : at + 400])
        assert len(first.spaced) + len(first.spaced.older) <= 200_000
        assert len(second.seen) + len(second.older) <= 200_000
    again = texts[:2] + texts[3000:3002] + texts[-2:]
    new = PlainByteTokenizer(*FILES[:2]), CachedPieces(FILES[2])
    assert [first.encode_spaced(t) for t in again] == [new[0].encode_spaced(t) for t in again]
    assert second.encode(again) == new[1].encode(again)
