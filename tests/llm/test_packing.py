import binascii
import random
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from rosterflow.llm import queries
from rosterflow.llm.packing import ByteTokenizer, Packer, fill, pack

PATHS = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("byte_bpe_50k.tiktoken")


def best_sum(counts, capacity):
    sums = {0}
    for length, n in counts.items():
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= capacity}
    return max(sums)


def test_fill_comes_as_close_as_can_be():
    pick = random.Random(1)
    for _ in range(300):
        counts = {pick.randrange(1, 60): pick.randrange(1, 5) for _ in range(pick.randrange(1, 8))}
        taken = fill(counts, 64)
        assert all(n <= counts[length] for length, n in taken.items())
        assert sum(length * n for length, n in taken.items()) == best_sum(counts, 64)


def check(pieces, lengths, capacity):
    """Every id in one piece, sequences without gaps, no padding but where lengths are powers of two."""
    cover, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in pieces:
        cover[doc].append((start, length))
        sequences[sequence].append((offset, length))
    for doc, parts in cover.items():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [s for s, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] == lengths[doc]
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]]
        assert ends[-1] == capacity or (ends[-1] < capacity and ends[-1] & (ends[-1] - 1) == 0)
    assert set(cover) == {d for d, n in lengths.items() if n}


@pytest.mark.parametrize("pool", [2, 8, 64])
def test_packer(pool):
    pick = random.Random(pool)
    lengths = {d: pick.choice([1, 2, 63, 64, 65, pick.randrange(1, 300)]) for d in range(200)}
    packer = Packer(1000, 64, pool)
    pieces = [p for d, n in lengths.items() for p in packer.add(d, np.arange(n))] + list(packer.finish())
    check([(d, s, len(ids), q, o) for d, s, ids, q, o in pieces], lengths, 64)
    assert all(ids[0] == s for _, s, ids, _, _ in pieces)
    assert packer.size == 0 and not list(packer.finish())


ODD = [
    "", " ", "a", " a", "a ", "a  b", " \n b", "x y 　z", "日本 語", "<|endoftext|>", "a <|endoftext|>b", "don't I'm we've", "½ ² Ⅷ a",
    "\x1c a \x85 b", "x" * 5000, "a\n\nb \tc", "'s't 'll",
]


def test_ids_equal_the_library():
    library, own = Tokenizer.from_file(PATHS[0]), ByteTokenizer(*PATHS)
    pick = random.Random(7)
    alphabet = [*"ab c  \n\t's1½., \x0b\x1c\x85日Ⅷé", " the", " in"]
    texts = ODD + ["".join(pick.choice(alphabet) for _ in range(pick.randrange(40))) for _ in range(3000)]
    for text in texts:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_query(spark, sf, documents):
    library = Tokenizer.from_file(PATHS[0])
    ids = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 0] for r in documents.collect()}
    rows = queries.QUERIES["op4_packing"](spark, sf).collect()
    check([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in rows], {d: len(x) for d, x in ids.items()}, 1024)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == binascii.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])


def test_rows(spark, docs):
    df = docs([(1, None), (2, ""), (2, ""), (None, "a b c")])
    rows = pack(df, *PATHS).collect()
    assert sorted((r.key or 0, r.doc_tokens) for r in rows if r.key) == [(1, 1), (2, 1), (2, 1)]
    assert sum(r.length for r in rows) == 1 + 1 + 1 + 4
    assert all(len(r.ids) == r.length for r in rows)
    assert pack(df.limit(0), *PATHS).count() == 0


def test_a_worker_remembers_no_more_parts_than_told(spark, docs, monkeypatch):
    text = " ".join(f"w{i} x{i % 7}" for i in range(500))
    few, all_ = ByteTokenizer(*PATHS, cached=50), ByteTokenizer(*PATHS)
    assert few.encode(text).tolist() == all_.encode(text).tolist()
    assert len(few.spaced) <= 50 < len(all_.spaced)
    pieces = [sorted(map(tuple, pack(docs([(1, text), (2, text)]), *PATHS, keep_ids=False, **more).collect())) for more in ({}, {"cached": 50, "keep_parts": False})]
    assert pieces[0] == pieces[1]
    import corpus_pipeline

    told = []
    monkeypatch.setattr(corpus_pipeline, "pack", lambda df, *files, **more: told.append((more["cached"], more["keep_parts"])) or pack(df, *files, **more))
    corpus_pipeline.packing(spark, docs([(1, text)]), "")
    assert told == [(250_000, False)]


def test_a_worker_holds_no_parts_after_the_task(monkeypatch):
    """What a task of the pipeline leaves in its Python worker, run here without one."""
    import pyarrow as pa
    from rosterflow.llm import batches, packing

    class Frame:  # gives the function that runs in tasks
        class sparkSession: ...
        schema = {"key": type("Field", (), {"dataType": type("Kind", (), {"simpleString": lambda self: "bigint"})()})}
        select = lambda self, *columns: self
        mapInArrow = lambda self, run, ddl: run

    monkeypatch.setattr(packing, "ship", lambda spark: None)
    monkeypatch.setattr(packing.F, "col", lambda name: type("Column", (), {"alias": lambda s, n: s, "cast": lambda s, t: s})())
    monkeypatch.setattr(packing, "TaskContext", type("Context", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda s: 0})())}))
    rows = pa.RecordBatch.from_pydict({"key": [1], "text": ["one two three"]})
    for keep, left in ((True, 2), (False, 0)):
        monkeypatch.setattr(batches, "_HELD", {})
        assert sum(b.num_rows for b in pack(Frame(), *PATHS, keep_ids=False, keep_parts=keep)(iter([rows]))) == 1
        assert [len(t.spaced) for t in batches._HELD.values()] == [left]
