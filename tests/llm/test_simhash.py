import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rosterflow.llm import queries
from rosterflow.llm.components import components
from rosterflow.llm.simhash import GridPlan, fingerprints, links, majorities, near_copies, popcounts, shingle_hashes


def plain_fingerprint(text, width=3):
    """Bit by bit, from the definition."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower:
        if c == " " or "\x09" <= c <= "\x0d":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    words += [word] * bool(word)
    runs = [words] if 0 < len(words) < width else [words[i : i + width] for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The smallest key of each row's group, comparing all pairs of ``(key, fingerprint)``."""
    group = list(range(len(prints)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    values = np.array([f for _, f in prints], dtype=np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2).tolist():
            group[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[top(i)] = min(key, least.get(top(i), key))
    return [(key, least.get(top(i))) for i, (key, _) in enumerate(prints)]


def counted(rows):
    return Counter(tuple(r) for r in rows)


TEXTS = ["", None, " \t\n", "one", "One two", "a b c", "A  b\nc", "a b c d", "x y x y x y x y", "É é İ ı", " nb sp", "a\x0bb\x0cc d", "w " * 5000]


def test_fingerprints_by_definition(spark, docs):
    rows = fingerprints(docs(list(enumerate(TEXTS))), width=3).collect()
    assert {r.key: r.fingerprint % 2**64 for r in rows} == {i: plain_fingerprint(t) for i, t in enumerate(TEXTS)}
    assert {r.key: r.n_shingles for r in rows}[8] == 6 and shingle_hashes(None, 3) == []


def test_a_bit_needs_more_than_half():
    hashes = np.array([1, 0, 3, 1, 1, 2**63, 2**63], dtype=np.uint64)
    assert majorities(hashes, np.array([2, 0, 3, 2])).tolist() == [0, 0, 1, 2**63]


def test_popcounts_of_segments(spark):
    values = [0, -1, 5, 2**62 + 9, -(2**63), 0x0123456789ABCDEF]
    df = spark.createDataFrame([(v,) for v in values], "fp bigint")
    for segment in (1, 2, 4):
        for row in df.select("fp", popcounts(F.col("fp"), segment).alias("p")).collect():
            fields = [(row.p >> at) % 2**segment for at in range(0, 64, segment)]
            assert fields == [bin((row.fp >> at) % 2**segment).count("1") for at in range(0, 64, segment)]


def flipped(value, *bits):
    for bit in bits:
        value ^= 1 << bit
    return value


def signed(value):
    return value - 2**64 if value >= 2**63 else value


@pytest.mark.parametrize("plan", [GridPlan(), GridPlan(4), GridPlan(1), GridPlan(2, 3), GridPlan(4, 0)], ids=str)
def test_links_connect_what_brute_force_connects(spark, plan):
    pick = random.Random(3)
    base = [pick.getrandbits(64) for _ in range(60)] + [0, 2**64 - 1]
    values = set(base)
    for value in base[:30]:
        for n in (1, 2, 2, 3, 4):  # chains of copies, some just too far
            value = flipped(value, *pick.sample(range(64), n))
            values.add(value)
    values |= {flipped(0, i, j) for i in range(0, 64, 7) for j in range(1, 64, 9)}  # a dense ball
    values = sorted(signed(v) for v in values)
    found = links(spark.createDataFrame([(v,) for v in values], "fp bigint"), plan)
    pairs = [tuple(r) for r in found.collect()]
    assert all(bin((a ^ b) % 2**64).count("1") <= 2 and a != b for a, b in pairs)
    joined = {r.node: r.component for r in components(found).collect()}
    got = [(v, joined.get(v, v)) for v in values]
    assert got == plain_components([(v, v % 2**64) for v in values])


def test_every_pair_of_positions_is_found(spark):
    """Any two bits of difference, wherever they lie, one at a time."""
    pick = random.Random(9)
    places = [(i, j) for i in range(64) for j in range(i, 64)]
    values = [pick.getrandbits(64) for _ in places]
    values += [flipped(v, *{i, j}) for v, (i, j) in zip(values, places, strict=True)]
    found = links(spark.createDataFrame([(signed(v),) for v in values], "fp bigint")).distinct()
    assert found.count() == len(places)


def test_whole_table_against_brute_force(spark, sf, documents):
    rows = queries.QUERIES["op13_simhash"](spark, sf).collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in documents.select("doc_id", "text").collect()]
    assert {r.doc_id: r.fingerprint for r in rows} == {k: f"{f:016x}" for k, f in prints}
    assert counted((r.doc_id, r.component_id) for r in rows) == counted(plain_components(prints))


def test_odd_rows(spark, docs):
    given = [(5, "a b c d"), (5, "a b c d"), (3, "A B  C D"), (None, "a b c d"), (9, None), (8, ""), (7, "  "), (None, "lonely words only here")]
    rows = near_copies(docs(given)).collect()
    assert counted((r.key, r.component_id) for r in rows) == Counter(
        {(5, 3): 2, (3, 3): 1, (None, 3): 1, (9, 7): 1, (8, 7): 1, (7, 7): 1, (None, None): 1}
    )
    assert near_copies(docs(given).limit(0)).count() == 0


def test_crowded_cells_take_the_finest_grid(spark, docs):
    """Many texts with one fingerprint and many near it: the result doesn't depend on the plan."""
    given = [(i, f"w{i % 40} " + "common words of a long passage " * 30) for i in range(200)]
    calm, crowded = (near_copies(docs(given), plan=p) for p in (GridPlan(), GridPlan(hot_from=2)))
    assert counted(calm.collect()) == counted(crowded.collect())
    prints = [(r.key, r.fingerprint % 2**64) for r in calm.collect()]
    assert counted(calm.select("key", "component_id").collect()) == counted(plain_components(prints))
