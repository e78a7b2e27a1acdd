import random

import numpy as np
import pytest

from rosterflow.llm import queries
from rosterflow.llm.components import components
from rosterflow.llm.jaccard import JoinPlan, WordHashes, block_links, keep_one_of_each, least_overlap, near_duplicates, prefix, shingles


def word_sets(texts, width=5):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    return out


def brute(rows):
    sets = word_sets([t for _, t in rows])
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[find(i)] = min(smallest.get(find(i), key), key)
    return sorted((k if k is not None else -1, len(sets[i]), smallest.get(find(i), -1)) for i, (k, _) in enumerate(rows))


def found(df, **more):
    none = lambda x: -1 if x is None else x
    return sorted((none(r.id), r.n_shingles, none(r.component_id)) for r in near_duplicates(df, **more).collect())


def family(pick, n, words, change, prefix_=""):
    """Texts that differ from one text in a few random words."""
    base = [f"{prefix_}w{pick.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(pick.randrange(change + 1)):
            copy[pick.randrange(words)] = f"{prefix_}c{pick.randrange(30)}"
        out.append(" ".join(copy))
    return out


def test_shingles_are_distinct_sequences_of_words():
    texts = ["a b c d e f", "A B\tC\nD\x0be F", "a b", "b a", "", None, "x x x x x x x", "é b c d e f g", "a"]
    flat, counts = shingles(texts, 5, WordHashes())
    assert counts.tolist() == [len(s) for s in word_sets(texts)] == [2, 2, 1, 1, 0, 0, 1, 2, 1]
    ends = np.cumsum(counts)
    sets = [set(flat[a:b].tolist()) for a, b in zip(ends - counts, ends, strict=True)]
    assert sets[0] == sets[1] and sets[2] != sets[3] and sets[2] != sets[8]
    # how texts are sliced makes no difference
    alone = [set(shingles([t], 5, WordHashes())[0].tolist()) for t in texts]
    assert alone == sets


def test_prefixes_of_similar_sets_share_enough():
    pick = random.Random(9)
    plan = JoinPlan(verification=4.0)
    for _ in range(300):
        base = [pick.randrange(2**63) for _ in range(pick.randrange(5, 60))]
        other = [x for x in base if pick.random() > 0.1] + [pick.randrange(2**63) for _ in range(pick.randrange(4))]
        df = {x: pick.choice([0, 0, 9, 40, 500]) for x in base + other}
        made = []
        for s in (base, other):
            tokens = np.unique(np.array(s, dtype=np.uint64))
            places, ell = prefix(tokens, np.array([df[int(x)] for x in tokens]), plan)
            made.append(({int(x) for x in tokens[places]}, ell, set(s)))
        (a, la, sa), (b, lb, sb) = made
        if 100 * len(sa & sb) >= 80 * len(sa | sb):
            assert len(a & b) >= min(la, lb)
    assert least_overlap(5, 80) == 4 and least_overlap(6, 80) == 5


@pytest.mark.parametrize("plan", [
    JoinPlan(), JoinPlan(known_from=2, hot_from=4, block=16), JoinPlan(known_from=2, hot_from=10**6), JoinPlan(known=3, hot_from=2, flush=500, bloom_bits=64),
])
def test_equals_brute_force(spark, docs, plan):
    pick = random.Random(11)
    texts = []
    for n, words, change in ((40, 30, 4), (25, 60, 9), (12, 12, 1), (30, 25, 3)):
        texts += family(pick, n, words, change)
    passage = " ".join(f"p{i}" for i in range(20))
    texts += [passage + " " + " ".join(f"u{pick.randrange(10**6)}" for _ in range(pick.randrange(1, 40))) for _ in range(40)]
    texts += ["a b", "A b", "b a", "a", "", None, " \n ", "a b c d", "one two three four five", "ONE two three four five"]
    rows = list(enumerate(texts))
    pick.shuffle(rows)
    assert found(docs(rows).repartition(4), plan=plan) == brute(rows)


def test_links_at_the_threshold(spark, docs):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words[:13]))]  # 9 shingles
    rows += [(2, " ".join(words[:12])), (3, " ".join(words[:11])), (4, " ".join(words[:10]))]  # 8, 7 and 6 of them
    assert found(docs(rows)) == brute(rows)
    assert [c for _, _, c in brute(rows)] == [1, 1, 1, 1]
    rows = [(1, " ".join(words[:14])), (2, " ".join(words[:12])), (3, " ".join(words[2:16]))]  # 8 / 10 links, 8 / 12 does not
    assert found(docs(rows)) == brute(rows)


def test_odd_rows(spark, docs):
    text = "one two three four five six"
    rows = [(4, text), (4, text), (None, text.upper()), (2, "other words that are not at all alike"), (None, "alone in the whole wide world"), (9, "x " * 300_000)]
    assert found(docs(rows)) == brute(rows)
    assert near_duplicates(docs([(1, "a")]).limit(0)).count() == 0
    assert found(docs([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_blocks_give_one_link_for_each_group():
    import pyarrow as pa

    table = lambda rows: pa.table({
        "cls": pa.array([r[0] for r in rows], pa.int64()), "comp": pa.array([r[1] for r in rows], pa.int64()),
        "tokens": pa.array([r[2] for r in rows], pa.list_(pa.int64())),
    })
    x = table([(1, 1, [1, 2, 3, 4, 5]), (2, 2, [7, 8])])
    y = table([(3, 9, [1, 2, 3, 4, 5]), (4, 9, [1, 2, 3, 4]), (5, 8, [1, 2, 3]), (1, 1, [1, 2, 3, 4, 5])])
    assert block_links(x, y, 80).to_pylist() == [{"a": 1, "b": 3}]


def test_components(spark):
    pick = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 9), (50, 50)] + [(200, 200 + i) for i in range(1, 40)]
    pick.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {3: 3, 7: 3, 9: 3} | {i: 200 for i in range(200, 240)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_keeping_one_of_each(spark, docs):
    text = " ".join(f"w{i}" for i in range(40))
    df = docs([(5, text + " x"), (2, text + " y"), (8, "quite another text with its own words"), (9, None)])
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 8, 9]


def test_query(spark, sf, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in queries.QUERIES["op8_jaccard_join"](spark, sf).collect())
    assert got == brute(rows)
