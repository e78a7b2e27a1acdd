import hashlib

from rosterflow.llm import queries
from rosterflow.llm.dedup import add_batch, digests, exact_dedup, keep_first_copies, lookup, open_index


def test_the_largest_id_stays_once(spark, docs):
    df = docs([(1, "Abc"), (3, "aBC"), (2, "abd"), (3, "aBC"), (None, "ABC"), (5, None), (4, ""), (6, "É"), (7, "é"), (8, "x" * 1_000_000)])
    rows = exact_dedup(df).collect()
    assert len(rows) == 10
    group = [r for r in rows if r.group_size == 4]
    assert len(group) == 4 and {r.keep_id for r in group} == {3} and sum(r.kept for r in group) == 1
    assert {(r.key, r.kept) for r in rows if r.key in (4, 5)} == {(4, False), (5, True)}
    assert all(r.kept for r in rows if r.key in (2, 6, 7, 8))
    kept = keep_first_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7, 8]


def test_rows_without_ids(spark, docs):
    rows = exact_dedup(docs([(None, "a"), (None, "A"), (None, "b")])).collect()
    assert sum(r.kept for r in rows) == 2 and {r.keep_id for r in rows} == {None}
    assert exact_dedup(docs([(1, "a")]).limit(0)).count() == 0
    assert keep_first_copies(docs([(1, "a")]).limit(0)).count() == 0


def test_the_index_lasts_and_grows(spark, docs, tmp_path):
    path = f"file://{tmp_path}/index"
    first = {r.key: r for r in exact_dedup(docs([(1, "a"), (2, "b")]), index_path=path).collect()}
    second = {r.key: r for r in exact_dedup(docs([(9, "A"), (8, "c"), (7, "C")]), index_path=path).collect()}
    assert first[1].kept and first[2].kept
    assert not second[9].kept and second[9].keep_id == 1
    assert second[8].kept and not second[7].kept and second[7].keep_id == 8
    third = exact_dedup(docs([(10, "b"), (11, "d")]), index_path=path).collect()
    assert {r.key: (r.kept, r.keep_id) for r in third} == {10: (False, 2), 11: (True, 11)}


def test_a_batch_is_added_once(spark, docs, tmp_path):
    index = open_index(spark, "once_index", f"file://{tmp_path}/once", buckets=4)
    batch = digests(docs([(1, "a"), (2, "b")]))
    for _ in range(2):
        add_batch(batch, index, "one")
    assert spark.table(index).count() == 2
    assert lookup(batch, index, "one").where("kept").count() == 2


def test_the_index_is_read_without_a_shuffle(spark, docs, tmp_path):
    index = open_index(spark, "plan_index", f"file://{tmp_path}/plan", buckets=8)
    add_batch(digests(docs([(i, str(i)) for i in range(50)])), index, "one")
    known = spark.table(index).hint("merge")
    joined = known.join(spark.table(index).select("digest"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_query(spark, sf, documents):
    import string

    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    groups = {}
    for r in documents.collect():
        groups.setdefault(hashlib.sha256((r.text or "").translate(low).encode()).hexdigest(), []).append(r.doc_id)
    want = {(i, max(ids), len(ids), i == max(ids), h) for h, ids in groups.items() for i in ids}
    got = {tuple(r) for r in queries.QUERIES["op9_exact_dedup"](spark, sf).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()}
    assert got == want
