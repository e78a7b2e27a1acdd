import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rosterflow.llm import queries
from rosterflow.llm.repair import CLEAN, EMPTY, ENDS, INFINITE, NEXT, REPEATED, START, STATES, TAIL, TRUNCATED, Search, kept_state, play, repair, runs, summaries


def cheapest(faults, initials):
    """Cost and letters by uniform-cost search over the definition: the whole edit string is in the queue."""
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, edits, i, out = heapq.heappop(queue)
        if i == len(faults) and re.fullmatch("(s?(ua)+)?", out):
            return cost, edits
        state = (i, out[-1:], out[:1] == "s" and len(out) == 1)
        if state in done:
            continue
        done.add(state)
        fits = lambda o: re.fullmatch("(s?(ua)*u?)?", o)
        for new in "ua":
            if fits(out + new):
                heapq.heappush(queue, (cost + 5, edits + "I", i, out + new))
        if i < len(faults):
            heapq.heappush(queue, (cost + 2, edits + "D", i + 1, out))
            if faults[i] in (CLEAN, TRUNCATED):
                more = 5 * (faults[i] == TRUNCATED)
                if fits(out + initials[i]) and initials[i] in ("s", "u", "a"):
                    heapq.heappush(queue, (cost + more, edits + "K", i + 1, out + initials[i]))
                for new in "ua":
                    if fits(out + new):
                        heapq.heappush(queue, (cost + 1 + more, edits + "R", i + 1, out + new))


def searched(faults, initials):
    cost, edits = Search(faults, initials, ENDS).run(START)
    state = play(edits, START, faults, list(initials), [""] * len(faults))[1]
    return cost, edits + "I" * TAIL[state]


def test_search_against_uniform_cost_search():
    pick = random.Random(4)
    for _ in range(1500):
        n = pick.randrange(9)
        faults = [pick.choice([CLEAN, CLEAN, CLEAN, EMPTY, REPEATED, TRUNCATED]) for _ in range(n)]
        initials = [pick.choice(["u", "u", "a", "a", "s", "t", " ", ""]) for _ in range(n)]
        assert searched(faults, initials) == cheapest(faults, initials), (faults, initials)


def test_bounds_never_exceed_the_cost():
    pick = random.Random(5)
    for _ in range(400):
        n = pick.randrange(1, 8)
        faults = [pick.randrange(4) for _ in range(n)]
        initials = [pick.choice("uast") for _ in range(n)]
        for end in STATES:
            ends = [0 if s == end else INFINITE for s in STATES]
            for state in STATES:
                low = Search(faults, initials, ends).least[0][state]
                cost, edits = Search(faults, initials, ends).run(state)
                assert low <= cost
                if cost < INFINITE:
                    assert play(edits, state, faults, list(initials), [""] * n)[:2] == (cost, end)


def test_states():
    assert [kept_state(START, x) for x in ("s", "u", "a", "t", "")] == [1, 2, None, None, None]
    assert all(kept_state(s, "s") is None for s in STATES[1:]) and NEXT[START] == 2


def test_runs():
    rows = [(c,) for c in "aaaabbc"]
    assert [(len(r), o, c) for r, o, c in runs(rows, 3)] == [(3, False, False), (1, False, True), (2, True, True), (1, True, False)]
    assert list(runs([], 3)) == []


SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """The contract for the damaged rows ``(turn, role, text)`` of one conversation, step by step."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        faults.append(EMPTY if not body else REPEATED if (role, text) in seen else CLEAN if body[-1] in ".!?" else TRUNCATED)
        seen.add((role, text))
    roles, texts = [r[1] for r in rows], [r[2] for r in rows]
    initials = [r[:1] for r in roles]
    cost, audit = cheapest(faults, initials)
    kept = play(audit, START, faults, roles, texts)[2]
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    return (gaps, faults.count(EMPTY), faults.count(REPEATED), faults.count(TRUNCATED), illegal, cost, audit, digest)


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        held = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            held.extend([row] * (2 if kind == 3 else 1))
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_conv(df, key="conv"):
    return {r[key]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_query_against_the_contract(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {c: plain(held) for c, held in plain_damage(rows).items()}
    assert by_conv(queries.QUERIES["op12_repair"](spark, sf), "conv_id") == expected


def made_up(seed, long):
    pick = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "No!", "Why?", "and then", "", " \n", None, "Yes. ", "é."]
    rows = []
    for conv in [None, *range(12)]:
        for _ in range(pick.randrange(10) if conv != 7 else long):
            rows.append((conv, pick.choice([None, *range(long)]), pick.choice(roles[:2] * 6 + roles), pick.choice(texts) if pick.random() < 0.3 else f"text {pick.random()}."))
    return rows


@pytest.mark.parametrize("block_rows", [1, 3, 64])
def test_blocks_give_the_same_edits(spark, tmp_path, block_rows):
    rows = made_up(block_rows, 150)
    df = spark.createDataFrame(rows + rows[:9], SCHEMA).withColumns({c: F.lit("x") for c in ("conv", "block", "edits", "digest", "known", "first")})
    found = by_conv(summaries(repair(df, block_rows=block_rows)))
    given = {}
    for conv, turn, role, text in rows + rows[:9]:
        given.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert found == {c: plain(held) for c, held in given.items()}


def test_messages_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hello."), (1, 1, "user", "again"), (1, 2, "tool", "Sure."), (2, None, None, None)], SCHEMA)
    rows = {r.conv: r for r in repair(df).collect()}
    assert rows[1].edits == "KDR" and [tuple(m) for m in rows[1].messages] == [("user", "Hello."), ("assistant", "Sure.")]
    assert rows[2].edits == "D" and rows[2].messages == [] and rows[2].cost == 2
    assert repair(df.limit(0)).count() == 0 and summaries(repair(df.limit(0))).count() == 0


def test_conversations_that_are_dropped_whole(spark, tmp_path):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    folder = str(tmp_path)
    spark.createDataFrame([(lost, 0, "user", "Hi."), (None, None, "user", "Hi.")], SCHEMA).write.parquet(f"{folder}/conversations.parquet")
    found = by_conv(queries.QUERIES["op12_repair"](spark, folder), "conv_id")
    assert found[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and set(found) == {lost, None}
