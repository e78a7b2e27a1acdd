"""Repair of conversations: the cheapest edits that make turns alternate, by iterative-deepening A*.

A conversation in order reads: a system message or none, then pairs of user and assistant;
or it is empty.  Messages may be kept (K, free), given the role that fits (R, 1), deleted (D, 2),
and empty ones inserted (I, 5); blank and repeated messages must go, and one that breaks off costs 5
more if it stays.  Of the cheapest edits the ones whose letters come first in ASCII are taken.

The search goes depth first through the edits in ASCII order, under a bound on the
cost that rises to the least cost above it whenever nothing is found.  A state that
failed is noted with the cost it is now known to need, and isn't entered again below it.

Conversations of any length are cut into blocks of rows, in one range partitioning of all rows.
One that lies within a block is searched at once.  Of the others, each block finds the cost of
getting from any state to any other; a pass from the end adds these up, each block then searches
its edits for every state it may be entered in, and a pass from the start picks.  No
task holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import batched, pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rosterflow.llm import ship
from rosterflow.session import materialize

#: White space of the contract: space and \x09-\x0D.
BLANK = " \t\n\x0b\x0c\r"
BLOCK_ROWS = 64
INFINITE = 1 << 40

# States: what the messages kept so far end with.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
#: The state a new user or assistant message leads to.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Inserted messages that lead from each state to an end, and their cost.
TAIL = (0, 2, 1, 0)
REROLE, DELETE, INSERT, BROKEN = 1, 2, 5, 5
ENDS = tuple(n * INSERT for n in TAIL)

# Faults
CLEAN, EMPTY, REPEATED, TRUNCATED = range(4)


def fault(text: str, repeated: bool) -> int:
    """The first fault of a message: blank, a repetition, or broken off."""
    body = text.rstrip(BLANK)
    if not body:
        return EMPTY
    if repeated:
        return REPEATED
    return CLEAN if body[-1] in ".!?" else TRUNCATED


def kept_state(state: int, initial: str) -> int | None:
    """The state after a message that stays as it is; None if its role doesn't fit."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


class Search:
    """Cheapest edits of a run of messages, given the cost of going on from each state behind it."""

    def __init__(self, faults: Iterable[int], initials: Iterable[str], ends: Iterable[int]):
        self.faults, self.initials = list(faults), list(initials)
        self.ends = list(ends)
        self.least = self.bounds()
        self.path: list[str] = []

    def bounds(self) -> list[list[int]]:
        """A lower bound of the cost from each (message, state); infinite where the end can't be reached.

        Every message alone costs something: blank and repeated ones 2, broken ones 2 at least,
        system messages after the start and unknown roles 1.  Of ``n`` messages of one role in a row,
        half must change, rounded down.  These bounds never exceed what is needed.
        """
        n = len(self.faults)
        rows: list[list[int]] = [[]] * (n + 1)
        rows[n] = [min(e, INFINITE) for e in self.ends]
        alone, run, role, system = 0, 0, "", False
        for i in range(n - 1, -1, -1):
            kind, initial = self.faults[i], self.initials[i]
            if kind in (EMPTY, REPEATED):
                alone += DELETE
            elif kind == TRUNCATED or initial not in ("u", "a"):
                alone += run // 2 + (DELETE if kind == TRUNCATED else 1)
                run, role = 0, ""
                system = system or initial == "s"
            elif initial == role:
                run += 1
            else:
                alone += run // 2
                run, role = 1, initial
            low = alone + run // 2
            go = [min(self.ends[USER], self.ends[ASSISTANT])] * 4
            go[SYSTEM] = min(go[SYSTEM], self.ends[SYSTEM])
            go[START] = min(go[START], self.ends[START], self.ends[SYSTEM] if system else INFINITE)
            rows[i] = [min(INFINITE, low + go[s]) for s in range(4)]
            if system:  # one system message may stay at the start for nothing
                rows[i][START] = max(0, rows[i][START] - 1) if rows[i][START] < INFINITE else INFINITE
        return rows

    def visit(self, i: int, state: int, left: int) -> int:
        """0 if the end can be reached at a cost of ``left`` or less (``path`` then holds the edits), else the cost known to be needed."""
        need = self.least[i][state]
        if need > left:
            return need
        if i == len(self.faults):
            return 0
        kind, initial = self.faults[i], self.initials[i]
        stays = kind in (CLEAN, TRUNCATED)
        extra = BROKEN if kind == TRUNCATED else 0
        kept = kept_state(state, initial) if stays else None
        tries = [("D", DELETE, i + 1, state), ("I", INSERT, i, NEXT[state])]
        if kept is not None:
            tries.append(("K", extra, i + 1, kept))
        if stays and kept != NEXT[state]:  # to the same state, keeping is always cheaper
            tries.append(("R", REROLE + extra, i + 1, NEXT[state]))
        lowest = INFINITE
        for letter, cost, at, then in tries:
            if cost > left:
                lowest = min(lowest, cost + self.least[at][then])
                continue
            self.path.append(letter)
            more = self.visit(at, then, left - cost)
            if not more:
                return 0
            self.path.pop()
            lowest = min(lowest, cost + more)
        self.least[i][state] = max(need, min(lowest, INFINITE))
        return self.least[i][state]

    def run(self, state: int) -> tuple[int, str]:
        """The least cost from ``state`` and the letters of the edits; infinite cost and no letters if there are none."""
        bound = self.least[0][state]
        while bound < INFINITE:
            self.path = []
            more = self.visit(0, state, bound)
            if not more:
                return bound, "".join(self.path)
            bound = more
        return INFINITE, ""


def play(edits: str, state: int, faults: list[int], roles: list[str], texts: list[str]) -> tuple[int, int, list[tuple[str, str]]]:
    """Carry out edits: their cost without what comes after, the state they end in, and the messages ``(role, text)``."""
    i, cost, out = 0, 0, []
    for letter in edits:
        if letter == "D":
            i, cost = i + 1, cost + DELETE
            continue
        if letter == "K":
            state = kept_state(state, roles[i][:1])
            out.append((roles[i], texts[i]))
        else:
            state = NEXT[state]
            out.append((ROLE[state], texts[i] if letter == "R" else ""))
        cost += {"K": 0, "R": REROLE, "I": INSERT}[letter]
        if letter != "I":
            cost += BROKEN if faults[i] == TRUNCATED else 0
            i += 1
    return cost, state, out


# ------------------------------------------------------------------- blocks

LEGAL = {"su", "ua", "au"}
HEAD = "first_turn bigint, last_turn bigint, turns bigint, first_role string, last_role string, illegal bigint, blank bigint, duplicate bigint, truncated bigint"
ROWS = "faults array<int>, roles array<string>, texts array<string>"
HEADS, ROW_LISTS = ([c.split()[0] for c in ddl.split(", ")] for ddl in (HEAD, ROWS))


def flagged(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, repeated``: whether role and text were in an earlier turn of the conversation.

    Rows of one turn are told apart later, where equal ones lie side by side.  A role and text that
    very many rows share is one row of the small side; adaptive execution splits the other.
    """
    rows = messages.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    sized = lambda c: F.concat(F.length(c).cast("string"), F.lit(":"), c)
    whose = F.coalesce(sized(F.col("conv").cast("string")), F.lit("-"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.concat(whose, sized(F.col("role")), F.col("text")), 256)))
    order = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    first = rows.groupBy(F.col("digest").alias("known")).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = rows.join(first, rows.digest == first.known, "left")
    repeated = F.col("known").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    return joined.select("conv", "turn", "role", "text", repeated.alias("repeated"))


def runs(rows: Iterable[tuple], limit: int) -> Iterator[tuple[list[tuple], bool, bool]]:
    """Runs of ``limit`` rows at most of one conversation, and whether it is known to begin and to end there."""
    held: list[tuple] = []
    opens = False
    for row in rows:
        if held and row[0] != held[0][0]:
            yield held, opens, True
            held, opens = [], True
        elif len(held) >= limit:
            yield held, opens, False
            held, opens = [], False
        held.append(row)
    if held:  # the next partition may go on with this conversation
        yield held, opens, False


def mapped(frame: DataFrame, schema: str, step: Callable[[Iterator[dict]], Iterator[dict]], batch_rows: int = 200) -> DataFrame:
    """``step`` over the rows of each partition as they come; its rows leave in small batches."""
    types = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (b.slice(at, batch_rows) for b in batches for at in range(0, b.num_rows, batch_rows))
        for made in batched(step(row for part in slices for row in part.to_pylist()), batch_rows):
            yield pa.RecordBatch.from_pylist(list(made), types)

    return frame.mapInArrow(read, schema)


def cut(rows: DataFrame, block_rows: int) -> DataFrame:
    """All rows in one order (conversation, turn, role, text), cut into blocks of one conversation each.

    Block numbers rise along the order.  A conversation that lies within a block, with others
    before and behind it in the partition, has its ``edits``; a block of another has ``costs`` instead, the
    16 least costs from state to state.
    """
    order = ["conv", "turn", "role", "text"]
    kind = rows.schema["conv"].dataType.simpleString()

    def step(given: Iterator[dict]) -> Iterator[dict]:
        number, previous = TaskContext.get().partitionId() << 32, None
        rows = ((r["conv"], r["turn"], r["role"], r["text"], r["repeated"]) for r in given)
        for held, opens, closes in runs(rows, block_rows):
            faults = []
            for row in held:
                faults.append(fault(row[3], row[4] or row[:4] == previous))
                previous = row[:4]
            roles, texts = [r[2] for r in held], [r[3] for r in held]
            initials = [r[:1] for r in roles]
            turns = [r[1] for r in held if r[1] is not None]
            edits, costs = None, None
            if opens and closes:
                edits = Search(faults, initials, ENDS).run(START)[1]
                edits += "I" * TAIL[play(edits, START, faults, roles, texts)[1]]
            else:
                by_end = [Search(faults, initials, [0 if s == end else INFINITE for s in STATES]) for end in STATES]
                costs = [by_end[end].run(state)[0] for state in STATES for end in STATES]
            number += 1
            yield {
                "conv": held[0][0], "block": number, "first_turn": min(turns, default=None), "last_turn": max(turns, default=None),
                "turns": len(set(turns)), "first_role": initials[0], "last_role": initials[-1],
                "illegal": sum(a + b not in LEGAL for a, b in pairwise(initials)),
                "blank": faults.count(EMPTY), "duplicate": faults.count(REPEATED), "truncated": faults.count(TRUNCATED),
                "faults": faults, "roles": roles, "texts": texts, "edits": edits, "costs": costs,
            }

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return mapped(ordered, f"conv {kind}, block bigint, {HEAD}, {ROWS}, edits string, costs array<bigint>", step)


def in_turn(frame: DataFrame, backwards: bool, columns: list[str]) -> DataFrame:
    """The blocks of a conversation one behind the other in one partition, which passes them as a stream."""
    return frame.select("conv", "block", *columns).repartition("conv").sortWithinPartitions("conv", F.desc("block") if backwards else F.asc("block"))


def same_conversation(rows: Iterable[dict]) -> Iterator[tuple[bool, dict]]:
    """Each row, and whether it belongs to the conversation of the row before."""
    previous: tuple | None = None
    for row in rows:
        yield previous == (row["conv"],), row
        previous = (row["conv"],)


def joined_up(blocks: DataFrame) -> DataFrame:
    """``block, enter, edits`` of blocks that hold part of a conversation, from their ``costs``."""

    def backwards(rows: Iterator[dict]) -> Iterator[dict]:
        ends: list[int] = []
        for same, row in same_conversation(rows):
            ends = ends if same else list(ENDS)
            yield {"after": row["block"], "ends": ends, "last": not same}
            ends = [min(INFINITE, *(row["costs"][4 * s + q] + ends[q] for q in STATES)) for s in STATES]

    def solve(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            search = Search(row["faults"], [r[:1] for r in row["roles"]], row["ends"])
            found = [search.run(s) for s in STATES]
            edits = [e for _, e in found]
            exits = [play(e, s, row["faults"], row["roles"], row["texts"])[1] if c < INFINITE else -1 for s, (c, e) in enumerate(found)]
            if row["last"]:
                edits = [e + "I" * TAIL[q] if q >= 0 else e for e, q in zip(edits, exits, strict=True)]
            yield {"conv": row["conv"], "block": row["block"], "choices": edits, "exits": exits}

    def forwards(rows: Iterator[dict]) -> Iterator[dict]:
        state = START
        for same, row in same_conversation(rows):
            state = state if same else START
            yield {"block": row["block"], "enter": state, "chosen": row["choices"][state]}
            state = row["exits"][state]

    kind = blocks.schema["conv"].dataType.simpleString()
    ends = materialize(mapped(in_turn(blocks, True, ["costs"]), "after bigint, ends array<bigint>, last boolean", backwards), "ends")
    known = blocks.join(ends, F.col("block") == F.col("after")).select("conv", "block", *ROW_LISTS, "ends", "last")
    solved = materialize(mapped(known, f"conv {kind}, block bigint, choices array<string>, exits array<int>", solve), "choices")
    return materialize(mapped(in_turn(solved, False, ["choices", "exits"]), "block bigint, enter int, chosen string", forwards), "chosen")


# ------------------------------------------------------------------- results


def repair(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row for each block of a conversation, in the order of ``block``: ``conv, block, edits, cost, messages`` and counts.

    ``messages`` (structs of ``role, text``) are what the block's ``edits`` leave; ``blank``,
    ``duplicate`` and ``truncated`` count first faults, ``illegal`` the neighbours within the block whose
    roles can't follow one another.  Rows are taken by turn, nulls first, then by role and text.
    A null role or text is one space; a null conversation is one like others.  Repeated rows
    are duplicates, and further columns are left aside.  An empty table gives no rows.  ``block_rows``
    bounds what a task holds and doesn't change the edits.
    """
    ship(messages.sparkSession)
    blocks = materialize(cut(flagged(messages, conv, turn, role, text), block_rows), "blocks")
    kind = blocks.schema["conv"].dataType.simpleString()
    parts = joined_up(blocks.where("costs IS NOT NULL"))
    columns = ["conv", "block", *HEADS, *ROW_LISTS]
    whole = blocks.where("costs IS NULL").select(*columns, F.lit(START).alias("enter"), "edits")
    partial = blocks.where("costs IS NOT NULL").select(*columns).join(parts.withColumnRenamed("block", "of"), F.col("block") == F.col("of"))
    both = whole.unionByName(partial.select(*columns, "enter", F.col("chosen").alias("edits")))

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            cost, _, kept = play(row["edits"], row["enter"], *(row[c] for c in ROW_LISTS))
            yield {**{c: row[c] for c in ("conv", "block", "edits", *HEADS)}, "cost": cost, "messages": [{"role": r, "text": t} for r, t in kept]}

    return mapped(both, f"conv {kind}, block bigint, edits string, {HEAD}, cost bigint, messages array<struct<role:string,text:string>>", step)


def summaries(repaired: DataFrame) -> DataFrame:
    """One row for each conversation of :func:`repair`: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    The digest of a conversation runs over its blocks in order, as a stream; a digest can't be
    put together from parts.
    """
    line = F.transform("messages", lambda m: F.concat(m.role, F.lit(":"), m.text))
    kind = repaired.schema["conv"].dataType.simpleString()
    added = ["blank", "duplicate", "truncated", "illegal", "cost"]

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        total: dict | None = None
        for same, row in same_conversation(rows):
            if not same:
                if total is not None:
                    yield finished(total)
                total = {"conv": row["conv"], **dict.fromkeys(added, 0), "edits": [], "digest": hashlib.sha256(), "any": False, "turns": 0, "low": None, "high": None}
                role = None
            for c in added:
                total[c] += row[c]
            total["illegal"] += role is not None and role + row["first_role"] not in LEGAL
            role = row["last_role"]
            total["edits"].append(row["edits"])
            if row["turns"]:
                total["turns"] += row["turns"] - (row["first_turn"] == total["high"])
                total["low"] = row["first_turn"] if total["low"] is None else total["low"]
                total["high"] = row["last_turn"]
            if row["text"] is not None:
                total["digest"].update((b"\n" if total["any"] else b"") + row["text"].encode("utf-8", "surrogatepass"))
                total["any"] = True
        if total is not None:
            yield finished(total)

    def finished(total: dict) -> dict:
        gaps = total["high"] - total["low"] + 1 - total["turns"] if total["turns"] else 0
        return {**{c: total[c] for c in ("conv", *added)}, "gaps": gaps, "audit": "".join(total["edits"]), "repaired_sha256": total["digest"].hexdigest()}

    lines = repaired.withColumn("text", F.when(F.size("messages") > 0, F.array_join(line, "\n"))).drop("messages")
    dealt = in_turn(lines, False, [*HEADS, "cost", "edits", "text"])
    sums = ", ".join(f"{c} bigint" for c in ("gaps", *added))
    return mapped(dealt, f"conv {kind}, {sums}, audit string, repaired_sha256 string", step)
