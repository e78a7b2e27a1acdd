"""Quotation linking: find which message a reply quotes, and put conversations in reply order without quotes.

A line's quote level is the number of ``>`` marks in front of it.  A passage is a run of
lines of one level without a blank one between; passages are compared by the hash of their normalised
content: without marks, in lower case, white space and line breaks collapsed, so that it
doesn't matter where a mail program broke the lines.  A quoted passage belongs to the last
earlier message of its conversation that wrote it itself.  A passage without an original may be
part of one: its lines, and then its sentences, are looked up in the same way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.session import materialize

MARKS = r"^[ \t]{0,3}((?:>[ \t]?)*)"
# How mail programs announce a quote.
ANNOUNCES = r"(?i)^(on|am|le|el) .*(wrote|schrieb|a écrit|escribió).*:\s*$"
NO_KEY = -(2**63)
TURNS = 1024


def parsed(text: Column) -> Column:
    """The lines of a text as structs of ``level`` (0: the writer's own) and ``content``; null text has one empty line."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r", ""), "\n", -1)
    level = lambda line: F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))
    return F.transform(
        lines,
        lambda line: F.struct(
            level(line).alias("level"),
            F.when(level(line) > 0, F.regexp_replace(line, MARKS, "")).otherwise(line).alias("content"),
        ),
    )


def own_lines(lines: str) -> Column:
    """The lines that are no quotes and announce none."""
    return F.filter(lines, lambda line, i: (line.level == 0) & ~announcing(lines, i))


def normalised(content: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(content), r"\s+", " "))


def numbered(key: Column) -> Column:
    """Keys for grouping and joining: null is a key of its own."""
    return F.coalesce(key.cast("bigint"), F.lit(NO_KEY))


def hashed(content: Column) -> Column:
    return F.xxhash64(normalised(content))


def passages(lines: str = "lines") -> Column:
    """The passages of a message: ``level, n`` (lines), ``content`` (lines joined by spaces) and ``parts`` (the lines).

    Lines that are blank, or announce a quote, end a passage and are in none.
    """
    counts = lambda i: F.get(lines, i).content.rlike(r"\S") & ~announcing(lines, i)
    joined = lambda i, j: F.coalesce(counts(i) & counts(j) & (F.get(lines, i).level == F.get(lines, j).level), F.lit(False))
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    starts = F.filter(every, lambda i: counts(i) & ~joined(i - 1, i))
    ends = F.filter(every, lambda i: counts(i) & ~joined(i, i + 1))

    def passage(start: Column, end: Column) -> Column:
        parts = F.transform(F.slice(lines, start + 1, end - start + 1), lambda x: x.content)
        return F.struct(
            F.get(lines, start).level.alias("level"), (end - start + 1).cast("bigint").alias("n"),
            F.array_join(parts, " ").alias("content"), parts.alias("parts"),
        )

    return F.zip_with(starts, ends, passage)


def announcing(lines: str, i: Column) -> Column:
    """Whether a line of the writer's own announces the quote that follows it."""
    own, next_ = F.get(lines, i), F.get(lines, i + 1)
    return F.coalesce((own.level == 0) & own.content.rlike(ANNOUNCES) & (next_.level > 0), F.lit(False))


def pieces_of(passage: Column) -> Column:
    """What a passage may be found by in part: its lines, and its sentences of three words or more; ``kind`` tells which."""
    sentences = F.filter(F.split(passage.content, r"(?<=[.!?])\s+"), lambda s: s.rlike(r"\S\s+\S+\s+\S"))
    tagged = lambda units, kind: F.transform(units, lambda u: F.struct(F.lit(kind).alias("kind"), hashed(u).alias("unit")))
    return F.concat(tagged(passage.parts, "line"), tagged(sentences, "sentence"))


def origins(written: DataFrame, quoted: DataFrame) -> DataFrame:
    """The rows of ``quoted`` (``conv, turn, unit`` and others) with ``origin``, the last earlier turn that wrote the unit, or null.

    ``written`` has ``conv, turn, unit``, each once.  The last earlier turn is found by running
    maxima within blocks of turns, and over the blocks, so that a unit which very many
    messages hold is spread over tasks.
    """
    rest = [c for c in quoted.columns if c not in ("conv", "turn", "unit")]
    events = written.select("conv", "unit", "turn", F.col("turn").alias("origin"), F.lit(None).cast(quoted.select(F.struct(*rest)).schema[0].dataType).alias("row"))
    asked = quoted.select("conv", "unit", "turn", F.lit(None).cast("bigint").alias("origin"), F.struct(*rest).alias("row"))
    events = events.unionByName(asked).withColumn("block", F.expr(f"turn div {TURNS}"))
    earlier = Window.partitionBy("conv", "unit", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy("conv", "unit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        events.groupBy("conv", "unit", "block").agg(F.max("origin").alias("origin"))
        .select("conv", "unit", "block", F.max("origin").over(blocks).alias("carried")).where("carried IS NOT NULL")
    )
    found = events.withColumn("near", F.max("origin").over(earlier)).where("row IS NOT NULL")
    joined = found.join(carried, ["conv", "unit", "block"], "left")
    return joined.select("conv", "turn", "unit", "row.*", F.coalesce("near", "carried").alias("origin"))


def links(lines: DataFrame) -> DataFrame:
    """``conv, turn, level, origin, n``: how many quoted lines of a level come from the message ``origin``.

    ``lines`` has ``conv, turn, lines``.  Parts of passages are looked up only for passages without an
    original, in their conversations.
    """
    keyed = lines.where((F.col("conv") != NO_KEY) & (F.col("turn") != NO_KEY))
    placed = keyed.select("conv", "turn", F.explode(passages()).alias("p"))
    units = materialize(placed.select("conv", "turn", "p.level", "p.n", hashed(F.col("p.content")).alias("unit")), "passages")
    written = units.where("level = 0").select("conv", "turn", "unit").distinct()
    quoted = units.where("level > 0").groupBy("conv", "turn", "unit", "level").agg(F.sum("n").alias("n"))
    first = materialize(origins(written, quoted), "origins")
    whole = first.where("origin IS NOT NULL").select("conv", "turn", "level", "origin", "n")

    lost = materialize(first.where("origin IS NULL").select("conv", "turn", "unit", "level").distinct(), "lost")
    if lost.isEmpty():
        return added_up(whole)
    # the conversations that ask are known before any message is taken apart again, and its parts are made once
    asking = materialize(lost.select("conv").distinct(), "asking")
    known = keyed.join(asking, "conv", "left_semi").select("conv", "turn", F.explode(passages()).alias("p"))
    known = known.withColumn("passage", hashed(F.col("p.content")))
    parts = known.select("conv", "turn", "passage", "p.level", "p.n", F.explode(pieces_of(F.col("p"))).alias("x")).select(
        "conv", "turn", "passage", "level", "n", "x.kind", "x.unit"
    )
    parts = materialize(parts, "parts")
    asked = parts.where("level > 0").join(lost.withColumnRenamed("unit", "passage"), ["conv", "turn", "passage", "level"], "left_semi")
    # a passage that a message repeats is asked for once, and counts as often as it stands there
    asked = asked.groupBy("conv", "turn", "passage", "level", "n", "kind", "unit").agg(F.count(F.lit(1)).alias("times"))
    found = origins(parts.where("level = 0").select("conv", "turn", "unit").distinct(), asked).where("origin IS NOT NULL")
    found = materialize(found, "part_origins")
    by_line = found.where("kind = 'line'").select("conv", "turn", "passage", "level", "origin", F.col("times").alias("n"))
    best = found.where("kind = 'sentence'").join(by_line, ["conv", "turn", "passage", "level"], "left_anti")
    best = best.groupBy("conv", "turn", "passage", "level", "n", "origin").agg(F.sum("times").alias("times"))
    by_sentence = best.groupBy("conv", "turn", "passage", "level", "n").agg(F.max(F.struct("times", "origin")).alias("best"))
    both = by_line.drop("passage").unionByName(by_sentence.select("conv", "turn", "level", F.col("best.origin").alias("origin"), "n"))
    return added_up(whole.unionByName(both))


def added_up(found: DataFrame) -> DataFrame:
    return found.groupBy("conv", "turn", "level", "origin").agg(F.sum("n").alias("n"))


def parents(found: DataFrame) -> DataFrame:
    """``conv, turn, parent, linked``: of the lowest level linked, the message with the most lines; the later one of two."""
    best = F.max(F.struct((-F.col("level")).alias("shallow"), "n", "origin"))
    return found.groupBy("conv", "turn").agg(best.alias("best"), F.sum("n").alias("linked")).select(
        "conv", "turn", F.col("best.origin").alias("parent"), "linked"
    )


def roots(tree: DataFrame) -> DataFrame:
    """``conv, turn, root, depth`` of the messages with a parent, by pointer jumping.

    Each round doubles the length of the paths that are followed, and messages that have
    reached their root leave.  A round's result is written to the shared folder.
    """
    columns = ["conv", "turn", "root", "depth"]
    open_ = materialize(tree.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("bigint").alias("depth")), "paths")
    reached: list[DataFrame] = []
    while True:
        state = reduce(DataFrame.unionByName, reached, open_)
        above = state.select("conv", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        stepped = materialize(
            open_.join(above, ["conv", "root"], "left").select(
                "conv", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "paths",
        )
        reached.append(stepped.where("NOT moved").select(columns))
        open_ = stepped.where("moved").select(columns)
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, reached)


def positions(rows: DataFrame) -> DataFrame:
    """Adds ``position``, 0 and up in each conversation: by root, then turn.

    Numbers are counted within blocks of turns of a thread; blocks, threads and
    blocks of threads are then offset, so that no window holds all rows of a long
    conversation.
    """
    rows = rows.withColumns({"block": F.expr(f"turn div {TURNS}"), "group": F.expr(f"root div {TURNS}")})
    before = lambda *keys: Window.partitionBy(*keys)
    running = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within = F.row_number().over(before("conv", "root", "block").orderBy("turn", "role", "text")) - 1
    counts = materialize(rows.groupBy("conv", "group", "root", "block").agg(F.count(F.lit(1)).alias("n")), "thread_blocks")
    threads = counts.groupBy("conv", "group", "root").agg(F.sum("n").alias("n"))
    groups = threads.groupBy("conv", "group").agg(F.sum("n").alias("n"))
    offset = lambda frame, keys, order: frame.select(
        *keys, order, F.coalesce(F.sum("n").over(running(before(*keys).orderBy(order))), F.lit(0)).alias(f"before_{order}")
    )
    ahead = (
        offset(counts, ["conv", "group", "root"], "block")
        .join(offset(threads, ["conv", "group"], "root"), ["conv", "group", "root"])
        .join(offset(groups, ["conv"], "group"), ["conv", "group"])
        .select("conv", "root", "block", (F.col("before_block") + F.col("before_root") + F.col("before_group")).alias("ahead"))
    )
    return rows.withColumn("within", within).join(ahead, ["conv", "root", "block"]).withColumn("position", F.col("within") + F.col("ahead"))


def reply_ordered(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Every message: ``conv_id, turn, role, text, parent_turn, root_turn, depth, position, quoted, linked, formatted``.

    ``text`` is what the writer added: without quotes, lines that announce quotes, and
    white space at the ends; null counts as empty.  ``parent_turn`` is the message that the
    quotes answer, null if none is found.  ``position`` orders a conversation by threads,
    each message behind the one it answers.  ``quoted`` and ``linked`` count quoted lines
    that aren't blank, and those with an original.  Rows that repeat a (conversation, turn)
    each stay and share a parent.  A message without a conversation or turn links with
    nothing and comes first.  An empty table gives no rows.
    """
    lines = materialize(messages.select(
        numbered(F.col(conv)).alias("conv"), numbered(F.col(turn)).alias("turn"), F.col(role).cast("string").alias("role"),
        parsed(F.col(text).cast("string")).alias("lines"),
    ), "lines")
    ends = r"^\s+|\s+$"
    spoken_quotes = F.filter("lines", lambda x: (x.level > 0) & (normalised(x.content) != ""))
    bodies = materialize(
        lines.select(
            "conv", "turn", "role", F.size(spoken_quotes).cast("bigint").alias("quoted"),
            F.regexp_replace(F.array_join(F.transform(own_lines("lines"), lambda x: x.content), "\n"), ends, "").alias("text"),
        ),
        "bodies",
    )
    tree = materialize(parents(links(lines)), "parents")
    placed = tree.join(roots(tree), ["conv", "turn"])
    joined = bodies.join(placed, ["conv", "turn"], "left").withColumns(
        {"root": F.coalesce("root", "turn"), "depth": F.coalesce("depth", F.lit(0)), "linked": F.coalesce("linked", F.lit(0))}
    )
    given = lambda c: F.when(F.col(c) != NO_KEY, F.col(c))
    return positions(joined).select(
        given("conv").alias("conv_id"), given("turn").alias("turn"), "role", "text", F.col("parent").alias("parent_turn"),
        given("root").alias("root_turn"), "depth", "position", "quoted", "linked",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("text")).alias("formatted"),
    )
