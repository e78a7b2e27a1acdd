"""Similarity join on word n-grams by prefixes that adapt to their cost.

All texts order their shingles alike: those of unknown, low frequency by hash, then
the known frequent ones from rare to frequent.  If two sets are similar, the first
``n - ceil(t * n) + l`` shingles of both, their l-prefixes, share ``l`` at least.  A text
whose prefix reaches into frequent shingles weighs what its posting lists and the
verification of its candidates would cost for several ``l``, and takes the cheapest: a
longer prefix, of which a partner must share more.  A pair needs the smaller of its two
``l``; then the whole sets are compared.

Only the groups that links form are asked for.  So each posting first links its texts
with a few centres, a number of pairs in proportion to the texts; what is left are pairs
between groups that are still apart.  Shingles in very many texts, which are in a prefix
only where a text has little else, are treated in blocks of texts and never paired up
as rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.llm.batches import byte_slices, in_turn, list_array, ragged
from rosterflow.llm.components import components
from rosterflow.session import materialize


@dataclass(frozen=True)
class JoinPlan:
    """Bounds of memory and sizes of blocks; none of them changes the result.

    ``known_from``: the frequency from which a shingle's frequency is known to all tasks,
    of the ``known`` most frequent shingles (12 bytes each).  ``hot_from``: the posting
    length from which a shingle is treated in blocks.  ``bloom_bits``: the size of the
    filter that spares texts without candidates a second shingling.
    """

    percent: int = 80
    width: int = 5
    known_from: int = 8
    known: int = 1_000_000
    hot_from: int = 32
    longest: int = 4
    verification: float = 16.0
    bloom_bits: int = 1 << 26
    flush: int = 500_000
    block: int = 2048


# ------------------------------------------------------------------- shingling

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; all forgotten when there are too many."""

    limit = 300_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


def shingles(values: list[str | None], width: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Flat sorted distinct shingle hashes of texts, and how many each text has.

    Words are runs of bytes other than space and \\x09-\\x0D, with A-Z in lower case.  A
    text of fewer words than ``width`` is one shingle, one without words has none.
    """
    words = [v.encode("utf-8", "surrogatepass").lower().split() if v else [] for v in values]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    hashes = np.fromiter((known[w] for ws in words for w in ws), dtype=np.uint64, count=int(counts.sum()))
    made = np.maximum(counts - width + 1, np.minimum(counts, 1))
    total = int(made.sum())
    if not total:
        return np.zeros(0, dtype=np.uint64), made
    starts = np.cumsum(counts) - counts
    at = ragged(starts, made)
    size = np.repeat(np.minimum(counts, width), made)
    flat = size.astype(np.uint64)
    for i in range(width):
        inside = np.minimum(at + i, len(hashes) - 1)
        step = _mix(flat * _MULTIPLIER + hashes[inside])
        flat = np.where(i < size, step, flat)
    owner = np.repeat(np.arange(len(values)), made)
    order = np.lexsort((flat, owner))
    flat, owner = flat[order], owner[order]
    first = np.r_[True, (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])]
    return flat[first], np.bincount(owner[first], minlength=len(values))


def signature(tokens: np.ndarray) -> int:
    """63 bits that stand for a set of shingles."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) >> 1


def parted(tokens: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of the hash range and 32 further bits of each shingle."""
    high = tokens >> np.uint64(32)
    return (high * np.uint64(parts) >> np.uint64(32)).astype(np.int64), (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def planes(ascending: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as byte planes of their differences, which compress well."""
    return np.diff(ascending, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)
    return np.cumsum(steps, dtype=np.uint32)


def least_overlap(n, percent: int):
    """How many shingles a set of ``n`` must share with any similar set."""
    return (percent * n + 99) // 100


# ----------------------------------------------------------------- frequencies


def frequencies(texts: DataFrame, plan: JoinPlan, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles as sorted numbers (part and 32 bits), with their frequencies.

    Every shingle of every text is counted: within a task first, then by parts of
    the hash range, whose sorted arrays are dealt out as they are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, size = WordHashes(), [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            part, key = parted(np.concatenate(held), parts)
            numbers, n = np.unique(part.astype(np.uint64) << np.uint64(32) | key, return_counts=True)
            cuts = np.searchsorted(numbers, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
            rows = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
            keys, n = (numbers & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.minimum(n, 2**31 - 1).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _, _ in rows], pa.int32()),
                    pa.array([planes(keys[a:b]) for _, a, b in rows], pa.binary()),
                    # nearly all counts are one: only the others are sent, by place
                    pa.array([more(n[a:b]) for _, a, b in rows], pa.binary()),
                ],
                ["part", "keys", "counts"],
            )

        def more(n: np.ndarray) -> bytes:
            at = np.flatnonzero(n > 1)
            return np.stack([at.astype("<i4"), n[at]]).tobytes()

        for batch in byte_slices(batches, "text"):
            flat, _ = shingles(batch.column("text").to_pylist(), plan.width, known)
            held.append(flat)
            size += len(flat)
            if size >= plan.flush:
                yield from emit()
                held, size = [], 0
        if size:
            yield from emit()

    def add_up(table: pa.Table) -> pa.Table:
        part, keys, counts = table.column("part")[0].as_py(), [], []
        for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True):
            keys.append(from_planes(k))
            n = np.ones(len(keys[-1]), dtype=np.int64)
            at = np.frombuffer(c, "<i4").reshape(2, -1)
            n[at[0]] = at[1]
            counts.append(n)
        found, where = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)
        many = n >= plan.known_from
        numbers = (np.int64(part) << 32) | found[many].astype(np.int64)
        return pa.table({"number": pa.array(numbers, pa.int64()), "df": pa.array(n[many], pa.int64())})

    packed = texts.select("text").mapInArrow(in_turn("jaccard", count), "part int, keys binary, counts binary")
    counted = packed.groupBy("part").applyInArrow(add_up, "number bigint, df bigint")
    rows = counted.orderBy(F.desc("df"), "number").limit(plan.known).toPandas()  # at most plan.known rows
    rows = rows.sort_values("number")
    return rows["number"].to_numpy(np.uint64), rows["df"].to_numpy(np.int64)


# -------------------------------------------------------------------- prefixes


def prefix(tokens: np.ndarray, df: np.ndarray, plan: JoinPlan) -> tuple[np.ndarray, int]:
    """The places of a text's prefix in its sorted shingles, and the ``l`` it takes; ``df`` is 0 where unknown."""
    n = len(tokens)
    short = n - int(least_overlap(n, plan.percent)) + 1
    known = np.flatnonzero(df)
    rare = np.flatnonzero(df == 0)
    if len(rare) >= short:
        return rare[:short], 1
    order = np.concatenate([rare, known[np.lexsort((tokens[known], df[known]))]])
    lists = np.cumsum(np.maximum(df[order], 1))
    lengths = np.arange(short, min(n, short + plan.longest - 1) + 1)
    cost = lists[lengths - 1] * (1 + plan.verification / (lengths - short + 1))
    best = int(cost.argmin())
    return order[: lengths[best]], best + 1


def scan(texts: DataFrame, plan: JoinPlan, parts: int, known: Broadcast) -> DataFrame:
    """What the join needs of each text, in rows of three kinds.

    0: ``id, cls, n, ell`` of a text with the length ``p`` of its prefix, the number ``h`` of hot
    shingles in it, and the place in the order, ``(end_df, end_hash)``, of its last one; 1: ``part`` with packed ``tokens`` and
    ``owners`` of prefix shingles that aren't hot; 2: ``token`` and ``cls`` of hot ones.  ``cls``
    stands for the set of shingles: equal sets share it, and it is -1 for a text without words.
    The packed tokens are 32 bits that, with their part, tell shingles apart well enough
    to find candidates.
    """
    schema = pa.schema([
        ("kind", pa.int8()), ("id", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("ell", pa.int32()),
        ("p", pa.int64()), ("h", pa.int64()), ("end_df", pa.int64()), ("end_hash", pa.int64()), ("part", pa.int32()), ("tokens", pa.binary()), ("owners", pa.binary()), ("token", pa.int64()),
    ])

    def rows(kind: int, **columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        arrays = [
            pa.array(np.full(size, kind, np.int8)) if f.name == "kind"
            else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
            for f in schema
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, frequency = known.value
        hashes, seen = WordHashes(), set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            tokens, owners = np.concatenate([t for t, _ in held]), np.concatenate([o for _, o in held])
            part, key = parted(tokens, parts)
            order = np.lexsort((key, part))
            part, key, owners = part[order], key[order], owners[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            spans = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
            yield rows(
                1, part=[p for p, _, _ in spans],
                tokens=[planes(key[a:b]) for _, a, b in spans],
                owners=[owners[a:b].astype("<i8").tobytes() for _, a, b in spans],
            )

        for batch in byte_slices(batches, "text"):
            flat, counts = shingles(batch.column("text").to_pylist(), plan.width, hashes)
            part, key = parted(flat, parts)
            number = part.astype(np.uint64) << np.uint64(32) | key
            at = np.minimum(np.searchsorted(numbers, number), max(0, len(numbers) - 1))
            df = np.where(numbers[at] == number, frequency[at], 0) if len(numbers) else np.zeros(len(flat), np.int64)
            ends = np.cumsum(counts)
            classes, ells, sizes, heat, last_df, last_hash, hot_tokens, hot_owners = [], [], [], [], [], [], [], []
            for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
                if a == b:
                    classes.append(-1)
                    for column in (ells, sizes, heat, last_df, last_hash):
                        column.append(0)
                    continue
                tokens = flat[a:b]
                cls = signature(tokens)
                places, ell = prefix(tokens, df[a:b], plan)
                classes.append(cls)
                ells.append(ell)
                sizes.append(len(places))
                last_df.append(int(df[a + places[-1]]))
                last_hash.append(int(tokens[places[-1]] >> np.uint64(1)))
                hot = df[a:b][places] >= plan.hot_from
                heat.append(int(hot.sum()))
                if cls in seen:
                    continue
                if len(seen) < 200_000:
                    seen.add(cls)
                calm = tokens[places[~hot]]
                held.append((calm, np.full(len(calm), cls, dtype=np.int64)))
                size += len(calm)
                if hot.any():
                    hot_tokens.append(tokens[places[hot]].view(np.int64))
                    hot_owners.append(np.full(int(hot.sum()), cls, dtype=np.int64))
            yield rows(0, id=batch.column("id"), cls=classes, n=counts, ell=ells, p=sizes, h=heat, end_df=last_df, end_hash=last_hash)
            if hot_tokens:
                yield rows(2, token=np.concatenate(hot_tokens), cls=np.concatenate(hot_owners))
            if size >= plan.flush:
                yield from emit()
                held, size = [], 0
        if size:
            yield from emit()

    ddl = "kind tinyint, id bigint, cls bigint, n bigint, ell int, p bigint, h bigint, end_df bigint, end_hash bigint, part int, tokens binary, owners binary, token bigint"
    return materialize(texts.mapInArrow(in_turn("jaccard", read), ddl), "prefixes")


def postings(scanned: DataFrame, plan: JoinPlan) -> DataFrame:
    """``token, owners`` of the shingles with two classes or more: ``owners`` is null for the rows ``token, cls`` of long lists."""

    def group(table: pa.Table) -> pa.Table:
        keys = np.concatenate([from_planes(t) for t in table.column("tokens").to_pylist()])
        tokens = np.int64(table.column("part")[0].as_py()) << 32 | keys.astype(np.int64)
        owners = np.frombuffer(b"".join(table.column("owners").to_pylist()), "<i8")
        order = np.lexsort((owners, tokens))
        tokens, owners = tokens[order], owners[order]
        fresh = np.r_[True, (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])]
        tokens, owners = tokens[fresh], owners[fresh]
        starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        sizes = np.diff(np.r_[starts, len(tokens)])
        some = (sizes >= 2) & (sizes <= 4 * plan.hot_from)
        lists = list_array(owners[ragged(starts[some], sizes[some])], sizes[some], pa.int64())
        long = sizes > 4 * plan.hot_from
        at = ragged(starts[long], sizes[long])
        return pa.table({
            "token": pa.array(np.r_[tokens[starts[some]], tokens[at]], pa.int64()),
            "owners": pa.chunked_array([lists, pa.nulls(len(at), lists.type)], type=lists.type),
            "cls": pa.array(np.r_[np.full(int(some.sum()), -1, np.int64), owners[at]], pa.int64()),
        })

    packed = scanned.where("kind = 1").select("part", "tokens", "owners")
    return materialize(packed.groupBy("part").applyInArrow(group, "token bigint, owners array<bigint>, cls bigint"), "postings")


# ------------------------------------------------------------------ verification


def similar(n_a, n_b, shared, percent: int):
    return 100 * shared >= percent * (n_a + n_b - shared)


def verified(pairs: DataFrame, sets: DataFrame, plan: JoinPlan) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(similar(F.size("left"), F.size("right"), shared, plan.percent)).select("a", "b")
    )


def sized(pairs: DataFrame, classes: DataFrame, plan: JoinPlan) -> DataFrame:
    """The pairs ``a, b, shared`` that can be similar by their sizes and the ends of their prefixes.

    ``shared`` counts the common prefix shingles that aren't hot; all hot ones may be common
    too.  There must be as many as the smaller ``ell``.  Of the text whose prefix ends first, all
    common shingles up to that end are among those; of its other ``n - p``, each may be common.
    """
    columns = ("n", "ell", "p", "h", "end_df", "end_hash")
    one = lambda x: classes.select(F.col("cls").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns])
    fits = 100 * F.least("n_a", "n_b") >= plan.percent * F.greatest("n_a", "n_b")
    first = F.struct("end_df_a", "end_hash_a") <= F.struct("end_df_b", "end_hash_b")
    common = F.col("shared") + F.least("h_a", "h_b")
    most = common + F.when(first, F.col("n_a") - F.col("p_a")).otherwise(F.col("n_b") - F.col("p_b"))
    # a common part of c out of n_a + n_b - c reaches the percentage
    enough = (100 + plan.percent) * most >= plan.percent * (F.col("n_a") + F.col("n_b"))
    return pairs.join(one("a"), "a").join(one("b"), "b").where(fits & enough & (common >= F.least("ell_a", "ell_b")))


def block_links(x: pa.Table, y: pa.Table, percent: int) -> pa.Table:
    """Links between texts of two blocks that lie in different groups: for each x, one with each group."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    if not x.num_rows or not y.num_rows:
        return schema.empty_table()
    flat = x.column("tokens").combine_chunks()
    tokens, lengths = flat.flatten().to_numpy(zero_copy_only=False), flat.value_lengths().to_numpy(zero_copy_only=False)
    vocabulary, place = np.unique(tokens, return_inverse=True)
    cls_x, comp_x = x.column("cls").to_numpy(), x.column("comp").to_numpy()
    cls_y, comp_y = y.column("cls").to_numpy(), y.column("comp").to_numpy()
    size_x = lengths.astype(np.int64)
    links: set[tuple[int, int]] = set()
    # x's sets as lists by shingle: each shingle of a y adds one to the texts that hold it
    owner = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(place, kind="stable")
    owner = owner[order]
    starts = np.searchsorted(place[order], np.arange(len(vocabulary) + 1))
    other = y.column("tokens").combine_chunks()
    all_y, offsets = other.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(other.value_lengths().to_numpy(zero_copy_only=False))]
    for j in range(len(cls_y)):
        mine = all_y[offsets[j] : offsets[j + 1]]
        at = np.minimum(np.searchsorted(vocabulary, mine), len(vocabulary) - 1)
        at = at[vocabulary[at] == mine]
        shared = np.bincount(owner[ragged(starts[at], starts[at + 1] - starts[at])], minlength=len(size_x))
        good = np.flatnonzero(similar(size_x, len(mine), shared, percent) & (comp_x != comp_y[j]))
        links.update((int(cls_x[i]), int(cls_y[j])) for i in good)
    best: dict[tuple[int, int], int] = {}
    group = dict(zip(cls_y.tolist(), comp_y.tolist(), strict=True))
    for a, b in sorted(links):
        best.setdefault((a, group[b]), b)
    return pa.table({"a": [a for a, _ in best], "b": list(best.values())}, schema=schema)


def bundles(entries: DataFrame, labels: DataFrame, classes: DataFrame, plan: JoinPlan) -> DataFrame:
    """``bundle, cls, comp`` of the texts that hot postings may link, with the bundle's largest group, ``major``, and sizes.

    Those are the postings whose texts lie in several groups, one of them mostly hot.  Pairs
    that share another shingle too are found by that one.  Long postings of shingles that
    aren't known to be hot (``long``) are kept in any case.  Postings that share texts make
    one bundle, in which each text is met once.
    """
    warm = classes.where(heated(plan)).select("cls", F.lit(True).alias("warm"))
    labelled = entries.join(labels, "cls", "left").join(warm, "cls", "left").select(
        "token", "cls", F.coalesce("component", "cls").alias("comp"), (F.col("long") | F.coalesce("warm", F.lit(False))).alias("warm")
    )
    mixed = labelled.groupBy("token").agg(
        F.min("cls").alias("hub"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.bool_or("warm").alias("some_warm")
    )
    apart = labelled.drop("warm").join(mixed.where("low <> high AND some_warm").select("token", "hub"), "token")
    members = materialize(apart.select("cls", "comp", "hub").distinct(), "hot_members")
    whole = components(members.select(F.col("hub").alias("a"), F.col("cls").alias("b"))).select(
        F.col("node").alias("cls"), F.col("component").alias("bundle")
    )
    texts = members.select("cls", "comp").distinct().join(whole, "cls")
    counts = texts.groupBy("bundle", "comp").agg(F.count(F.lit(1)).alias("size"))
    major = counts.groupBy("bundle").agg(
        F.max_by("comp", F.struct("size", "comp")).alias("major"), F.sum("size").alias("total"), F.max("size").alias("most")
    )
    return texts.join(major, "bundle")


def hot_links(apart: DataFrame, sets: DataFrame, plan: JoinPlan) -> DataFrame:
    """Links by hot shingles, between texts of different groups.

    In each bundle the largest group needs no comparison with itself: the texts
    outside it are compared, block by block, with all of the bundle.
    """
    n_blocks = lambda n: F.ceil(n / plan.block).cast("int")
    open_ = apart.withColumns({"x_blocks": n_blocks(F.col("total") - F.col("most")), "y_blocks": n_blocks(F.col("total"))})
    own = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blocks = ["bundle", "x_block", "y_block"]
    x = open_.where("comp <> major").withColumn("x_block", own("x_blocks")).withColumn("y_block", every("y_blocks"))
    y = open_.withColumn("y_block", own("y_blocks")).withColumn("x_block", every("x_blocks"))
    columns = [F.col(c).alias(c) for c in (*blocks, "cls", "comp", "tokens")]  # both sides come from one frame: new names
    carried = lambda side: side.join(sets, "cls").select(*columns).groupBy(*blocks)
    percent = plan.percent

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        return block_links(a, b, percent)

    return carried(x).cogroup(carried(y)).applyInArrow(compare, "a bigint, b bigint").distinct()


# ------------------------------------------------------------------------- join


def heated(plan: JoinPlan):
    """Whether a text's shingles are mostly hot, which one text of a pair must be that shares hot ones alone.

    A text with a hot shingle in its prefix has all its others, ``p - h``, in it as well.  If x
    and y share none of these, they have ``n_x - r_x`` in common at most, out of ``n_x + r_y`` at
    least.  With both ``r`` beyond ``(1 - t) / (1 + t)`` of ``n`` that is less than ``t``.
    """
    return (100 + plan.percent) * (F.col("p") - F.col("h")) <= (100 - plan.percent) * F.col("n")


def star_pairs(lists: DataFrame, entries: DataFrame, classes: DataFrame, plan: JoinPlan) -> DataFrame:
    """``a, b``: each text of a posting with the posting's centre, if they may be similar.

    A long posting has the first texts of a few random orders for centres.  These pairs are
    only to join most groups cheaply; none needs to be complete.
    """
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    short = lists.select(F.explode(F.slice("owners", 2, 4 * plan.hot_from)).alias("x"), F.element_at("owners", 1).alias("centre"))
    counted = short.groupBy(*ordered("x", "centre")).agg(F.count(F.lit(1)).alias("shared"))
    mild = sized(counted, classes, plan).select("a", "b")
    orders = [F.min_by("cls", F.xxhash64("cls", F.lit(r))).alias(f"c{r}") for r in range(4)]
    mostly = entries.join(classes.where(heated(plan)).select("cls", "h"), "cls")
    long = mostly.join(mostly.groupBy("token").agg(*orders), "token")
    hot = long.select(F.col("cls").alias("x"), "h", F.explode(F.array("c0", "c1", "c2", "c3")).alias("centre")).where("x <> centre")
    often = hot.groupBy("x", "centre").agg(F.count(F.lit(1)).alias("met"), F.min("h").alias("h")).where("2 * met >= h")
    fits = sized(often.select(*ordered("x", "centre")).distinct().withColumn("shared", F.lit(2**31)), classes, plan).select("a", "b")
    return materialize(mild.unionByName(fits).distinct(), "star_pairs")


def rest_pairs(lists: DataFrame, labels: DataFrame, classes: DataFrame, plan: JoinPlan) -> DataFrame:
    """``a, b``: texts in different groups that share shingles of short postings and may be similar."""
    entries = lists.select("token", F.explode("owners").alias("cls")).join(labels, "cls", "left")
    grouped = entries.groupBy("token").agg(
        F.collect_list(F.struct("cls", F.coalesce("component", "cls").alias("comp"))).alias("members"),  # 4 * hot_from at most
        F.min(F.coalesce("component", "cls")).alias("low"), F.max(F.coalesce("component", "cls")).alias("high"),
    ).where("low <> high")
    one = grouped.select("members", F.explode("members").alias("x"))
    two = one.select("x", F.explode(F.filter("members", lambda m: m.comp != F.col("x.comp"))).alias("y")).where("x.cls < y.cls")
    shared = two.groupBy(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    return sized(shared, classes, plan).select("a", "b")


def bloom(ids: DataFrame, bits: int) -> np.ndarray:
    """A filter of ``bits`` bits, one hash function; ``bits / 32`` words of it come to the driver at most."""
    slots = ids.select(F.pmod(F.xxhash64("id"), F.lit(bits)).alias("slot"))
    words = slots.groupBy(F.floor(F.col("slot") / 32).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot % 32 AS INT))")).alias("held")
    ).toPandas()
    table = np.zeros(bits // 32, dtype=np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["held"].to_numpy(np.int64).astype(np.uint32)
    return table


def shingle_sets(texts: DataFrame, wanted: DataFrame, classes: DataFrame, plan: JoinPlan) -> DataFrame:
    """``cls, tokens`` of the classes that ``wanted`` lists, and perhaps of others.

    Each is made from its text with the smallest id again; a filter of fixed size,
    sent to all tasks, passes over the other texts.
    """
    held = texts.sparkSession.sparkContext.broadcast(bloom(classes.join(wanted, "cls", "left_semi"), plan.bloom_bits))
    hashed = texts.select(F.pmod(F.xxhash64("id"), F.lit(plan.bloom_bits)).alias("slot"), "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known, seen = held.value, WordHashes(), set()
        for batch in byte_slices(batches, "text"):
            slot = batch.column("slot").to_numpy(zero_copy_only=False)
            wanted = np.flatnonzero(table[slot // 32] >> (slot % 32).astype(np.uint32) & 1)
            if not len(wanted):
                continue
            flat, counts = shingles(batch.column("text").take(pa.array(wanted)).to_pylist(), plan.width, known)
            ends = np.cumsum(counts)
            keep, classes = [], []
            for i, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist(), strict=True)):
                cls = signature(flat[a:b]) if b > a else -1
                if cls >= 0 and cls not in seen:
                    if len(seen) < 200_000:
                        seen.add(cls)
                    keep.append(i)
                    classes.append(cls)
            keep = np.array(keep, dtype=np.int64)
            tokens = flat[ragged((ends - counts)[keep], counts[keep])].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), list_array(tokens, counts[keep], pa.int64())], ["cls", "tokens"])

    return materialize(hashed.mapInArrow(in_turn("jaccard", read), "cls bigint, tokens array<bigint>"), "shingle_sets")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", plan: JoinPlan = JoinPlan()) -> DataFrame:
    """One row for each row of ``df``: ``id, n_shingles, cls, component_id``.

    Two texts link when ``100 * intersection >= percent * union`` of their shingle sets;
    ``component_id`` is the smallest key that links lead to, the row's own included.  Texts
    with one set of shingles share ``cls``.  A null text or one without words has no shingles,
    ``cls`` -1, and links with nothing.  Rows that repeat a key each come back; a null key
    stays null, and takes part in links, but is no component's smallest unless there is
    no other.  An empty table gives no rows.  Shingles are 64-bit and sets 63-bit hashes.
    """
    spark = df.sparkSession
    ship(spark)
    context = spark.sparkContext
    texts = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    parts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = context.broadcast(frequencies(texts, plan, parts))
    scanned = scan(texts, plan, parts, known)
    rows = scanned.where("kind = 0").select("id", "cls", "n", "ell", "p", "h", "end_df", "end_hash")
    classes = materialize(
        rows.where("cls >= 0").groupBy("cls").agg(F.min("id").alias("id"), *[F.min(c).alias(c) for c in ("n", "ell", "p", "h", "end_df", "end_hash")]), "classes"
    )
    listed = postings(scanned, plan)
    lists = listed.where("owners IS NOT NULL").select("token", "owners")
    hot = scanned.where("kind = 2").select("token", "cls", F.lit(False).alias("long"))
    entries = materialize(hot.unionByName(listed.where("owners IS NULL").select("token", "cls", F.lit(True).alias("long"))).distinct(), "hot_postings")
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("cls"))
    stars = star_pairs(lists, entries, classes, plan)
    sets = shingle_sets(texts, ends(stars).distinct(), classes, plan)
    first = materialize(verified(stars, sets, plan), "links")
    labels = materialize(components(first), "groups").select(F.col("node").alias("cls"), "component")

    rest = materialize(rest_pairs(lists, labels, classes, plan), "rest_pairs")
    apart = materialize(bundles(entries, labels, classes, plan), "bundles")
    sets = shingle_sets(texts, ends(rest).unionByName(apart.select("cls")).distinct(), classes, plan)
    second = materialize(verified(rest, sets, plan).unionByName(hot_links(apart, sets, plan)), "links")
    joined = components(first.unionByName(second)).withColumnRenamed("node", "cls")

    grouped = classes.join(joined, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    named = grouped.join(smallest, "component").select("cls", "component_id")
    return rows.join(named, "cls", "left").select(
        "id", F.col("n").alias("n_shingles"), "cls", F.coalesce("component_id", "id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", plan: JoinPlan = JoinPlan()) -> DataFrame:
    """The rows of ``docs`` with the smallest key of their group, with their columns as they were.

    ``key`` tells rows apart; rows without a key stay where their group has none.
    """
    found = near_duplicates(docs, key, text, plan)
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("__kept")).distinct()
    return docs.join(kept, F.col(key).cast("bigint").eqNullSafe(F.col("__kept")), "left_semi")
