"""Near copies by SimHash: segment popcounts, a grid over them, and an exact check.

A fingerprint has 64 bits.  Cut into segments, it becomes a point: the number of one
bits in each segment.  The Manhattan distance of two points is at most the number of bits
in which the fingerprints differ, so fingerprints that link lie close together on the
grid of points.  Two fingerprints that differ in two bits differ, in the points of their
lower halves, by one at most, or else not at all in those of their upper halves.
So each fingerprint is stored in two cells, those of its halves, and looks into its
own cells and those one step above its lower one.  What shares a cell is compared bit by bit.

A cell with very many fingerprints is left to the finest grid, with segments of one bit:
its points are the fingerprints themselves, and two of them differ in two bits or less
exactly if one point lies within one step of both.  At most 65 fingerprints lie
within one step of a point, so neither way pairs up a large group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.llm.batches import byte_slices
from rosterflow.llm.components import components
from rosterflow.session import materialize

SEED = 42
BITS = 64
HALF = 32
DISTANCE = 2


@dataclass(frozen=True)
class GridPlan:
    """``segment``: bits of a segment (1, 2 or 4).  ``hot_from``: the rows of a cell from which the
    finest grid takes over.  Neither changes the result."""

    segment: int = 2
    hot_from: int = 128

    def __post_init__(self):
        if self.segment not in (1, 2, 4):
            raise ValueError("segments have 1, 2 or 4 bits")


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """XXH64 of each run of ``width`` words, repeats included; of all words if there are fewer; none without words.

    Words are runs of bytes other than space and \\x09-\\x0D, with A-Z in lower case.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[width:], strict=False)]


def majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of ``counts[i]`` hashes: a bit is one where it is in over half of them; 0 for an empty run."""
    found = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return found
    starts = (np.cumsum(counts) - counts)[some]
    votes = np.empty((len(some), BITS), dtype=np.int64)
    planes = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # a sum for each run is several times faster than one reduceat over all of them
    single = counts[some] == 1
    votes[single] = planes[starts[single]]
    for i in np.flatnonzero(~single).tolist():
        a = starts[i]
        votes[i] = planes[a : a + counts[some[i]]].sum(axis=0, dtype=np.int32)
    ones = votes * 2 > counts[some][:, None]
    found[some] = np.packbits(ones, axis=1, bitorder="little").view("<u8").reshape(-1)
    return found


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``key, fingerprint, n_shingles`` of every whole text; the fingerprint is the bigint with those 64 bits.

    Null counts as empty.  A text without words has fingerprint 0.  Rows are handled one by
    one: repeated rows come back, an empty frame gives no rows.
    """
    ship(df.sparkSession)
    picked = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text", 1 << 20):
            runs = [shingle_hashes(t, width) for t in part.column("text").to_pylist()]
            counts = np.array([len(r) for r in runs], dtype=np.int64)
            hashes = np.fromiter((h for r in runs for h in r), dtype=np.uint64, count=int(counts.sum()))
            columns = [part.column("key"), pa.array(majorities(hashes, counts).view(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "fingerprint", "n_shingles"])

    return picked.mapInArrow(read, f"key {kind}, fingerprint bigint, n_shingles bigint")


# ------------------------------------------------------------------------ grid


def _repeated(pattern: int, width: int) -> int:
    """``pattern`` in each field of ``width`` bits of a signed 64-bit number."""
    value = sum(pattern << at for at in range(0, BITS, width))
    return value - (1 << BITS) if value >> (BITS - 1) else value


def popcounts(fp: Column, segment: int) -> Column:
    """The point of a fingerprint: the count of one bits of each segment, in a field of ``segment`` bits."""
    if segment == 1:
        return fp
    odd = F.lit(_repeated(0b01, 2))
    first, second = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    pairs = first.bitwiseXOR(second).bitwiseOR(F.shiftleft(first.bitwiseAND(second), 1))
    if segment == 2:
        return pairs
    low = F.lit(_repeated(0b0011, 4))
    return pairs.bitwiseAND(low) + F.shiftrightunsigned(pairs, 2).bitwiseAND(low)


def grid_rows(distinct: DataFrame, plan: GridPlan) -> DataFrame:
    """``cell, fp, home``: the two cells each fingerprint lives in, and those one step above the lower one.

    Of two fingerprints one step apart the lower looks into the cell of the higher, so
    one direction is enough.
    """
    point = popcounts(F.col("fp"), plan.segment)
    lower = point.bitwiseAND(F.lit((1 << HALF) - 1))
    upper = F.shiftrightunsigned(point, HALF)
    # the cells of lower halves have even numbers, those of upper halves odd ones
    cell = lambda value, odd: F.shiftleft(value, 1) + F.lit(odd).cast("bigint")
    look = lambda value, odd, home: F.struct(cell(value, odd).alias("cell"), F.lit(home).alias("home"))
    mask = (1 << plan.segment) - 1
    steps = [
        F.when(F.shiftrightunsigned(lower, at).bitwiseAND(F.lit(mask)) < plan.segment, look(lower + F.lit(1 << at), 0, False))
        for at in range(0, HALF, plan.segment)
    ]
    looks = F.array(look(lower, 0, True), look(upper, 1, True), *steps)
    return distinct.select("fp", F.explode(looks).alias("x")).where("x IS NOT NULL").select("x.cell", "fp", "x.home")


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(distinct: DataFrame, plan: GridPlan = GridPlan()) -> DataFrame:
    """``a, b``: links between the different fingerprints ``fp``, by which the groups hang together.

    Within cells of ordinary size all pairs of differing bits up to two are there;
    elsewhere each fingerprint is linked with the smallest one near a point they share.
    """
    rows = grid_rows(distinct, plan)
    hot = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > plan.hot_from).select("cell")
    hot = materialize(hot, "hot_cells")
    crowded = not hot.isEmpty()
    calm = rows.join(hot, "cell", "left_anti") if crowded else rows
    stored = calm.where("home").select("cell", F.col("fp").alias("a"))
    looking = calm.select("cell", F.col("fp").alias("b"), "home")
    near = (F.col("b") < F.col("a")) | ~F.col("home")
    pairs = stored.join(looking, "cell").where((differing("a", "b") <= DISTANCE) & near).select("a", "b")
    if not crowded:
        return materialize(pairs, "links")
    touched = rows.join(hot, "cell", "left_semi").select("fp").distinct()
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_repeated(1 << at, BITS))) for at in range(BITS)])
    shared = (
        touched.select("fp", F.explode(around).alias("point"))
        .groupBy("point").agg(F.collect_list("fp").alias("fps"))  # 65 at most lie within one step of a point
        .where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    )
    return materialize(pairs.unionByName(shared).distinct(), "links")


def near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, plan: GridPlan = GridPlan()) -> DataFrame:
    """One row for each row of ``df``: ``key, fingerprint, n_shingles, component_id``.

    Fingerprints link at two or fewer differing bits; ``component_id`` is the smallest key
    that links lead to, the row's own included.  Texts without words (null, empty, white
    space) share fingerprint 0, which links like any other.  Rows that repeat a key each come
    back; a null key stays null, and is no component's smallest unless there is no other.
    An empty table gives no rows.  Equal fingerprints are one row in all joins but the last, which
    adaptive execution splits where very many texts share one.
    """
    texts = materialize(fingerprints(df, key, text, width), "fingerprints")
    distinct = materialize(texts.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("key").alias("smallest")), "distinct")
    joined = components(links(distinct.select("fp"), plan)).withColumnRenamed("node", "fp")
    members = materialize(joined.join(distinct, "fp"), "members")
    lowest = members.groupBy("component").agg(F.min("smallest").alias("lowest"))
    grouped = members.join(lowest, "component").select("fp", "lowest")
    named = distinct.join(grouped, "fp", "left").select("fp", F.coalesce("lowest", "smallest").alias("component_id"))
    return texts.join(named, F.col("fingerprint") == F.col("fp")).select("key", "fingerprint", "n_shingles", "component_id")


def hex_digits(fingerprint: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
