"""Alignment of two tokenizers' tokens on the bytes they share, in Arrow arrays and tables.

A slice of texts is encoded by both tokenizers into list columns.  Flattened, with parent
indices, the byte lengths of the tokens add up to their ends; texts lie one behind
the other, so an end stands for a place in one document.  A hash join of both sides
on the ends finds where tokens of both end, which cuts a document into groups.  Between
two neighbouring ends of any side lies one link: the two tokens that cover those bytes.

How many documents link a pair of ids is counted in each chunk of texts by ``group_by``; Spark adds
the chunks up and finds each id's most frequent partner.  The totals come back to the
chunks that asked, one row for each different pair of a chunk, so that no task
holds the table of all pairs.  Every row belongs to one text or one pair: a task reads the answers
to one chunk, then its texts, and never holds several chunks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.llm.batches import byte_slices, held, in_turn, list_array, ragged, texts
from rosterflow.llm.packing import ByteTokenizer, SpacedParts, cut
from rosterflow.llm.pieces import PieceModel
from rosterflow.session import materialize

SLICE_BYTES = 1 << 19
CHUNK_BYTES = 8 << 20
WINDOW = 1 << 19
#: Words that each side remembers: two workers stand beside an executor whose heap fills as the input grows.
CACHED = 200_000
#: Bits that hold a pair of ids in a key of (document, pair).
PAIR_BITS = 34


class RecentParts(SpacedParts):
    """Packed ids of parts behind a space; of those seen before the newer half, only what is met again stays."""

    def __init__(self, encode: Callable[[str], bytes], most: int):
        super().__init__(encode, most)
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        packed = self.older.get(part)
        if packed is None:
            packed = self.encode(" " + part)
        if len(part) <= 64:
            if len(self) >= self.most // 2:
                self.older = dict(self)
                self.clear()
            self[part] = packed
        return packed


class PlainByteTokenizer(ByteTokenizer):
    """Ids of a space and a text, in which the names of special tokens are ordinary text."""

    def __init__(self, path: str, ranks: str):
        super().__init__(path, ranks)
        self.spaced = RecentParts(self.part, CACHED)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        with open(ranks, "rb") as rows:
            table = {int(b): base64.b64decode(a) for a, b in map(bytes.split, rows)}
        self.size = max(table) + 1
        self.written = Written([table.get(i, b"") for i in range(self.size)])

    def encode_spaced(self, text: str) -> bytes:
        if text[0].isspace():
            return self.encode(" " + text).astype("<u4").tobytes()
        return b"".join(map(self.spaced.__getitem__, cut(text)))


class CachedPieces:
    """Pieces of texts, with words kept that were seen before; of those before the newer half, only what is met again stays."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.size = self.model.size
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        m = self.model
        self.written = Written([m.out[s : s + n].tobytes() for s, n in zip(m.out_start.tolist(), m.out_length.tolist(), strict=True)])

    def encode(self, values: list[str]) -> list[bytes]:
        words = [self.model.split(v) for v in values]
        fresh = {w for ws in words for w in ws if w not in self.seen}
        if fresh and len(self.seen) + len(fresh) > CACHED // 2:
            self.older, self.seen = self.seen, {}
            fresh = {w for ws in words for w in ws}
        known = {w: self.older[w] for w in fresh if w in self.older}
        new = [w for w in fresh if w not in known]
        self.seen.update(known)
        if new:
            ids, sizes = self.model.encode_words(new)
            data, ends = ids.astype("<u4").tobytes(), np.cumsum(sizes * 4).tolist()
            self.seen.update(zip(new, (data[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        packed = [b"".join(map(self.seen.__getitem__, ws)) for ws in words]
        if len(self.seen) > CACHED // 2:  # words of one slice alone
            self.seen = {}
        if any(len(w) > 64 for w in new):
            self.seen = {w: p for w, p in self.seen.items() if len(w) <= 64}
        return packed


class Written:
    """The bytes that each id stands for, in one flat array."""

    def __init__(self, rows: list[bytes]):
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(rows), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return self.flat[ragged(self.starts[ids], self.lengths[ids])].tobytes()


def both_tokenizers(path: str, ranks: str, pieces: str) -> Callable[[], tuple[PlainByteTokenizer, CachedPieces]]:
    """A function that gives both, loaded once in each Python worker."""
    return lambda: held("align", (path, ranks, pieces), lambda: (PlainByteTokenizer(path, ranks), CachedPieces(pieces)))


# ------------------------------------------------------------------ one slice


def lists(packed: list[bytes]) -> pa.ListArray:
    flat = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
    return list_array(flat, np.array([len(p) // 4 for p in packed], dtype=np.int64), pa.int32())


def sums_by(parents: pa.Array, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums of ``values`` over each parent, by the differences of running sums; parents rise."""
    ends = np.searchsorted(parents.to_numpy(), np.arange(rows), side="right")
    running = np.r_[0, pc.cumulative_sum(pa.array(values, pa.int64())).to_numpy()]
    return np.diff(running[np.r_[0, ends]])


def faithful(values: list[str], a: list[bytes], b: list[bytes], first: Written, second: Written) -> np.ndarray:
    """Whether both sides' tokens write a space and the text, for texts that aren't empty."""
    raw = [b" " + v.encode("utf-8", "surrogatepass") for v in values]
    whole = b"".join(raw)
    good = np.ones(len(values), dtype=bool)
    for packed, written in ((a, first), (b, second)):
        ids = np.frombuffer(b"".join(packed), dtype="<u4")
        lengths = np.array([len(r) for r in raw], dtype=np.int64)
        counts = np.array([len(p) // 4 for p in packed], dtype=np.int64)
        stop = np.r_[0, np.cumsum(written.lengths[ids])]
        ends = np.cumsum(counts)
        if (stop[ends] - stop[ends - counts] == lengths).all() and written.bytes_of(ids) == whole:
            continue
        good &= [written.bytes_of(np.frombuffer(p, dtype="<u4")) == r for p, r in zip(packed, raw, strict=True)]
    return good


def token_ends(ids: pa.ListArray, written: Written) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Flat ids, the row of each, and the byte behind each, texts one behind the other."""
    flat, parents = pc.list_flatten(ids), pc.list_parent_indices(ids)
    flat = flat.to_numpy()
    return flat, parents, pc.cumulative_sum(pa.array(written.lengths[flat])).to_numpy()


def common_ends(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both of the ends they share, by a hash join on the ends."""
    left = pa.table({"end": pa.array(first), "a": pa.array(np.arange(len(first), dtype=np.int32))})
    right = pa.table({"end": pa.array(second), "b": pa.array(np.arange(len(second), dtype=np.int32))})
    joined = left.join(right, "end", join_type="inner", use_threads=False)
    a, b = joined.column("a").to_numpy(), joined.column("b").to_numpy()
    order = np.argsort(a)
    return a[order], b[order]


def overlaps(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in both of the tokens of each link, in order of bytes."""
    size = int(first[-1]) + 1 if len(first) else 0
    in_first, in_second = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    in_first[first], in_second[second] = True, True
    ends = np.flatnonzero(in_first | in_second)
    before = lambda marks: (np.cumsum(marks, dtype=np.int32) - marks)[ends]
    return before(in_first), before(in_second)


def group_digests(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, row: np.ndarray, rows: int, names: pa.Array) -> list[str]:
    """SHA-256 of each row's groups, written ``a1,a2|b1;a3|b2``; the empty text for a row without any.

    A window of groups is written at a time, so that long texts don't make long strings.
    """
    digests: list = [None] * rows
    for at in range(0, len(last_a), WINDOW):
        here = slice(at, at + WINDOW)

        def sides(ids: np.ndarray, last: np.ndarray, here: slice = here, at: int = at) -> pa.Array:
            begin = int(last[at - 1]) + 1 if at else 0
            ends = last[here].astype(np.int64) + 1 - begin
            strings = names.take(pa.array(ids[begin : begin + int(ends[-1])]))
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), strings), ",")

        groups = pc.binary_join_element_wise(sides(a, last_a), sides(b, last_b), "|")
        of = row[here]
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[starts, len(of)], pa.int32()), groups), ";")
        for r, text in zip(of[starts].tolist(), joined, strict=True):
            if digests[r] is None:
                digests[r] = hashlib.sha256()
            else:
                digests[r].update(b";")
            digests[r].update(text.as_buffer())
    return ["" if d is None else d.hexdigest() for d in digests]


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Chunk:
    """What a chunk of texts leaves: one row for each text, with its pairs of ids by their place among the chunk's."""

    def __init__(self, number: int, first: PlainByteTokenizer, second: CachedPieces, names: pa.Array):
        self.number, self.first, self.second, self.names = number, first, second, names
        self.rows: dict[str, list] = {c: [] for c in ("key", *COUNTS, "groups_sha256", "sizes")}
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.bytes = 0

    def add(self, part: pa.RecordBatch) -> None:
        values = texts(part, "text")
        self.bytes += part.column("text").nbytes
        a, b = [self.first.encode_spaced(v) if v else b"" for v in values], self.second.encode(values)
        good = np.array([bool(v) for v in values], dtype=bool)
        some = np.flatnonzero(good)
        pick = lambda side: [side[i] for i in some.tolist()]
        good[some] = faithful(pick(values), pick(a), pick(b), self.first.written, self.second.written)
        if not good.all():
            a, b = ([x if g else b"" for x, g in zip(side, good.tolist(), strict=True)] for side in (a, b))
        ids_a, ids_b = lists(a), lists(b)
        flat_a, row_a, ends_a = token_ends(ids_a, self.first.written)
        flat_b, row_b, ends_b = token_ends(ids_b, self.second.written)
        last_a, last_b = common_ends(ends_a, ends_b)
        at_a, at_b = overlaps(ends_a, ends_b)
        row_a = row_a.to_numpy()
        pair = flat_a[at_a].astype(np.int64) * self.second.size + flat_b[at_b]
        row = row_a[at_a]
        held = pa.table({"key": row.astype(np.int64) << PAIR_BITS | pair}).group_by("key", use_threads=False).aggregate([("key", "count")])
        keys, times = held.column("key").to_numpy(), held.column("key_count").to_numpy()
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        n = part.num_rows
        count = lambda of: np.bincount(of, minlength=n).tolist()
        self.rows["key"] += part.column("key").to_pylist()
        self.rows["n_a"] += ids_a.value_lengths().to_pylist()
        self.rows["n_b"] += ids_b.value_lengths().to_pylist()
        self.rows["n_groups"] += count(row_a[last_a])
        self.rows["n_links"] += count(row)
        self.rows["groups_sha256"] += group_digests(flat_a, flat_b, last_a, last_b, row_a[last_a], n, self.names)
        self.rows["sizes"] += count(keys >> PAIR_BITS)
        self.codes.append(keys & ((1 << PAIR_BITS) - 1))
        self.times.append(times.astype(np.int32))

    def finish(self, key: pa.DataType) -> pa.RecordBatch:
        """One row for each text, over which the chunk's different ``pairs`` are spread.

        ``docs`` is how many of the chunk's texts link a pair, ``base`` the place of a row's first pair.
        """
        codes, times = np.concatenate(self.codes), np.concatenate(self.times)
        counted = pa.table({"pair": codes}).group_by("pair", use_threads=False).aggregate([("pair", "count")]).sort_by("pair")
        pairs = counted.column("pair").to_numpy()
        rows = len(self.rows["key"])
        ends = np.arange(rows + 1) * len(pairs) // rows
        spread, sizes = np.diff(ends), np.array(self.rows["sizes"], dtype=np.int64)
        columns = {
            "chunk": pa.array(np.full(rows, self.number, dtype=np.int64)),
            "base": pa.array(ends[:-1]),
            "pairs": list_array(pairs, spread, pa.int64()),
            "docs": list_array(counted.column("pair_count").to_numpy(), spread, pa.int64()),
            "key": pa.array(self.rows["key"], key),
            **{c: pa.array(self.rows[c], pa.int64()) for c in COUNTS},
            "groups_sha256": pa.array(self.rows["groups_sha256"], pa.string()),
            "places": list_array(np.searchsorted(pairs, codes).astype(np.int32), sizes, pa.int32()),
            "times": list_array(times, sizes, pa.int32()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


# ------------------------------------------------------------------- the frame


def chunks(df: DataFrame, path: str, ranks: str, pieces: str, key: str, text: str, chunk_bytes: int) -> DataFrame:
    """The rows of :meth:`Chunk.finish`, written to the shared folder: texts are encoded once."""
    ship(df.sparkSession)
    picked = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    tokenizers = both_tokenizers(path, ranks, pieces)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tokenizers()
        names = pa.array([str(i) for i in range(max(first.size, second.size))])
        number = TaskContext.get().partitionId() << 32
        chunk = None
        for part in byte_slices(batches, "text", SLICE_BYTES):
            chunk = chunk or Chunk(number, first, second, names)
            chunk.add(part)
            if chunk.bytes >= chunk_bytes:
                yield chunk.finish(part.schema.field("key").type)
                chunk, number = None, number + 1
        if chunk:
            yield chunk.finish(part.schema.field("key").type)

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    schema = f"chunk bigint, base bigint, pairs array<bigint>, docs array<bigint>, key {kind}, {counts}, groups_sha256 string, places array<int>, times array<int>"
    return materialize(picked.mapInArrow(read, schema), "chunks")


def pair_counts(made: DataFrame, width: int) -> DataFrame:
    """``pair, docs, best``: how many documents link a pair, and whether none of its first id is in more.

    The window holds the partners of one id: the vocabulary of the second tokenizer at most.
    """
    zipped = F.explode(F.arrays_zip("pairs", "docs")).alias("x")
    counted = made.select(zipped).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("docs"))
    of_first = Window.partitionBy(F.expr(f"pair div {width}"))
    return counted.withColumn("best", F.col("docs") == F.max("docs").over(of_first))


def align(
    df: DataFrame, path: str, ranks: str, pieces: str, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """One row for each row of ``df``: ``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    The first tokenizer (``path``, the same vocabulary as ``ranks``) encodes a space and the text, the
    second (``pieces``) the text, before which it puts a space itself.  A text that is null or empty, or
    whose bytes either side doesn't give back, has no tokens: zeros, and an empty digest.  Rows that
    repeat count as documents of their own; a null key stays null; an empty table gives no
    rows.  A task holds one chunk of texts (one text at least), and later the counts of one chunk's pairs and
    a batch of its texts' links; a Python worker remembers ``CACHED`` words for each tokenizer, and gives both
    tokenizers back before it adds up counts.
    """
    made = chunks(df, path, ranks, pieces, key, text, chunk_bytes)
    kind = made.schema["key"].dataType.simpleString()
    totals = pair_counts(made, PieceModel(pieces).size)
    asked = made.select("chunk", "base", F.posexplode("pairs").alias("place", "pair"))
    answered = asked.join(totals, "pair").select("chunk", (F.col("base") + F.col("place")).alias("place"), "docs", "best")
    linked = made.select("chunk", F.struct("key", *COUNTS, "groups_sha256", "places", "times").alias("doc"))
    both = answered.unionByName(linked, allowMissingColumns=True)
    joined = both.repartition("chunk").sortWithinPartitions("chunk", F.col("place").asc_nulls_last())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = None, []  # the answers to a chunk come first, by place
        for batch in batches:
            of = batch.column("chunk").to_numpy()
            answers = np.cumsum(np.r_[0, batch.column("place").is_valid().to_numpy(zero_copy_only=False)])
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else of
            for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(of)], strict=True):
                if of[start] != chunk:
                    chunk, held = of[start], []
                n = int(answers[stop] - answers[start])
                if n:
                    held.append([batch.column(c).slice(start, n).to_numpy(zero_copy_only=False) for c in ("docs", "best")])
                if start + n < stop:
                    held = [[np.concatenate(parts) for parts in zip(*held, strict=True)]] if held else []
                    yield summed(batch.column("doc").slice(start + n, stop - start - n), *held)

    def summed(rows: pa.StructArray, held: list[np.ndarray] | None = None) -> pa.RecordBatch:
        flat = dict(zip([f.name for f in rows.type], rows.flatten(), strict=True))
        of = pc.list_parent_indices(flat["places"])
        places, times = pc.list_flatten(flat["places"]).to_numpy(), pc.list_flatten(flat["times"]).to_numpy().astype(np.int64)
        docs, best = [of_pair[places] for of_pair in held] if held else (times, times)
        sums = {"n_best": sums_by(of, times * best, len(rows)), "count_sum": sums_by(of, times * docs, len(rows))}
        arrays = [flat["key"], *[flat[c] for c in COUNTS], *map(pa.array, sums.values()), flat["groups_sha256"]]
        return pa.RecordBatch.from_arrays(arrays, ["key", *COUNTS, *sums, "groups_sha256"])

    numbers = ", ".join(f"{c} bigint" for c in (*COUNTS, "n_best", "count_sum"))
    return joined.mapInArrow(in_turn("align_sums", read), f"key {kind}, {numbers}, groups_sha256 string")
