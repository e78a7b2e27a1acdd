"""Packing into windows of fixed capacity by minimum bin slack.

Each task packs its own rows, without a shuffle.  Whole windows are cut off long
documents at once; what remains of each document goes to a pool.  From the pool,
a window is filled with the multiset of remaining lengths whose sum comes closest to
the capacity, found by subset-sum dynamic programming on bitsets: bit ``s`` says
that a sum ``s`` can be reached.  Walking back through the bitsets gives the counts.
"""

from __future__ import annotations

import base64
import binascii
import re
from collections import defaultdict, deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import ship
from rosterflow.llm.batches import byte_slices, give_back, held, texts

CAPACITY = 1024
POOL = 4096


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as large as the capacity allows.

    ``counts`` maps lengths (1 to ``capacity``) to how many there are.  Long lengths come
    first; the dynamic programme ends as soon as the capacity is reached.
    """
    full = (1 << (capacity + 1)) - 1
    goal = 1 << capacity
    reach = [1]
    parts: list[tuple[int, int]] = []  # (length, how many copies at once)
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], capacity // length), 1
        while left:  # copies in powers of two stand for every count
            step = min(step, left)
            parts.append((length, step))
            reach.append((reach[-1] | reach[-1] << (length * step)) & full)
            left -= step
            step *= 2
        if reach[-1] & goal:
            break
    at = reach[-1].bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    for k in range(len(parts) - 1, -1, -1):
        if not reach[k] >> at & 1:
            length, step = parts[k]
            taken[length] += step
            at -= length * step
    return dict(taken)


class Packer:
    """Packs the ids of documents as they come; gives pieces ``(doc, start, ids, sequence, offset)``.

    ``pool`` bounds how many remainders wait.  When it is full, windows are filled until
    half of it is left, or too little for a whole one; at the end, what is left is cut at powers of two, which need
    no padding.
    """

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, pool: int = POOL):
        self.capacity, self.pool = capacity, pool
        self.sequence = first_sequence
        self.waiting: dict[int, deque] = defaultdict(deque)
        self.size = 0
        self.held = 0  # ids that wait

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield doc, start, ids[start : start + self.capacity], self.sequence, 0
            self.sequence += 1
        if len(ids) > whole:
            self.put(doc, whole, ids[whole:])
            if self.size >= self.pool:
                while self.size > self.pool // 2 and self.held >= self.capacity:
                    yield from self.window()

    def window(self) -> Iterator[tuple]:
        """One window of the pool; if even the closest sum leaves slack, another piece is cut to fill it."""
        counts = {length: len(rows) for length, rows in self.waiting.items()}
        offset = 0
        for length, n in sorted(fill(counts, self.capacity).items(), reverse=True):
            for _ in range(n):
                doc, start, ids = self.take(length)
                yield doc, start, ids, self.sequence, offset
                offset += length
        slack = self.capacity - offset
        if slack and self.size:
            doc, start, ids = self.take(min(x for x in self.waiting if x > slack))
            yield doc, start, ids[:slack], self.sequence, offset
            self.put(doc, start + slack, ids[slack:])
        self.sequence += 1

    def finish(self) -> Iterator[tuple]:
        """Empty the pool: full windows first, then powers of two."""
        while self.held >= self.capacity:
            yield from self.window()
        left = self.held
        room, offset = 0, 0
        for length in sorted(self.waiting, reverse=True):
            while self.waiting.get(length):
                doc, start, ids = self.take(length)
                while len(ids):
                    if not room:
                        room, offset = 1 << (left.bit_length() - 1), 0
                    part = ids[:room]
                    yield doc, start, part, self.sequence, offset
                    offset, room, left = offset + len(part), room - len(part), left - len(part)
                    doc, start, ids = doc, start + len(part), ids[len(part) :]
                    if not room:
                        self.sequence += 1

    def take(self, length: int) -> tuple:
        rows = self.waiting[length]
        row = rows.popleft()
        if not rows:
            del self.waiting[length]
        self.size -= 1
        self.held -= length
        return row

    def put(self, doc, start: int, ids: np.ndarray) -> None:
        self.waiting[len(ids)].append((doc, start, ids))
        self.size += 1
        self.held += len(ids)


_CUT = re.compile(r"(?<=\S) (?=\S)")
_PLAIN = re.compile(r"[\x00-\u024f]*")
_ODD = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_BY_SPACE = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
CACHED = 600_000


def cut(text: str) -> list[str]:
    """The text cut at its spaces between two characters that aren't white space."""
    plain = text[:1] != " " and text[-1:] != " " and not any(x in text for x in _BY_SPACE)
    if plain and (text.isascii() or not _ODD.search(text)):
        return text.split(" ")
    return _CUT.split(text)


class SpacedParts(dict):
    """Packed ids of parts behind a space; all forgotten when there are too many."""

    def __init__(self, encode: Callable[[str], bytes], most: int = CACHED):
        super().__init__()
        self.encode = encode
        self.most = most

    def __missing__(self, part: str) -> bytes:
        packed = self.encode(" " + part)
        if len(part) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[part] = packed
        return packed


class ByteTokenizer:
    """Ids of the ``tokenizers`` file at ``path``, faster for text in Latin letters.

    No token holds a space behind a character that isn't white space, so a text is cut
    at its single spaces and each part looked up among those seen before.  New parts
    whose characters lie below U+0250, where the libraries' Unicode tables agree, are encoded by
    ``tiktoken`` with the same vocabulary as ranks; other parts, and texts with a
    special token's text, by ``tokenizers`` itself.
    """

    def __init__(self, path: str, ranks: str | None = None, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as rows:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rows)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.spaced = SpacedParts(self.part, cached)

    def slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def part(self, part: str) -> bytes:
        ids = self.fast.encode_ordinary(part) if _PLAIN.fullmatch(part) else self.slow(part)
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.slow(text), dtype="<u4")
        first, *rest = cut(text)
        packed = self.part(first) if first else b""
        return np.frombuffer(packed + b"".join(map(self.spaced.__getitem__, rest)), dtype="<u4")


def byte_tokenizer(path: str, ranks: str | None, cached: int = CACHED) -> Callable[[], ByteTokenizer]:
    """A function that gives the tokenizer, loaded once in each Python worker."""
    return lambda: held("packing", (path, ranks, cached), lambda: ByteTokenizer(path, ranks, cached))


PIECE_COLUMNS = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    df: DataFrame, path: str, ranks: str | None = None, key: str = "doc_id", text: str = "text", end_id: int = 0,
    capacity: int = CAPACITY, pool: int = POOL, keep_ids: bool = True, cached: int = CACHED,
    keep_parts: bool = True,
) -> DataFrame:
    """Pieces of every whole text: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and ``ids``.

    A text is its ids by ``path`` without special tokens, then ``end_id``; null is the
    empty text, of one id.  Each id lies in one piece.  Sequences hold ``capacity`` ids,
    but for the last few of a task, whose lengths are powers of two: none needs padding.
    Rows are packed one by one, so repeated rows are packed again; an empty frame gives no
    pieces.  Sequence ids are unique in the result, with gaps between tasks.  A task
    that runs again packs the same rows by itself.  Memory: ``pool`` remainders of fewer
    than ``capacity`` ids, a slice of texts, and the ids of ``cached`` parts of texts, which
    a Python worker keeps after the task unless ``keep_parts=False``.  ``keep_ids=False`` leaves ``ids`` out.
    """
    ship(df.sparkSession)
    picked = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    tokenizer = byte_tokenizer(path, ranks, cached)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer().encode
        packer = Packer(TaskContext.get().partitionId() << 36, capacity, pool)

        def rows(part: pa.RecordBatch) -> Iterator[tuple]:
            for doc, value in zip(part.column("key").to_pylist(), texts(part, "text"), strict=True):
                ids = np.append(encode(value), np.array([end_id], dtype="<u4"))
                yield from packer.add((doc, len(ids)), ids)

        for part in byte_slices(batches, "text"):
            yield batch(list(rows(part)), part.schema.field("key").type)
            schema = part.schema
        if packer.size:
            yield batch(list(packer.finish()), schema.field("key").type)
        if not keep_parts:
            tokenizer().spaced.clear()
            give_back()

    def batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
        columns = [
            pa.array([r[0][0] for r in rows], key_type),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([len(r[2]) for r in rows], pa.int64()),
            pa.array([binascii.crc32(r[2].tobytes()) for r in rows], pa.int64()),
            pa.array([r[0][1] for r in rows], pa.int64()),
            pa.array([r[3] for r in rows], pa.int64()),
            pa.array([r[4] for r in rows], pa.int64()),
        ]
        names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        if keep_ids:
            columns.append(pa.array([r[2].astype(np.int64) for r in rows], pa.list_(pa.int64())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    return picked.mapInArrow(pieces, f"key {kind}, {PIECE_COLUMNS}" + (", ids array<bigint>" if keep_ids else ""))
