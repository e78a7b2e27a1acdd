"""Helpers for Arrow batches: bounded slices, ragged gathers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def byte_slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose values in ``column`` hold ``limit`` bytes at most, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The values of a text column, with null as the empty text."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of the ranges ``starts[i] .. starts[i] + lengths[i]``, one range after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total, dtype=np.int64)


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from its flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


_HELD: dict[tuple, Any] = {}
_OWNER: list[str] = []


def give_back() -> None:
    """Return memory that this Python worker no longer uses to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone keeps freed memory unless asked
    if trim is not None:
        trim(0)


def turn_of(owner: str) -> None:
    """From now on this Python worker works for ``owner``: what other operators hold in it is given back.

    Workers outlive stages, so the tokenizers and caches of one stage would fill memory in the next.
    """
    if _OWNER != [owner]:
        _OWNER[:] = [owner]
        _HELD.clear()
        give_back()


def in_turn(owner: str, read: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``read`` as a function for ``mapInArrow`` that starts and ends with no more memory than it needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_of(owner)
        yield from read(batches)
        give_back()

    return run


def held(owner: str, key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in each Python worker for as long as it works for ``owner``."""
    turn_of(owner)
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]
