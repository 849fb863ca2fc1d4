"""Texts of an Arrow batch as flat arrays, so that tasks work on millions of words at once."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text bytes handled at once in a task; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Words are runs of anything but these bytes: space and the controls from tab to carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Of the C library, where it has such a call.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def give_back() -> None:
    """What a worker does not use goes back: many short tasks leave idle workers beside those that run."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each piece stay near ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < batch.num_rows:
            base = ends[start] - lengths[start]
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    batch = lengths = ends = None
    give_back()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins and ends; null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, and the number of words of each text."""
    data, offsets = utf8(texts)
    solid = ~SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    before = np.concatenate(([0], np.cumsum(solid)))
    edges = np.concatenate((before[starts], before[-1:])).astype(np.int64)
    letters = np.ascontiguousarray(data[solid])
    flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(letters))
    return flat, counts


def crc_mod(key: str | Column, divisor: int) -> Column:
    """crc32 of the key written as text, modulo ``divisor``; a null key is text ``null``."""
    col = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(col.cast("string"), F.lit("null")).cast("binary")) % divisor

