"""Whole Arrow text columns as flat numpy arrays: words, word hashes, hashes of word runs.

A slice of a column is one byte buffer plus row offsets; nothing here loops over words in Python.
Hashes are polynomial prefix sums modulo 2**64, finished by a mixing step, so that the hash of any
run of bytes or words costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 21
#: For steps that hold many arrays of a number a byte; their tables of powers just fit 2**19 entries.
SMALL_SLICE = (1 << 19) - 2
# Odd multipliers of the polynomial hashes and of the mixing step.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

_bytes = np.arange(256)
#: Bytes that part words: space and the five control characters 0x09-0x0D.
BLANK = (_bytes == 0x20) | ((_bytes >= 0x09) & (_bytes <= 0x0D))
#: Bytes that part words of letters, digits and everything beyond ASCII.
NOT_ALNUM = (_bytes < 0x30) | ((_bytes > 0x39) & (_bytes < 0x61)) | ((_bytes > 0x7A) & (_bytes < 0x80))
LOWER = np.where((_bytes >= 0x41) & (_bytes <= 0x5A), _bytes + 32, _bytes).astype(np.uint8)


def whole_texts(documents: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and the text, a null text as an empty one."""
    return documents.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets from 0)`` of runs of rows of about ``max_bytes``.

    A row is never split, so one very long text makes one large slice.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        end = min(n, max(first + 1, end))
        yield first, end, flat[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each row's first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~parts[data]
    cut = np.zeros(len(data) + 1, bool)  # a row begins here
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(10, (n - 1).bit_length())
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (self.base, self.inverse))
        return self.up, self.down


POWERS = tuple(_Powers(b) for b in BASES)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair; equal runs have equal hashes wherever they stand."""
    n = len(values)
    up, down = POWERS[which](n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return run_hashes(data, starts, ends, which)


def windows(first: np.ndarray, size: int) -> np.ndarray:
    """Index of the first word of each window of ``size`` words that stays within its row."""
    n = int(first[-1])
    ok = np.ones(n, bool)
    for end in np.unique(first[1:]):
        ok[max(0, end - size + 1) : end] = False
    # a row shorter than the window also blocks words of the row before it; those are blocked already
    return np.flatnonzero(ok)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_columns(df: DataFrame, new: StructType, fn: Callable[[pa.Array], list[pa.Array]], text: str = "text") -> DataFrame:
    """``df`` with the columns ``fn`` makes from each batch's texts (nulls as empty texts).

    Input columns that have a new column's name are replaced.
    """
    clash = {f.name.lower() for f in new}
    kept = df.select(*[c for c in df.columns if c.lower() not in clash])
    schema = StructType([*kept.schema.fields, *new.fields])
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).fill_null("")
            for first, end, _, _ in text_slices(texts):  # what is made at once stays small
                part = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*part.columns, *fn(texts.slice(first, end - first))], names=schema.names)

    return kept.mapInArrow(run, schema)
