"""Benchmark decontamination by greedy string tiling.

Runs of ``MIN_TILE`` words that a document shares with a benchmark item are seeds. For each document
and item with a seed, the longest matches of words that no tile holds yet are marked again and again,
found by running Karp-Rabin hashes of shrinking length. The share of the item's words under tiles
decides, so passages in another order are caught too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from courierflow.llm.text import LOWER, NOT_ALNUM, free_name, run_hashes, text_slices, whole_texts, windows, with_columns, word_hashes, word_spans

MIN_TILE, FIRST_LENGTH, COVERAGE = 5, 20, 0.5
#: Bytes of benchmark text that one pass over the documents holds; more take more passes.
BLOCK_BYTES = 16 << 20
FOUND = "doc_id bigint, item_id bigint, n_tiles int, covered int, item_words int, coverage double"


def matches(doc: np.ndarray, item: np.ndarray, free_doc: np.ndarray, free_item: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Maximal matches of free words of at least ``length``: (length, place in doc, place in item)."""

    def hashed(words: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.arange(max(0, len(words) - length + 1))
        taken = np.r_[0, np.cumsum(~free)]
        at = at[taken[at + length] == taken[at]]
        return at, run_hashes(words, at, at + length)

    (at_doc, in_doc), (at_item, in_item) = hashed(doc, free_doc), hashed(item, free_item)
    if not len(at_doc) or not len(at_item):
        return []
    order = np.argsort(in_item, kind="stable")
    low, high = np.searchsorted(in_item[order], in_doc, "left"), np.searchsorted(in_item[order], in_doc, "right")
    times = high - low
    if not times.sum():
        return []
    i = np.repeat(at_doc, times)
    j = at_item[order][np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())]
    # neighbours on a diagonal are one longer match
    by = np.lexsort((i, i - j))
    i, j = i[by], j[by]
    begins = np.r_[True, (np.diff(i) != 1) | (np.diff(i - j) != 0)]
    first = np.flatnonzero(begins)
    size = np.diff(np.r_[first, len(i)]) + length - 1
    return list(zip(size.tolist(), i[first].tolist(), j[first].tolist()))


def tiles(doc: np.ndarray, item: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles as (length, place in doc, place in item), longest matches marked first."""
    free_doc, free_item, out = np.ones(len(doc), bool), np.ones(len(item), bool), []
    length = max(least, min(FIRST_LENGTH, len(item)))
    while True:
        found = matches(doc, item, free_doc, free_item, length)
        longest = max((m[0] for m in found), default=0)
        if longest > 2 * length:
            length = longest
            continue
        for size, i, j in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if free_doc[i : i + size].all() and free_item[j : j + size].all():
                free_doc[i : i + size] = free_item[j : j + size] = False
                out.append((size, i, j))
        if found:  # what a longer tile cut short may still be long enough
            continue
        if length == least:
            return out
        length = max(least, length // 2)


class Items:
    """Words of some benchmark items and the seeds among them."""

    def __init__(self, rows: list[tuple[int, str]], least: int):
        raw = [t.encode() for _, t in rows]
        data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
        starts, ends, first = word_spans(data, np.cumsum([0, *map(len, raw)]), NOT_ALNUM)
        hashes = word_hashes(data, starts, ends)
        self.ids, self.words = [r[0] for r in rows], [hashes[a:b] for a, b in zip(first, first[1:])]
        at = windows(first, least)
        seeds, item = run_hashes(hashes, at, at + least), np.searchsorted(first, at, "right") - 1
        pairs = np.unique(np.stack([seeds, item.astype(np.uint64)]), axis=1)
        self.seeds, self.item = pairs[0], pairs[1].astype(np.int64)


def meetings(texts: pa.Array, items: Items, least: int, coverage: float) -> Iterator[tuple[int, int, int, int]]:
    """``(row, item, tiles, covered words)`` of each text and item that meet the coverage."""
    for a, _, data, offsets in text_slices(texts):
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets, NOT_ALNUM)
        hashes = word_hashes(data, starts, ends)
        at = windows(first, least)
        seeds = run_hashes(hashes, at, at + least)
        low = np.searchsorted(items.seeds, seeds, "left")
        hit = np.flatnonzero(np.r_[items.seeds, np.uint64(0)][low] == seeds)
        low, high = low[hit], np.searchsorted(items.seeds, seeds[hit], "right")
        times = np.maximum(high - low, 0)
        place = np.repeat(at[hit], times)
        item = items.item[np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())]
        row = np.searchsorted(first, place, "right") - 1
        order = np.lexsort((place, item, row))
        row, item, place = row[order], item[order], place[order]
        cuts = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(item) != 0)]) if len(row) else []
        for x, y in zip(cuts, [*cuts[1:], len(row)]):
            words = items.words[item[x]]
            # only words under seeds can lie under tiles; a gap keeps the runs apart
            near = np.unique(place[x:y, None] + np.arange(least))
            found = tiles(np.insert(hashes[near], np.flatnonzero(np.diff(near) > 1) + 1, np.uint64(0)), words, least)
            covered = sum(t[0] for t in found)
            if covered >= coverage * len(words):
                yield a + int(row[x]), int(item[x]), len(found), covered


def search(documents: DataFrame, items: Items, least: int, coverage: float) -> DataFrame:
    """One pass over the documents for the items of one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            out = [(keys[r], items.ids[k], n, covered, len(items.words[k]), covered / len(items.words[k])) for r, k, n, covered in meetings(batch.column(1), items, least, coverage)]
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "n_tiles", "covered", "item_words", "coverage"])

    return documents.mapInArrow(run, FOUND)


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one block on the driver at a time."""
    held, size = [], 0
    for row in whole_texts(benchmark, "item_id").orderBy("item_id").toLocalIterator():
        if held and size + len(row.text) > most:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += len(row.text)
    if held:
        yield held


def contaminated(documents: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: float = COVERAGE) -> DataFrame:
    """A row for each document and benchmark item whose words lie under tiles to ``coverage`` or more.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. Items with less
    than ``least`` words, null and empty texts meet nothing; repeated rows of a document are each
    reported; null ids are reported as null. Empty tables give no rows.
    """
    docs = whole_texts(documents, F.col("doc_id").cast("long").alias("doc_id"))
    found = [search(docs, Items(rows, least), least, coverage) for rows in blocks(benchmark)]
    if not found:
        return docs.sparkSession.createDataFrame([], FOUND)
    return reduce(DataFrame.unionByName, found)


def clean(documents: DataFrame, benchmark: DataFrame, least: int = MIN_TILE, coverage: float = COVERAGE) -> DataFrame:
    """``documents`` without the rows that ``contaminated`` reports, in their own order of columns."""
    flag, columns = free_name(documents, "_leaks"), documents.columns
    for rows in blocks(benchmark):
        items = Items(rows, least)

        def leaks(texts: pa.Array, items: Items = items) -> list[pa.Array]:
            met = {r for r, *_ in meetings(texts, items, least, coverage)}
            return [pa.array([r in met for r in range(len(texts))], pa.bool_())]

        documents = with_columns(documents, StructType([StructField(flag, BooleanType())]), leaks).where(~F.col(flag)).select(*columns)
    return documents
