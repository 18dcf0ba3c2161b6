"""Suffix-array dedup of byte strings: threshold-bounded interval expansion on a BWT.

Each string of ``LENGTH`` bytes belongs to its anchor, the ``GRAM`` bytes in it of least hash, so
equal strings have equal anchors at equal places. Neighbouring strings of one anchor form a window.
Windows whose anchor stands once hold no repeat. Equal windows are counted before anything is sent:
all their strings repeat. What is left, different windows of one anchor, is settled on text: the
windows of a bucket make one Burrows-Wheeler transform, and breadth-first backward extension sets
its common prefixes by increasing value up to ``LENGTH``; entries never set are repeats.

An anchor with more than ``MOST_WINDOWS`` windows is too large for one task: its strings are counted
one by one instead, with partial sums, which is exact too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.llm.blocks import DOCUMENTS, HASHES, NULL_ID, ROW, bucket_bits, cut, pack, planes, table, unpack, unplanes
from courierflow.llm.text import mix, run_hashes, text_slices, whole_texts
from courierflow.session import materialize

LENGTH, GRAM = 200, 32
CHUNK_BYTES, BUCKET_BYTES, BWT_BYTES = 2 << 20, 32 << 20, 1 << 20
MOST_WINDOWS = 4096
PLACE = np.uint64((1 << 24) - 1)
WINDOW = "value long, settled boolean, raw binary, doc_id long, print long, start long"
RUNS = "doc_id long, print long, runs binary"


def anchor_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: first and last string start, place of the anchor, and the anchor's hash."""
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n < 1:
        return none, none, none, none.astype(np.uint64)
    places = np.arange(len(data) - GRAM + 1)
    hashes = run_hashes(data, places, places + GRAM)
    # the rightmost of equal hashes wins: the place, counted down, fills the low bits
    least = (hashes & ~PLACE) | (PLACE - (places.astype(np.uint64) & PLACE))
    width, span = 1, LENGTH - GRAM + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[span - width : span - width + n])
    starts = np.arange(n)
    place = starts + ((PLACE - (least & PLACE)).astype(np.int64) - starts) % (1 << 24)
    row = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + LENGTH <= offsets[row + 1]
    starts, place, row = starts[inside], place[inside], row[inside]
    begins = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(row) != 0)][: len(place)])
    ends = np.r_[begins[1:], len(place)] - 1
    return starts[begins], starts[ends[: len(begins)]], place[begins], hashes[place[begins]]


def anchors(bits: int):
    """Anchors and window hashes of each chunk of documents by bucket, each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            ids, prints = batch.column(0).fill_null(NULL_ID).to_numpy(), batch.column(1).to_numpy()
            for x, y, data, offsets in text_slices(batch.column(2), CHUNK_BYTES):
                first, last, place, anchor = anchor_runs(data, offsets)
                anchor = mix(anchor)  # the least of many hashes has leading zeros: mixed anew, it spreads over the buckets
                window = mix(run_hashes(data, first, last + LENGTH) ^ mix((place - first).astype(np.uint64)))
                chunk = part << 32 | seq
                seq += 1
                order = np.lexsort((first, window, anchor))
                a, w = anchor[order], window[order]
                new = np.r_[True, (np.diff(a) > 0) | (np.diff(w) != 0)][: len(order)]
                begins = np.flatnonzero(new)
                many = np.diff(np.r_[begins, len(order)]) > 1
                lead = begins[np.cumsum(new) - 1] if len(order) else begins
                again = np.stack([first[order][~new], last[order][~new], first[order][lead[~new]]]).astype(np.uint32)
                h, w = a[begins], w[begins]
                at = np.stack([2 * first[order][begins] + many, last[order][begins] - first[order][begins]]).astype(np.uint32)
                rows = []
                for bucket, i, j in cut(h, bits):
                    rest = (h[i:j] << np.uint64(bits)) >> np.uint64(32)
                    rows.append((HASHES, bucket, chunk, pack(rest), planes(at[:, i:j].reshape(-1)) , w[i:j].view(np.int64), None))
                rows.append((DOCUMENTS, chunk % (1 << bits), chunk, planes(offsets), planes(again.reshape(-1)), ids[x:y], prints[x:y]))
                yield from table(rows).to_batches()

    return run


def hits(rows: pa.Table) -> pa.Table:
    """Of one bucket: windows of anchors that stand more than once, back by chunk.

    A window found elsewhere too is settled; one of each anchor's different windows is sent on.
    """
    out, found = [], []
    for kind, bucket, chunk, a, b, ids, prints in zip(*(c.to_pylist() for c in rows.columns)):
        if kind == DOCUMENTS:
            out.append((kind, bucket, chunk, a, b, ids, prints))
        else:
            rest = unpack(a, np.uint64)
            found.append((bucket, chunk, rest, np.array(ids, np.int64), unplanes(b, np.uint32).reshape(2, -1)))
    if found:
        rest, window = (np.concatenate([f[k] for f in found]) for k in (2, 3))
        at = np.concatenate([f[4] for f in found], axis=1)
        order = np.lexsort((window, rest))
        r, w = rest[order], window[order]
        new_anchor = np.r_[True, np.diff(r) > 0]
        new = new_anchor | np.r_[True, np.diff(w) != 0]
        group, anchor = np.cumsum(new) - 1, np.cumsum(new_anchor) - 1
        many = (at[0][order] & 1) > 0
        settled = ((np.bincount(group) > 1) | (np.bincount(group, many) > 0))[group]
        mixed = (np.bincount(anchor, new) > 1)[anchor]
        code = np.empty(len(rest), np.int64)
        code[order] = settled + 2 * (mixed & new)
        start = 0
        for bucket, chunk, own, _, places in found:
            mine = code[start : start + len(own)]
            start += len(own)
            keep = mine > 0
            if keep.any():
                value = (np.uint64(bucket) << np.uint64(32)) | own[keep]
                first = places[0][keep] >> 1
                numbers = np.stack([first, first + places[1][keep], mine[keep].astype(np.uint32)]).astype(np.uint32)
                out.append((HASHES, bucket, chunk, planes(value), planes(numbers.reshape(-1)), None, None))
    return table(out)


def by_document(rows: pa.Table) -> pa.Table:
    """Of one chunk: for each document, the byte runs of settled windows and the windows to send on."""
    numbers, values, doc = [], [], None
    for kind, _, _, a, b, ids, prints in zip(*(c.to_pylist() for c in rows.columns)):
        if kind == DOCUMENTS:
            doc = unplanes(a, np.int64), unplanes(b, np.uint32).astype(np.int64).reshape(3, -1), ids, prints
        else:
            numbers.append(unplanes(b, np.uint32).reshape(3, -1).astype(np.int64))
            values.append(unplanes(a, np.uint64))
    out = []
    if numbers:
        offsets, again, ids, prints = doc
        first, last, code = np.concatenate(numbers, axis=1)
        value = np.concatenate(values).view(np.int64)
        settled = code & 1 > 0
        # the other places of a settled window within the chunk
        repeated = np.isin(again[2], first[settled])
        begin, end = np.r_[first[settled], again[0][repeated]], np.r_[last[settled], again[1][repeated]] + LENGTH
        sent = code >= 2
        row, sent_row = (np.searchsorted(offsets, x, "right") - 1 for x in (begin, first[sent]))
        for r in np.unique(np.r_[row, sent_row]).tolist():
            mine, ours = row == r, sent_row == r
            windows = np.stack([first[sent][ours] - offsets[r], last[sent][ours] - offsets[r], settled[sent][ours], value[sent][ours]]).astype(np.int64)
            out.append((int(ids[r]), int(prints[r]), joined(begin[mine] - offsets[r], end[mine] - offsets[r]).tobytes(), windows.tobytes() if ours.any() else None))
    columns = list(zip(*out)) or [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["doc_id", "print", "runs", "windows"])


def joined(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximal runs ``(begin, end)`` of what the given runs cover."""
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.r_[True, begin[1:] > end[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(begin) - 1]
    return np.stack([begin[new], end[last]], axis=1).astype(np.int64)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Rotations of the text sorted by their first 256 symbols at least, by doubling."""
    n = len(text)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | np.roll(text, -k).astype(np.uint64)
    width = 8
    while True:
        order = np.argsort(key, kind="stable")
        new = np.r_[False, np.diff(key[order]) > 0]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
        if width > LENGTH or int(new.sum()) == n - 1:
            return order
        key = rank * np.uint64(n) + np.roll(rank, -width)
        width *= 2


def long_prefixes(text: np.ndarray, least: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of a cyclic text, and whether each rotation shares ``least`` symbols with the one before it.

    Level by level, the intervals of strings of one length are extended backwards by each symbol
    before them; the end of an interval that no shorter string has set gets the level as its common
    prefix, and the interval is extended in turn. Ends not set below ``least`` are long prefixes.
    """
    n = len(text)
    order = suffix_order(text)
    bwt = text[order - 1]
    back = np.empty(n, np.int64)  # last-to-first mapping
    back[np.argsort(bwt, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        if not len(low):
            break
        size = high - low
        at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        key = (np.repeat(np.arange(len(low)), size) << 8) | bwt[at]
        by = np.argsort(key, kind="stable")
        key, to = key[by], back[at[by]]
        begins = np.flatnonzero(np.r_[True, np.diff(key) != 0])
        low, high = to[begins], to[np.r_[begins[1:], len(to)] - 1] + 1
        fresh = ~known[high]
        known[high] = True
        low, high = low[fresh], high[fresh]
        sort = np.argsort(low)
        low, high = low[sort], high[sort]
    return order, ~known[:n]


def repeats(raws: list[bytes]) -> list[np.ndarray]:
    """Starts of strings of ``LENGTH`` bytes in each window that stand in another place of the windows too."""
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    ends = np.cumsum(lengths + 1)
    flat = np.frombuffer(b"\0".join(raws) + b"\0", np.uint8)
    dense = np.zeros(256, np.uint8)
    used = np.unique(flat)
    dense[used] = np.arange(1, len(used) + 1)  # UTF-8 leaves enough values for a parting symbol
    text = dense[flat]
    text[ends - 1] = 0
    order, long = long_prefixes(text)
    twice = np.zeros(len(text), bool)
    twice[order[long]] = True
    twice[order[:-1][long[1:]]] = True
    starts = ends - lengths - 1
    window = np.searchsorted(ends, np.arange(len(text)), "right")
    ok = twice & (np.arange(len(text)) - starts[np.minimum(window, len(raws) - 1)] + LENGTH <= lengths[np.minimum(window, len(raws) - 1)])
    at = np.flatnonzero(ok)
    cuts = np.searchsorted(at, np.r_[starts, len(text)])
    return [at[a:b] - s for a, b, s in zip(cuts, cuts[1:], starts)]


def expand(group: pa.Table) -> pa.Table:
    """Runs of repeats in the windows of one bucket."""
    raws = group.column("raw").to_pylist()
    settled, docs, prints, start = (group.column(c).to_pylist() for c in ("settled", "doc_id", "print", "start"))
    out = [
        (docs[k], prints[k], joined(found + start[k], found + start[k] + LENGTH).tobytes())
        for k, found in enumerate(repeats(raws)) if len(found) and not settled[k]
    ]
    columns = list(zip(*out)) or [[]] * 3
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "print", "runs"])


def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each window to send on, from the documents' texts."""
    for batch in batches:
        for x, y, data, offsets in text_slices(batch.column(2)):
            out = []
            for k, blob in enumerate(batch.column(3).slice(x, y - x).to_pylist()):
                first, last, settled, value = np.frombuffer(blob, np.int64).reshape(4, -1).tolist()
                key = batch.column(0)[x + k].as_py(), batch.column(1)[x + k].as_py()
                out += [(v, bool(s), data[offsets[k] + i : offsets[k] + j + LENGTH].tobytes(), *key, i) for i, j, s, v in zip(first, last, settled, value)]
            kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)], names=["value", "settled", "raw", "doc_id", "print", "start"])


def counted_one_by_one(windows: DataFrame) -> DataFrame:
    """Runs of repeats of windows too many for one task: each string's two hashes are counted."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(2)
            flat = np.frombuffer(b"".join(raws.to_pylist()), np.uint8)
            lengths = np.fromiter(map(len, raws.to_pylist()), np.int64, len(raws))
            begin, n = np.cumsum(lengths) - lengths, lengths - LENGTH + 1
            owner = np.repeat(np.arange(len(raws)), n)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = begin[owner] + inner
            hashes = [run_hashes(flat, at, at + LENGTH, k).view(np.int64) for k in (0, 1)]
            take = lambda k: batch.column(k).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays([*map(pa.array, hashes), take(1), take(3), take(4), pa.array(take(5).to_numpy() + inner)], names=["ha", "hb", "settled", "doc_id", "print", "start"])

    rows = windows.mapInArrow(strings, "ha long, hb long, settled boolean, doc_id long, print long, start long")
    twice = rows.groupBy("ha", "hb").agg(F.count("*").alias("n")).where("n > 1").select("ha", "hb")
    found = rows.where("not settled").join(twice, ["ha", "hb"], "left_semi")
    return found.groupBy("doc_id", "print", F.floor(F.col("start") / 4096).alias("part")).agg(F.collect_list("start").alias("starts")).mapInArrow(run_rows, RUNS)


def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts = [np.array(s, np.int64) for s in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([joined(s, s + LENGTH).tobytes() for s in starts], pa.binary())], names=["doc_id", "print", "runs"])


def dedup(documents: DataFrame, bucket_bytes: int = BUCKET_BYTES, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes) of each row.

    Each byte that a string of ``LENGTH`` bytes covers is removed if the string also starts anywhere
    else. Rows are documents of their own, repeated ones and those of one id too; null and empty
    texts lose nothing; an empty table gives no rows.
    """
    docs = whole_texts(documents, F.col("doc_id").cast("long").alias("doc_id")).select(F.coalesce("doc_id", F.lit(int(NULL_ID))).alias("doc_id"), F.xxhash64("text").alias("print"), "text")
    bits = bucket_bits(docs, bucket_bytes)
    by_bucket = docs.mapInArrow(anchors(bits), ROW).groupBy("bucket").applyInArrow(hits, ROW)
    marked = by_bucket.groupBy("chunk").applyInArrow(by_document, "doc_id long, print long, runs binary, windows binary")
    marked = materialize(marked, "marked")
    sending = marked.where("windows is not null").select("doc_id", "print", "windows")
    # a repeated row has its windows settled, so any one of them can send the text
    windows = materialize(docs.join(sending, ["doc_id", "print"]).mapInArrow(cut_windows, WINDOW), "windows")
    sizes = windows.groupBy("value").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > most_windows).select("value")
    total = windows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    buckets = max(1, total // BWT_BYTES)
    small = windows.join(large, "value", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    runs = marked.where(F.octet_length("runs") > 0).select("doc_id", "print", "runs")
    runs = runs.union(small.groupBy("bucket").applyInArrow(expand, RUNS)).union(counted_one_by_one(windows.join(large, "value", "left_semi")))
    gone = runs.groupBy("doc_id", "print").agg(F.collect_list("runs").alias("runs"))
    rest = docs.join(gone, ["doc_id", "print"], "left").select("doc_id", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, data, offsets in text_slices(batch.column(1), 1 << 24):
                out = []
                for k, blobs in enumerate(batch.column(2).slice(x, y - x).to_pylist()):
                    raw = data[offsets[k] : offsets[k + 1]].tobytes()
                    both = np.frombuffer(b"".join(blobs or []), np.int64).reshape(-1, 2)
                    spans = joined(both[:, 0], both[:, 1]).tolist()
                    edges = [0, *(e for s in spans for e in s), len(raw)]
                    kept = b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2]))
                    out.append((len(raw), len(raw) - len(kept), len(spans), kept))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary())))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    made = rest.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return made.withColumn("doc_id", F.when(F.col("doc_id") != int(NULL_ID), F.col("doc_id")))
