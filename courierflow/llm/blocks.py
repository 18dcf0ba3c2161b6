"""Substring dedup by fixed-block anchors.

Blocks of ``BLOCK`` words at every ``BLOCK``-th word of each document are the reference index; every
rolling window of ``BLOCK`` words probes it. A repeated window of ``WINDOW`` words holds a whole
reference block of its earlier place, so hits find all repeats. Hits extend to windows of ``WINDOW``
words, and the first place of each window stays.

Words never travel: a chunk of documents sends sorted, delta-coded hashes with their places, each
hash once, so a passage in a third of all documents costs a bucket one entry a chunk. Buckets and
chunks have a fixed size, their number follows the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.llm.text import mix, run_hashes, text_slices, whole_texts, windows, word_hashes, word_spans

WINDOW, BLOCK = 20, 10
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20
NULL_ID = np.iinfo(np.int64).min
#: Rows between the steps: kind, key of the next step, chunk, numbers, and the documents of a chunk.
ROW = "kind int, bucket long, chunk long, a binary, b binary, ids array<bigint>, prints array<bigint>"
HASHES, DOCUMENTS, DECIDED = 0, 1, 2
LOW = np.uint64(0xFFFFFFFF)


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers as the byte planes of their gaps, deflated."""
    gaps = np.diff(values, prepend=values.dtype.type(0))
    return zlib.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1)


def unpack(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(size, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(kind), dtype=kind)


def planes(values: np.ndarray) -> bytes:
    """Numbers in any order as byte planes, deflated."""
    values = np.ascontiguousarray(values)
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), 1)


def unplanes(raw: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).reshape(-1).view(kind)


def table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 7
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "bucket", "chunk", "a", "b", "ids", "prints"])


def cut(values: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """``(bucket, from, to)`` of sorted 64-bit values by their leading bits."""
    bounds = np.searchsorted(values >> np.uint64(64 - bits) if bits else np.zeros(len(values), np.uint64), np.arange((1 << bits) + 1, dtype=np.uint64))
    for bucket in np.flatnonzero(np.diff(bounds)).tolist():
        yield bucket, int(bounds[bucket]), int(bounds[bucket + 1])


def anchors(bits: int):
    """Hashes of all rolling blocks of each chunk of documents, by bucket, each once.

    With a hash go its first place in the chunk, whether it has others there (kept with the chunk's
    documents as pairs of a place and the first one), and whether one is a block of the index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy()
            prints = batch.column(1).to_numpy()
            for x, y, data, offsets in text_slices(batch.column(2), CHUNK_BYTES):
                starts, ends, first = word_spans(data, offsets)
                at = windows(first, BLOCK)
                row = np.searchsorted(first, at, "right") - 1
                hashes = run_hashes(word_hashes(data, starts, ends), at, at + BLOCK)
                chunk = part << 32 | seq
                seq += 1
                order = np.argsort(hashes, kind="stable")
                new = np.r_[True, np.diff(hashes[order]) > 0][: len(order)]
                begins = np.flatnonzero(new)
                aligned = ((at - first[row]) % BLOCK == 0)[order]
                indexed = np.add.reduceat(aligned.astype(np.int64), begins) > 0 if len(begins) else aligned
                many = np.diff(np.r_[begins, len(order)]) > 1
                h, codes = hashes[order][begins], (4 * at[order][begins] + 2 * many + indexed).astype(np.uint32)
                again = np.stack([at[order][~new], at[order][begins][np.cumsum(new) - 1][~new]]).astype(np.uint32)
                rows = []
                for bucket, i, j in cut(h, bits):
                    rows.append((HASHES, bucket, chunk, pack((h[i:j] << np.uint64(bits)) >> np.uint64(32)), planes(codes[i:j]), None, None))
                rows.append((DOCUMENTS, chunk % (1 << bits), chunk, planes(first), planes(again.reshape(-1)), ids[x:y], prints[x:y]))
                yield from table(rows).to_batches()

    return run


def hits(bits: int):
    """Of one bucket: the blocks found at two places or more, back by chunk, those in the index marked."""

    def run(rows: pa.Table) -> pa.Table:
        out, found = [], []
        for kind, bucket, chunk, a, b, ids, prints in zip(*(c.to_pylist() for c in rows.columns)):
            if kind == DOCUMENTS:
                out.append((kind, bucket, chunk, a, b, ids, prints))
            else:
                found.append((bucket, chunk, unpack(a, np.uint64), unplanes(b, np.uint32)))
        if found:
            rest = np.concatenate([f[2] for f in found])
            places = np.concatenate([f[3] for f in found])
            order = np.argsort(rest, kind="stable")
            begins = np.flatnonzero(np.r_[True, np.diff(rest[order]) > 0])
            times = np.diff(np.r_[begins, len(rest)])
            flags = np.bitwise_or.reduceat(places[order] & 3, begins)
            repeated, indexed = np.empty(len(rest), bool), np.empty(len(rest), np.uint32)
            repeated[order] = np.repeat((times > 1) | (flags >= 2), times)
            indexed[order] = np.repeat(flags & 1, times)
            at = 0
            for bucket, chunk, own, place in found:
                keep, anchor = repeated[at : at + len(own)], indexed[at : at + len(own)]
                at += len(own)
                if keep.any():
                    # the block's value: its bucket and the rest of its hash
                    value = (np.uint64(bucket) << np.uint64(32)) | own[keep]
                    code = (place[keep] >> 2 << 1) | anchor[keep]
                    by = np.argsort(code)
                    out.append((HASHES, bucket, chunk, planes(value[by]), pack(code[by]), None, None))
        return table(out)

    return run


def extended(bits: int):
    """Of one chunk: hits of the index extended to windows that begin and end with repeated blocks.

    Each distinct window goes to the bucket of its hash once.

    Later places of a window within the chunk are decided at once.
    """

    def run(rows: pa.Table) -> pa.Table:
        values, places, first, again, ids, prints, chunk = [], [], None, None, None, None, 0
        for kind, _, chunk, a, b, d, p in zip(*(c.to_pylist() for c in rows.columns)):  # noqa: B007
            if kind == DOCUMENTS:
                first, again = unplanes(a, np.int64), unplanes(b, np.uint32).astype(np.int64).reshape(2, -1)
                ids, prints = np.array(d, np.int64), np.array(p, np.int64)
            else:
                values.append(unplanes(a, np.uint64))
                places.append(unpack(b, np.uint32).astype(np.int64))
        if not values:
            return table([])
        place, value = np.concatenate(places), np.concatenate(values)
        order = np.argsort(place)
        place, value = place[order], value[order]
        lead = np.minimum(np.searchsorted(place >> 1, again[1]), len(place) - 1)
        known = (place >> 1)[lead] == again[1]
        place = np.r_[place, (again[0][known] << 1) | (place[lead[known]] & 1)]
        value = np.r_[value, value[lead[known]]]
        order = np.argsort(place)
        place, value = place[order], value[order]
        anchored, place = (place >> 1)[place & 1 > 0], place >> 1
        far = place + WINDOW - BLOCK
        second = np.minimum(np.searchsorted(place, far), len(place) - 1)
        row = np.searchsorted(first, place, "right") - 1
        ok = (place[second] == far) & (far + BLOCK <= first[row + 1])
        ok &= np.searchsorted(anchored, far, "right") > np.searchsorted(anchored, place)
        place, row, u, v = place[ok], row[ok], value[ok], value[second[ok]]
        if not len(place):
            return table([])
        start = place - first[row]
        h1, h2 = mix(u * np.uint64(3) + mix(v)), mix(v * np.uint64(5) + mix(u + np.uint64(7))) & LOW
        order = np.lexsort((start, ids[row], h2, h1))
        h1, h2, row, start = h1[order], h2[order], row[order], start[order]
        new = np.r_[True, (np.diff(h1) > 0) | (np.diff(h2.astype(np.int64)) != 0)]
        group = np.cumsum(new) - 1
        lead = np.flatnonzero(new)[group]
        later = (ids[row] > ids[row[lead]]) | (start > start[lead])
        out = decided(row[later], start[later], ids, prints, bits)
        keep = ~later  # first places, and equal ones of rows with one id
        h1, h2, row, start = h1[keep], h2[keep], row[keep], start[keep]
        for bucket, i, j in cut(h1, bits):
            used, local = np.unique(row[i:j], return_inverse=True)
            out.append((HASHES, bucket, chunk, pack(h1[i:j]) + h2[i:j].astype(np.uint32).tobytes(), planes(np.stack([local, start[i:j]]).astype(np.uint32).reshape(-1)), ids[used], prints[used]))
        return table(out)

    return run


def decided(row: np.ndarray, start: np.ndarray, ids: np.ndarray, prints: np.ndarray, bits: int) -> list[tuple]:
    """Starts of windows to remove, packed by the part their document belongs to; copies of a text spread over all parts."""
    part = mix(ids.view(np.uint64) ^ mix(prints.view(np.uint64)))[row] & np.uint64((1 << bits) - 1)
    order = np.lexsort((start, row, part))
    part, row, start = part[order], row[order], start[order]
    out = []
    begins = np.flatnonzero(np.r_[True, np.diff(part) > 0]) if len(row) else []
    for i, j in zip(begins, [*begins[1:], len(row)]):
        used, local = np.unique(row[i:j], return_inverse=True)
        out.append((DECIDED, int(part[i]), 0, planes(start[i:j].astype(np.uint32)), planes(local.astype(np.uint32)), ids[used], prints[used]))
    return out


def by_document(rows: pa.Table) -> pa.Table:
    """Of one part of the documents: all starts of windows to remove, a row for each document."""
    ids, prints, starts = [], [], []
    for a, b, d, p in zip(*(rows.column(c).to_pylist() for c in ("a", "b", "ids", "prints"))):
        local = unplanes(b, np.uint32)
        ids.append(np.array(d, np.int64)[local])
        prints.append(np.array(p, np.int64)[local])
        starts.append(unplanes(a, np.uint32))
    i, p, s = (np.concatenate(x) for x in (ids, prints, starts))
    order = np.lexsort((s, p, i))
    i, p, s = i[order], p[order], s[order]
    begins = np.flatnonzero(np.r_[True, (np.diff(i) != 0) | (np.diff(p) != 0)])
    packed = [pack(s[x:y]) for x, y in zip(begins, [*begins[1:], len(s)])]
    return pa.table([pa.array(i[begins]), pa.array(p[begins]), pa.array(packed, pa.binary())], names=["id", "of", "starts"])


def firsts(bits: int):
    """Of one bucket of windows: all places but the first of each, by part of the documents."""

    def run(rows: pa.Table) -> pa.Table:
        out, found = [], []
        for row in zip(*(c.to_pylist() for c in rows.columns)):
            kind, _, _, a, b, ids, prints = row
            if kind == DECIDED:
                out.append(row)
                continue
            local, start = unplanes(b, np.uint32).reshape(2, -1)
            n = len(start)
            found.append((unpack(a[: len(a) - 4 * n], np.uint64), np.frombuffer(a[len(a) - 4 * n :], np.uint32), np.array(ids)[local], np.array(prints)[local], start))
        if found:
            h1, h2, ids, prints, start = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((start, ids, h2, h1))
            h1, h2, ids, prints, start = (x[order] for x in (h1, h2, ids, prints, start))
            new = np.r_[True, (np.diff(h1) > 0) | (np.diff(h2.astype(np.int64)) != 0)]
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = (ids > ids[lead]) | (start > start[lead])
            pairs, row = np.unique(np.stack([ids[later], prints[later]]), axis=1, return_inverse=True)
            out += decided(row.reshape(-1), start[later], pairs[0], pairs[1], bits)
        return table(out)

    return run


def without(texts: list[bytes], starts: list[bytes | None], removed_words: int) -> list[tuple[int, int, str]]:
    """Word count, removed words and the kept words, joined by one space, of each text."""
    out = []
    for raw, packed in zip(texts, starts):
        words = kept = raw.split()
        if packed:
            at, gone = unpack(packed, np.uint32).astype(np.int64), np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, at, 1)
            np.add.at(gone, at + removed_words, -1)
            kept = [w for w, c in zip(words, (np.cumsum(gone)[:-1] > 0).tolist()) if not c]
        out.append((len(words), len(words) - len(kept), b" ".join(kept)))
    return out


def bucket_bits(docs: DataFrame, bucket_bytes: int) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(3, (size // bucket_bytes).bit_length())


def dedup(documents: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (words joined by one space) of each row.

    Each word that a window of ``WINDOW`` words covers is removed if the same words also start
    earlier: in a smaller ``doc_id``, or before it in the same document. Null ids come before all
    others; rows of one id count as one document, so equal places in repeated rows both stay. Null
    and empty texts keep nothing and lose nothing; an empty table gives no rows.
    """
    docs = whole_texts(documents, F.col("doc_id").cast("long").alias("doc_id")).select("doc_id", F.xxhash64("text").alias("print"), "text")
    bits = bucket_bits(docs, bucket_bytes)
    by_bucket = docs.mapInArrow(anchors(bits), ROW).groupBy("bucket").applyInArrow(hits(bits), ROW)
    by_window = by_bucket.groupBy("chunk").applyInArrow(extended(bits), ROW).groupBy("bucket").applyInArrow(firsts(bits), ROW)
    gone = by_window.groupBy("bucket").applyInArrow(by_document, "id long, of long, starts binary")
    key = F.coalesce("doc_id", F.lit(int(NULL_ID)).cast("long"))
    joined = docs.withColumn("key", key).join(gone, (F.col("key") == gone["id"]) & (F.col("print") == gone["of"]), "left").select("doc_id", "text", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, data, offsets in text_slices(batch.column(1), 1 << 24):
                rows = without([data[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], batch.column(2).slice(x, y - x).to_pylist(), WINDOW)
                n, kept, text = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), pa.array(n, pa.int64()), pa.array(kept, pa.int64()), pa.array([t.decode() for t in text], pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
