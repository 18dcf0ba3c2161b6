"""Token ids as binary shards: each shard is one wavelet matrix with its document index.

A wavelet matrix stores a shard's ids as bit planes, most significant first; below each plane the
ids are parted stably by that bit. Rank on the planes gives token access and counting, select gives
the places of a token, and undoing the partings from below gives all ids at once.

Shards are rows of a Parquet table, so Spark compresses, writes, commits and reads them wherever it can.
"""

from __future__ import annotations

import os
import struct
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

from courierflow.llm.text import BLANK, LOWER, NOT_ALNUM, text_slices, whole_texts, word_spans

MAGIC = b"WMX1"
SHARD_TOKENS = 1 << 20
#: Words that a task remembers.
KEPT_WORDS = 1_000_000
#: Bytes that part words.
WHITE = bytes(np.flatnonzero(BLANK).astype(np.uint8))
#: Words that one call learns.
RUN_WORDS = 500
_bytes = np.arange(256)
#: Marks that end a word and are no part of an added token's name or of a clitic.
IS_MARK = np.isin(_bytes, list(b".,;:!?*#$%&"))
IS_LOWER = (_bytes >= 0x61) & (_bytes <= 0x7A)
IS_ALNUM = ~NOT_ALNUM & (_bytes < 0x80) | (_bytes >= 0x41) & (_bytes <= 0x5A)
#: Second bytes, after 0xC3, of Latin-1's letters.
IS_LETTER = (_bytes >= 0x80) & (_bytes <= 0xBF) & (_bytes != 0x97) & (_bytes != 0xB7)
SHARD = "part int, seq int, doc_ids array<bigint>, lengths array<bigint>, n_tokens bigint, matrix binary"


class WaveletMatrix:
    """Bit planes with rank directories over 64-bit words."""

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes
        self.before = [np.r_[0, np.cumsum(np.bitwise_count(p), dtype=np.int64)] for p in planes]
        self.zeros = [n - int(b[-1]) for b in self.before]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max(initial=0)).bit_length())
        ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes = []
        for level in range(width - 1, -1, -1):
            bits = (ids & ids.dtype.type(1 << level)).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            planes.append(np.r_[packed, np.zeros(-len(packed) % 8, np.uint8)].view("<u8"))
            ids = np.concatenate([ids[np.flatnonzero(~bits)], ids[np.flatnonzero(bits)]])  # faster than masks
        return cls(len(ids), planes)

    def to_bytes(self) -> bytes:
        body = [p.tobytes() for p in self.planes]
        return MAGIC + struct.pack("<QI", self.n, len(body)) + struct.pack(f"<{len(body)}I", *map(len, body)) + b"".join(body)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        if raw[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, count = struct.unpack_from("<QI", raw, 4)
        sizes, at, planes = struct.unpack_from(f"<{count}I", raw, 16), 16 + 4 * count, []
        for size in sizes:
            planes.append(np.frombuffer(raw, "<u8", size // 8, at))
            at += size
        return cls(n, planes)

    def rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place of a plane."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        plane = self.planes[level]
        inside = plane[np.minimum(word, len(plane) - 1)] & ((np.uint64(1) << bit) - np.uint64(1)) if len(plane) else bit
        return self.before[level][word] + np.bitwise_count(inside)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Token at each place."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for level, plane in enumerate(self.planes):
            bit = (plane[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
            ones = self.rank(level, at)
            at, out = np.where(bit, self.zeros[level] + ones, at - ones), 2 * out + bit
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        ends = np.array([low, high], np.int64)
        for level in range(len(self.planes)):
            ones = self.rank(level, ends)
            ends = self.zeros[level] + ones if token >> (len(self.planes) - 1 - level) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Times the token stands in ``[low, high)``."""
        low, high = self._range(token, low, self.n if high is None else high)
        return high - low

    def select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Place of the ``k``-th (from 0) such bit of a plane."""
        before = self.before[level] if bit else np.arange(len(self.before[level])) * 64 - self.before[level]
        word = np.searchsorted(before, k, "right") - 1
        bits = np.unpackbits(self.planes[level][word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") == bit
        return word * 64 + np.argmax(np.cumsum(bits, axis=1) == (k - before[word] + 1)[:, None], axis=1)

    def occurrences(self, token: int) -> np.ndarray:
        """All places of the token, ascending."""
        at = np.arange(*self._range(token, 0, self.n), dtype=np.int64)
        for level in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            bit = token >> (len(self.planes) - 1 - level) & 1
            at = self.select(level, bit, at - self.zeros[level] if bit else at)
        return np.sort(at)

    def tokens(self) -> np.ndarray:
        """All ids in order."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            bits = np.unpackbits(self.planes[level].view(np.uint8), count=self.n, bitorder="little").view(bool)
            above, zeros = np.empty_like(out), self.zeros[level]
            above[np.flatnonzero(~bits)] = out[:zeros]
            above[np.flatnonzero(bits)] = out[zeros:] | kind(1 << (len(self.planes) - 1 - level))
            out = above
        return out.astype(np.uint32)


def bounds(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a whole array of large binaries."""
    _, ends, data = words.buffers()
    offsets = np.frombuffer(ends, np.int64, len(words) + 1) if ends else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8, int(offsets[-1])) if data else np.zeros(0, np.uint8)


def as_list(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist


class WordEncoder:
    """Ids of texts, word by word: the vocabulary's tokens never cross ASCII white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content.encode()[:2] for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = CharDelimiterSplit(" ")
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        named = {c: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()}
        self.renamed = [(x, y) for c, name in named.items() for x, y in zip(c.encode().decode("latin-1"), name) if x != y]
        ids = self.tokenizer.get_vocab()
        self.last = np.zeros(max(ids.values()) + 1, bool)  # tokens that end a word
        self.last[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes], end: bytes) -> list[bytes]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        starts, ends, first = word_spans(data, offsets)
        words, first = self.pieces(self.words(data, starts, ends), first)
        met = words.dictionary_encode()
        ids = self.recall(met.dictionary).take(met.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[first].tolist() if len(ids) else [0] * len(first)
        flat = memoryview(ids.buffers()[2] or b"")
        return [b"".join([flat[a:b], end]) for a, b in zip(at, at[1:])]

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The vocabulary composes characters, then lower-cases them, so only words of ASCII are lower-cased here.

        Only the names of added tokens mind their case.
        """
        lengths = ends - starts
        whole = data.tobytes()
        raw = np.frombuffer(whole.translate(None, WHITE), np.uint8)
        low = whole.translate(LOWER.tobytes(), WHITE)
        offsets = np.r_[0, np.cumsum(lengths)]
        kept = np.zeros(len(starts), bool)
        kept[np.searchsorted(offsets, np.flatnonzero(raw > 0x7F), "right") - 1] = True
        for mark in self.marks:
            found = np.flatnonzero((data[:-1] == mark[0]) & (data[1:] == mark[1]))
            kept[np.searchsorted(starts, found, "right") - 1] = True
        if kept.any():
            low = np.where(np.repeat(kept, lengths), raw, np.frombuffer(low, np.uint8))
        return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low)])

    def pieces(self, words: pa.Array, first: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Words without the marks at their ends, these marks as words of their own, and the index of each row's first one.

        Marks after a letter or digit are tokens of their own, so a word is learned once, whatever mark follows it.
        """
        offsets, flat = bounds(words)
        marks = np.flatnonzero(IS_MARK[flat])
        begins = np.where(np.diff(marks, prepend=-2) != 1, np.arange(len(marks)), 0)
        runs = marks[np.maximum.accumulate(begins)]  # where each mark's run begins
        marked = np.flatnonzero(IS_MARK[flat[offsets[1:] - 1]])
        cuts = runs[np.searchsorted(marks, offsets[marked + 1] - 1)]
        split = (cuts > offsets[marked]) & (IS_ALNUM[flat[cuts - 1]] | (flat[cuts - 2] == 0xC3) & IS_LETTER[flat[cuts - 1]])
        marked, cuts = marked[split], cuts[split]
        offsets = np.insert(offsets, marked + 1, cuts)
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), words.buffers()[2]])
        return words, first + np.searchsorted(marked, first)

    def recall(self, words: pa.Array) -> pa.Array:
        """Ids of different words, from what was known before or by learning them."""
        known, listed = self.known, as_list(words)
        ids = list(map(known.get, listed))
        new = [i for i, got in enumerate(ids) if got is None]
        old = list(map(self.older.get, map(listed.__getitem__, new)))
        known.update((listed[i], got) for i, got in zip(new, old) if got is not None)
        self.learn(words.take(pa.array([i for i, got in zip(new, old) if got is None], pa.int64())))
        for i in new:
            ids[i] = known[listed[i]]
        if len(known) > KEPT_WORDS // 2:  # words that aren't met again until the next time are forgotten
            self.known, self.older = {}, {w: got for w, got in known.items() if len(w) <= 64}
        return pa.array(ids, pa.large_binary())

    def learn(self, words: pa.Array) -> None:
        """Ids of words. Letters of Latin-1 are composed and stay together: once lower-cased, only merges are left to do."""
        known, (offsets, flat) = self.known, bounds(words)
        ok = IS_LOWER[flat]
        pair = (flat[:-1] == 0xC3) & IS_LETTER[flat[1:]]
        ok[:-1] |= pair
        ok[1:] |= pair
        latin = np.ones(len(words), bool)
        latin[np.searchsorted(offsets, np.flatnonzero(~ok), "right") - 1] = False
        others = as_list(words.filter(pa.array(~latin)))
        for word, got in zip(others, self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False)):
            known[word] = array("I", got.ids).tobytes()
        words = words.filter(pa.array(latin))
        for at in range(0, len(words), RUN_WORDS):  # one call's words are told apart by their last tokens
            run = as_list(words.slice(at, RUN_WORDS))
            text = b" ".join(run).decode().lower().encode().decode("latin-1")
            for x, y in self.renamed:  # names of the bytes, as in the vocabulary
                text = text.replace(x, y)
            ids = np.array(self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = np.r_[0, np.flatnonzero(self.last[ids]) + 1] * 4
            got = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(ids)])
            known.update(zip(run, as_list(got), strict=True))


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_shards(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode whole texts and write them, by ascending ``doc_id``, as wavelet-matrix shards.

    ``end_id`` follows each document. Null texts count as empty; null ids come first; documents of
    one id stand in the order of their texts; a document longer than a shard has a shard of its
    own; an empty table makes a table without rows. Other columns are not written.
    """
    rows = whole_texts(documents, F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, ids, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def shard() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(held), "<u4")
            row = (part, seq, ids, [len(x) // 4 for x in held], len(flat), WaveletMatrix.build(flat).to_bytes())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

        names = ["part", "seq", "doc_ids", "lengths", "n_tokens", "matrix"]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a, b, data, offsets in text_slices(batch.column(1), 1 << 22):
                texts = [data[x:y].tobytes() for x, y in zip(offsets, offsets[1:])]
                for key, got in zip(keys[a:b], encoder(tokenizer).encode(texts, end)):
                    if held and size + len(got) // 4 > shard_tokens:
                        yield shard()
                        seq, ids, held, size = seq + 1, [], [], 0
                    ids.append(key)
                    held.append(got)
                    size += len(got) // 4
        if held:
            yield shard()

    rows.mapInArrow(run, SHARD).write.option("compression", "zstd").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(folder)


def documents_of(shards: DataFrame, **derived: Column) -> DataFrame:
    """``doc_id``, ``start`` (ids before it over all shards), ``n_tokens`` and ``ids`` of each document.

    With columns derived from ``ids``, these come instead of it, so that ids are not shuffled.
    """
    schema = "part int, seq int, doc_id bigint, at bigint, n_tokens bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                flat = WaveletMatrix.from_bytes(row["matrix"]).tokens().astype("<u4").tobytes()
                starts, n = np.cumsum(lengths) - lengths, len(lengths)
                ids = [flat[4 * a : 4 * (a + k)] for a, k in zip(starts.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(starts), pa.array(lengths), pa.array(ids, pa.binary())],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids"])

    values = [c.alias(name) for name, c in (derived or {"ids": F.col("ids")}).items()]
    rows = shards.mapInArrow(run, schema).select("part", "seq", "doc_id", "at", "n_tokens", *values)
    return rows.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", *(derived or ["ids"]))


def shard_starts(shards: DataFrame) -> DataFrame:
    """Ids before each shard: a running sum over parts, and one within each part."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("whole"))
    above = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("part", F.coalesce(F.sum("whole").over(above), F.lit(0)).alias("first"))
    within = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("within"))
    return within.join(first, "part").select("part", "seq", (F.col("first") + F.col("within")).alias("base"))


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """``doc_id`` and place within the document of each time the token stands in the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = WaveletMatrix.from_bytes(row["matrix"]).occurrences(token)
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                doc = np.searchsorted(ends, at, "right")
                place = at - np.r_[0, ends][doc]
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][d] for d in doc], pa.int64()), pa.array(place)], names=["doc_id", "place"])

    return shards.mapInArrow(run, "doc_id bigint, place bigint")


def token_counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """``token`` and ``n``: times each of the tokens stands in all shards, counted by rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                matrix = WaveletMatrix.from_bytes(raw)
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([matrix.count(t) for t in tokens], pa.int64())], names=["token", "n"])

    return shards.select("matrix").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
