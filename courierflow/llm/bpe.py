"""BPE encoding and decoding, the merges found by a segment tree over adjacent pair ranks.

Each leaf of the tree holds the rank of the pair that starts at that symbol; the root is the
leftmost pair of lowest rank. A merge changes three leaves, each with a logarithmic update, until
no pair can be merged. A piece of ``n`` bytes so takes ``O(n log n)`` steps, whatever it holds.

Texts part into pieces at each single blank between two other characters, where no token ever
crosses; a bounded table remembers the pieces of a task, so the tree runs once for each piece.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from courierflow.llm.text import with_columns

#: Pieces, and chunks between blanks, that a task remembers; twice as many for a while.
KEPT_PIECES = 200_000
# White space and the split pattern of byte-level vocabularies.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
RARE = re.compile(f"[{WHITE}]".replace(r"\t-\r ", r"\t\x0b-\r"))
BETWEEN = re.compile(rf"(?<=[^{WHITE}]) (?=[^{WHITE}])")


NONE = np.int64(1 << 62)
#: Pieces of at least so many bits of length get a tree of their own.
LONG_WIDTH = 8
#: Symbols whose trees are built at once.
FOREST_LEAVES = 1 << 17


def trim(known: dict[str, bytes], new: Iterable[str], most: int = KEPT_PIECES) -> None:
    """Forget very long new keys, and the oldest entries beyond ``most``."""
    for key in [k for k in new if len(k) > 64]:
        known.pop(key, None)
    for key in list(islice(known, max(0, len(known) - most))):
        del known[key]


def chunks_of(text: str) -> list[str]:
    """The text cut before each single blank between two other characters."""
    if not text:
        return []
    chunks = text.split(" ")
    if "" in chunks or "\n " in text or " \n" in text or RARE.search(text):
        chunks = BETWEEN.split(text)
    return [chunks[0], *map(" ".__add__, chunks[1:])]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairForest:
    """One segment tree for each of many rows of symbols, all of one width, side by side.

    Leaf ``i`` of a row's tree holds ``rank * size + i`` of the pair that starts at symbol ``i``, so
    the root is the leftmost pair of lowest rank.
    """

    def __init__(self, ranks: np.ndarray):
        n, pairs = ranks.shape
        self.size = 1 << max(0, (pairs - 1).bit_length())
        self.tree = np.full((n, 2 * self.size), NONE)
        self.tree[:, self.size : self.size + pairs] = np.where(ranks < NONE, ranks * self.size + np.arange(pairs), NONE)
        width = self.size
        while width > 1:
            level = self.tree[:, width : 2 * width]
            width //= 2
            self.tree[:, width : 2 * width] = np.minimum(level[:, 0::2], level[:, 1::2])

    def best(self, rows: np.ndarray) -> np.ndarray:
        return self.tree[rows, 1]

    def put(self, rows: np.ndarray, places: np.ndarray, ranks: np.ndarray) -> None:
        tree, at = self.tree, places + self.size
        tree[rows, at] = np.where(ranks < NONE, ranks * self.size + places, NONE)
        for _ in range(self.size.bit_length() - 1):
            at = at >> 1
            tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])


class PairTree:
    """The same tree for one long row of symbols."""

    def __init__(self, ranks: list[int]):
        self.size = 1 << max(0, (len(ranks) - 1).bit_length())
        self.none = int(NONE)
        self.tree = [self.none] * (2 * self.size)
        for i, r in enumerate(ranks):
            if r < self.none:
                self.tree[self.size + i] = r * self.size + i
        for i in range(self.size - 1, 0, -1):
            self.tree[i] = min(self.tree[2 * i], self.tree[2 * i + 1])

    def put(self, place: int, rank: int) -> None:
        tree, i = self.tree, self.size + place
        tree[i] = rank * self.size + place if rank < self.none else self.none
        while i > 1:
            i >>= 1
            low = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == low:
                break
            tree[i] = low


class ByteBpe:
    """A byte-level vocabulary read from a ``tokenizers`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.of_byte = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [(vocab[x], vocab[y], vocab[x + y]) for x, y in spec["model"]["merges"]]
        pairs = np.array([x << 32 | y for x, y, _ in merges], np.int64)
        self.made = np.array([z for _, _, z in merges], np.int64)
        self.ranked = np.argsort(pairs)
        self.rank_of = {(x, y): r for r, (x, y, _) in enumerate(merges)}
        self.pairs = pairs[self.ranked]
        self.bytes_of: list[bytes] = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.split = regex.compile(SPLIT)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.added_ids = {token: i.to_bytes(4, "little") for token, i in self.added.items()}
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, ``NONE`` where they don't merge."""
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.ranked[at], NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word of one width class: merges run side by side, a tree for each word."""
        n, width = len(words), max(map(len, words))
        lengths = np.fromiter(map(len, words), np.int64, n)
        symbols = np.full((n, width + 1), -1, np.int64)  # the last column never holds a symbol
        symbols[np.arange(width + 1) < lengths[:, None]] = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        if width > 1:
            forest = PairForest(self.rank(symbols[:, : width - 1], symbols[:, 1:width]))
            rows = np.arange(n)
            while len(rows):
                root = forest.best(rows)
                rows = rows[root < NONE]
                if not len(rows):
                    break
                rank, i = np.divmod(root[root < NONE], forest.size)
                j = after[rows, i]
                k = after[rows, j]
                symbols[rows, i] = self.made[rank]
                symbols[rows, j] = -1
                after[rows, i] = k
                before[rows, k] = i
                none = np.full(len(rows), NONE)
                if (inner := j < forest.size).any():
                    forest.put(rows[inner], j[inner], none[inner])
                forest.put(rows, i, self.rank(symbols[rows, i], symbols[rows, k]))
                h = before[rows, i]
                if (some := h >= 0).any():
                    forest.put(rows[some], h[some], self.rank(symbols[rows[some], h[some]], symbols[rows[some], i[some]]))
        left = symbols >= 0
        ends = np.cumsum(left.sum(axis=1)) * 4
        ids = symbols[left].astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def merge_long(self, word: bytes) -> bytes:
        """Ids of one long word."""
        symbols, made, none = self.of_byte[np.frombuffer(word, np.uint8)].tolist(), self.made.tolist(), int(NONE)
        n, rank = len(symbols), lambda a, b: self.rank_of.get((a, b), none)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = PairTree([rank(a, b) for a, b in zip(symbols, symbols[1:])])
        while (root := tree.tree[1]) < none:
            r, i = divmod(root, tree.size)
            j = after[i]
            k = after[i] = after[j]
            symbols[i], symbols[j] = made[r], -1
            if j < n - 1:
                tree.put(j, none)
            if k < n:
                before[k] = i
                tree.put(i, rank(symbols[i], symbols[k]))
            else:
                tree.put(i, none)
            if (h := before[i]) >= 0:
                tree.put(h, rank(symbols[h], symbols[i]))
        return np.array([x for x in symbols if x >= 0], "<u4").tobytes()

    def learn(self, chunks: set[str]) -> None:
        """Add the ids of chunks that the task hasn't met."""
        split = [self.split.findall(x) for x in chunks]
        pieces = self.pieces
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        unknown = {p for ps in split for p in ps} - pieces.keys()
        for p in unknown:
            raw = p.encode()
            by_width.setdefault(max(2, (len(raw) - 2).bit_length()), []).append((p, raw))
        for width, new in by_width.items():
            names, raws = zip(*new)
            if width >= LONG_WIDTH:
                pieces.update(zip(names, map(self.merge_long, raws)))
                continue
            step = max(1, FOREST_LEAVES >> width)
            for k in range(0, len(new), step):
                pieces.update(zip(names[k : k + step], self.merge(raws[k : k + step])))
        of = pieces.__getitem__
        self.chunks.update(zip(chunks, (of(ps[0]) if len(ps) == 1 else b"".join(map(of, ps)) for ps in split)))
        trim(pieces, unknown)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        rows = []
        for t in texts:
            parts = self.special.split(t) if self.special else [t]
            rows.append(chunks_of(t) if len(parts) == 1 else [x for k, part in enumerate(parts) for x in ([part] if k % 2 else chunks_of(part))])
        self.chunks.update(self.added_ids)
        unknown = set().union(*rows) - self.chunks.keys()
        self.learn(unknown)
        out = [b"".join(map(self.chunks.__getitem__, row)) for row in rows]
        trim(self.chunks, unknown)
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@cache
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with a binary column of token ids, little-endian unsigned 32-bit integers.

    ``path`` is a byte-level vocabulary that every executor can open. Whole texts are encoded,
    strings of added tokens as those tokens. Null and empty texts give no ids; equal texts equal
    ids; a column named like ``ids`` is replaced, all others stay as they are.
    """
    new = StructType([StructField(ids, BinaryType())])
    return with_columns(df, new, lambda texts: [pa.array(load(path).encode(texts.to_pylist()), pa.binary())], text)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and the text that its ids decode to, in one pass."""
    new = StructType([StructField(ids, BinaryType()), StructField(decoded, StringType())])

    def run(texts: pa.Array) -> list[pa.Array]:
        coded = load(path).encode(texts.to_pylist())
        return [pa.array(coded, pa.binary()), pa.array(map(load(path).decode, coded), pa.string())]

    return with_columns(df, new, run, text)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of a column of ids as ``encode`` writes it; null ids give an empty text."""
    kept = df.select(*[c for c in df.columns if c.lower() != text.lower()])
    schema = StructType([*kept.schema.fields, StructField(text, StringType())])
    at = kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([load(path).decode(x or b"") for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return kept.mapInArrow(run, schema)
