"""A trie of conversation prefixes, with subtree sums from node tables behind minimal perfect hashes.

Each turn becomes a 32-byte digest as it is read; texts travel no further. A prefix is named by 128
bits that a prefix scan carries along the conversation, so a conversation of any length is spread
over tasks. Equal prefixes meet in an aggregate that combines on the map side and checks that one
name never stands for two prefixes. Every node is represented by its smallest member, whose path
holds all its ancestors: so whole paths of members, dealt to shards, are enough to sum subtrees. A
shard enumerates its distinct prefixes, gives each a slot by a minimal perfect hash, scatters counts
into flat arrays by slot, and adds them to their parents' slots in order of depth. Sums of shards add up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.llm.text import mix
from courierflow.operators.sequence import running
from courierflow.operators.skew import DEFAULT, SkewPolicy
from courierflow.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a node table; the turns of a conversation up to which its path goes to a shard whole.
SHARD_ROWS = 1 << 16
#: Bytes of joined ids that travel as one row.
PACK_BYTES = 4096


# -- the rebuilt conversations of the contract --------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``mark`` (digest of role and text) and ``words`` of each row with a conversation id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)  # the length parts role from text
    return conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.unhex(F.sha2(F.encode(said, "UTF-8"), 256)).alias("mark"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def rebuilt(conversations: DataFrame, group: int = 20, most: int = 4, policy: SkewPolicy = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """The turns (``conv_id``, ``pos`` from 0, ``mark``, ``words``) and lengths (``conv_id``, ``length``) of all
    conversations, each with its first turns taken from the first conversation of its group.

    Turns stand in order of ``turn``, null first; rows of one turn in order of their digest. Null roles
    and texts count as empty. Rows without a conversation id belong to no conversation.
    """
    turns = materialize(turns_of(conversations), "turns")
    placed = running(turns, ["conv_id"], ["turn", "mark"], {"pos": ("sum", F.lit(1))}, policy)
    placed = materialize(placed.withColumn("pos", F.col("pos") - 1), "placed")
    first = F.col("conv_id") - F.col("conv_id") % group
    heads = placed.where((F.col("pos") < most - 1) & (F.col("conv_id") == first)).groupBy(F.col("conv_id").alias("_first")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "mark", "words"))).alias("_head"))
    own = placed.groupBy("conv_id").agg(F.count("*").alias("_own"))
    taken = F.crc32(F.col("conv_id").cast("string")) % most
    known = own.withColumns({"_first": first, "_taken": taken}).join(heads, "_first", "left")
    head = F.slice(F.coalesce("_head", F.array().cast(heads.schema["_head"].dataType)), F.lit(1), F.col("_taken").cast("int"))
    known = materialize(known.select("conv_id", "_own", "_taken", head.alias("_head")), "known")
    lengths = known.select("conv_id", (F.size("_head") + F.greatest(F.lit(0), F.col("_own") - F.col("_taken"))).cast("long").alias("length"))
    shift = known.select("conv_id", "_taken", F.size("_head").alias("_given"))
    rest = placed.join(shift, "conv_id").where(F.col("pos") >= F.col("_taken")).select(
        "conv_id", (F.col("pos") - F.col("_taken") + F.col("_given")).alias("pos"), "mark", "words")
    return known.select("conv_id", F.inline("_head")).unionByName(rest), lengths


# -- the node table of a shard ---------------------------------------------------------


class SlotTable:
    """Slots 0..n-1 for n distinct pairs of 64-bit keys: a minimal perfect hash of bit levels.

    Keys that are alone in their cell of a level take it, the others go on to the next level; a
    key's slot is the number of taken cells before its own. Keys lie stored by slot, and a look-up
    compares them, so that a key that isn't in the table never gets a slot.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # taken cells, and how many lie before each
        left, taken = np.arange(len(a)), 0
        while len(left):
            size = 2 * len(left) + 1
            cell = self._cell(a[left], b[left], len(self.levels), size)
            alone = np.bincount(cell, minlength=size) == 1
            self.levels.append((alone, taken + np.cumsum(alone) - alone))
            taken += int(alone.sum())
            left = left[~alone[cell]]
        self.a, self.b = np.zeros(len(a), a.dtype), np.zeros(len(b), b.dtype)
        self.verified = False
        slots = self.slots(a, b)
        self.a[slots], self.b[slots] = a, b
        self.verified = True
        if not (self.slots(a, b) == slots).all():  # two keys in one slot would overwrite each other
            raise ValueError("prefixes collide in a node table")

    @staticmethod
    def _cell(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        return (mix(mix(a.view(np.uint64) ^ seed) ^ b.view(np.uint64)) % np.uint64(size)).astype(np.int64)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where the table doesn't hold it."""
        out, left = np.full(len(a), -1), np.arange(len(a))
        for level, (taken, before) in enumerate(self.levels):
            cell = self._cell(a[left], b[left], level, len(taken))
            hit = taken[cell]
            out[left[hit]] = before[cell[hit]]
            left = left[~hit]
        if self.verified:
            held = out >= 0
            out[held & ((self.a[out] != a) | (self.b[out] != b))] = -1
        return out


def subtree_sums(a, b, up_a, up_b, depth, *values) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys of the rows, and for each the sums of ``values`` over the rows of its subtree.

    ``up_a``/``up_b`` is the parent's key; a parent that no row holds ends the way up.
    """
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    firsts = order[new]
    table = SlotTable(a[firsts], b[firsts])
    slot = table.slots(a, b)
    parent, level = np.full(len(firsts), -1), np.zeros(len(firsts), np.int64)
    own = table.slots(a[firsts], b[firsts])
    parent[own], level[own] = table.slots(up_a[firsts], up_b[firsts]), depth[firsts]
    parent[level == 0] = -1
    sums = []
    for v in values:
        flat = np.zeros(len(firsts), np.int64)
        np.add.at(flat, slot, v)
        sums.append(flat)
    by_depth = np.argsort(-level, kind="stable")
    cuts = np.flatnonzero(np.diff(level[by_depth])) + 1
    for nodes in np.split(by_depth, cuts):  # the deepest first
        nodes = nodes[parent[nodes] >= 0]
        for flat in sums:
            np.add.at(flat, parent[nodes], flat[nodes])
    return table.a, table.b, sums


_SUMS = "a bigint, b bigint, n_leaves bigint, saved bigint"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole paths, the rows of a conversation side by side, as node tables of about ``SHARD_ROWS`` rows."""

    def summed(columns: list[np.ndarray]) -> pa.RecordBatch:
        a, b, (leaves, saved) = subtree_sums(*columns[1:])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(leaves), pa.array(saved)], names=["a", "b", "n_leaves", "saved"])

    held: list[list[np.ndarray]] = []
    rows = 0
    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        rows += len(batch)
        if rows >= SHARD_ROWS:
            columns = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.flatnonzero(columns[0] != columns[0][-1])[-1]) + 1 if columns[0][0] != columns[0][-1] else 0
            if cut:  # the last conversation may go on
                yield summed([c[:cut] for c in columns])
                columns = [c[cut:] for c in columns]
            held, rows = [columns], len(columns[0])
    if rows:
        yield summed([np.concatenate(c) for c in zip(*held)])


# -- ids of the conversations that end at a node ----------------------------------------


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, joined by commas, as rows of about ``PACK_BYTES``."""
    for batch in batches:
        a, b, ids = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if not len(a):
            continue
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        run = np.flatnonzero(new)
        step = PACK_BYTES // 20
        starts = np.concatenate([np.arange(s, e, step) for s, e in zip(run, np.r_[run[1:], len(a)])])
        texts = [",".join(map(str, ids[s:e].tolist())) for s, e in zip(starts, np.r_[starts[1:], len(a)])]
        yield pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.array(b[starts]), pa.array(ids[starts]), pa.array(texts, pa.string())], names=["a", "b", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's packs, which stand side by side in order; one pack is held at a time."""
    node, state = None, None
    for batch in batches:
        done = []
        for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
            if (a, b) != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield _digests(done)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    a, b, d = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.string())], names=["a", "b", "ends"])


# -- the trie -----------------------------------------------------------------------------


def trie(turns: DataFrame, lengths: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """One row for each distinct prefix of the conversations, the empty prefix (the root) included.

    ``turns`` has ``conv_id``, ``pos`` (from 0, without gaps), ``mark`` (bytes that stand for role and
    text) and ``words``; ``lengths`` has each conversation once, those without turns too. Returns
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. Without conversations there are no rows.
    """
    # a, b: the name of the prefix; c: one more hash of its last turn, to tell names apart that collide
    named = materialize(turns.select(
        "conv_id", "pos", "words", *[F.xxhash64(F.lit(seed), "pos", "mark").alias(f"_{x}") for seed, x in enumerate("abc")]), "marks")
    names = running(named, ["conv_id"], ["pos"], {x: ("xor", F.col(f"_{x}")) for x in "ab"}, policy)
    nodes_of = names.join(lengths, "conv_id").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "a", "b", F.col("a").bitwiseXOR(F.col("_a")).alias("up_a"),
        F.col("b").bitwiseXOR(F.col("_b")).alias("up_b"), F.col("_c").alias("c"), "words", "length")
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", *[zero.alias(c) for c in ("depth", "a", "b", "up_a", "up_b", "c", "words")], "length")
    members = materialize(nodes_of.unionByName(roots), "members")

    ends = F.col("depth") == F.col("length")
    told = ["depth", "up_a", "up_b", "c", "words"]
    nodes = members.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(ends).alias("n_ends"),
        F.max(F.when(ends, F.col("conv_id"))).alias("_end"), *[F.max(c).alias(c) for c in told], *[F.min(c).alias(f"_{c}") for c in told])
    same = F.lit(True)
    for c in told:
        same = same & (F.col(c) == F.col(f"_{c}"))
    clash = F.raise_error("two prefixes have one name").cast("long")
    nodes = materialize(nodes.withColumn("depth", F.when(same, F.col("depth")).otherwise(clash)).drop(*[f"_{c}" for c in told]), "nodes")

    # what a node adds to its own subtree, put down at its place on its smallest member's path
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long")
    added = nodes.select("conv_id", "depth", leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    chosen = added.select("conv_id").distinct()
    paths = members.join(chosen, "conv_id", "left_semi").join(added, ["conv_id", "depth"], "left").fillna(0, ["leaf", "saved"])
    flat = ["conv_id", "a", "b", "up_a", "up_b", "depth", "leaf", "saved"]
    short = paths.where(F.col("length") < SHARD_ROWS).select(*flat).repartition("conv_id").sortWithinPartitions("conv_id")
    sums = short.mapInArrow(_shards, _SUMS)
    # a longer path is summed from its end by a scan, which cuts it
    long = paths.where(F.col("length") >= SHARD_ROWS).withColumn("_back", -F.col("depth"))
    long = running(long, ["conv_id"], ["_back"], {"n_leaves": ("sum", F.col("leaf")), "_saved": ("sum", F.col("saved"))}, policy)
    sums = sums.unionByName(long.select("a", "b", "n_leaves", F.col("_saved").alias("saved")))
    sums = sums.groupBy("a", "b").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    children = nodes.where("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("_up"))
    many = members.where(ends).select("a", "b", "conv_id").join(nodes.where("n_ends > 1").select("a", "b"), ["a", "b"], "left_semi")
    packs = many.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInArrow(_packs, "a bigint, b bigint, first bigint, ids string")
    digests = packs.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_hashed, "a bigint, b bigint, ends string")
    alone = F.sha2(F.coalesce(F.col("_end").cast("string"), F.lit("")), 256)
    out = nodes.join(sums, ["a", "b"]).join(children, ["a", "b"], "left").join(digests, ["a", "b"], "left").join(parents, ["up_a", "up_b"], "left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("_up")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends", alone).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """``trie`` of the ``rebuilt`` conversations of a table with ``conv_id``, ``turn``, ``role`` and ``text``.

    Nulls, ties and repeated rows: see ``rebuilt``. A conversation whose own turns are all taken away
    and replaced by none still is a member of the root. An empty table gives no rows. Other columns
    are not looked at.
    """
    turns, lengths = rebuilt(conversations, policy=policy)
    return trie(turns, lengths, policy)
