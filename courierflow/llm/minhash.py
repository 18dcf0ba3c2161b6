"""Near-duplicate documents: fast similarity sketches, banding, and verification on full sets.

A sketch throws all shingles of a document into ``COORDINATES`` bins, round after round with fresh
hashes, until each bin holds a value; the round is part of the value, so earlier rounds win. The
last rounds fill one named bin each, so every coordinate fills. Sketches that agree on all rows of
a band make a candidate link. Candidate components are cut into slices of bounded size, in members
and in shingles, and each slice compares the full sets of its members, range by range of hashes.
Components of several slices are sliced anew until their members meet, and what is still apart is
compared block by block, so no link is lost and no pairs are written out, only a spanning forest of
the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.llm.text import LOWER, SMALL_SLICE, free_name, mix, run_hashes, text_slices, whole_texts, windows, word_hashes, word_spans
from courierflow.session import materialize

SHINGLE, PERCENT = 5, 75
COORDINATES, BAND_ROWS = 128, 4
#: Members of a slice, and shingles of all of them (8 bytes each): what one task holds.
SLICE, SLICE_SHINGLES = 1024, 1 << 21
#: Shingles compared at once, and cells of the dense block that counts them.
PIECE, CELLS = 1 << 20, 1 << 22
RESLICES = 2
#: Ids from here on stand for sets of documents without an id.
NO_ID = 1 << 62
SETS = "c long, comp long, slices int, shingles binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending in each row, and where each row's begin.

    A row with fewer than ``SHINGLE`` words has its whole sequence as its one shingle.
    """
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    at = windows(first, SHINGLE)
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHINGLE))
    values = np.r_[run_hashes(hashes, at, at + SHINGLE), run_hashes(hashes, first[short], first[short + 1])]
    row = np.r_[np.searchsorted(first, at, "right") - 1, short]
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.r_[True, (np.diff(row) != 0) | (np.diff(values) > 0)][: len(row)]
    values, row = values[new], row[new]
    return values, np.searchsorted(row, np.arange(len(offsets)))


def sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``COORDINATES`` 16-bit coordinates of each row's set; rows without shingles stay zero."""
    rows, t = len(first) - 1, COORDINATES
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((rows, t), empty, np.uint64)
    sizes = np.diff(first)
    open_rows = np.flatnonzero(sizes > 0)
    for i in range(2 * t):
        if not len(open_rows):
            break
        n = sizes[open_rows]
        element = np.repeat(first[open_rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
        row = np.repeat(open_rows, n)
        h = mix(values[element] ^ mix(np.uint64([i + 1]))[0])
        bins = (h % np.uint64(t)).astype(np.int64) if i < t else np.full(len(h), i - t)
        value = (np.uint64(i) << np.uint64(48)) | (mix(h) >> np.uint64(16))
        np.minimum.at(out.reshape(-1), row * t + bins, value)
        open_rows = open_rows[(out[open_rows] == empty).any(axis=1)]
    coordinates = (mix(out) >> np.uint64(48)).astype("<u2")
    coordinates[sizes == 0] = 0
    return coordinates


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id``, set size, 128-bit identity of the set, a hash of the text and the sketch of each row."""
    names = ["doc_id", "print", "n", "ha", "hb", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, data, offsets in text_slices(batch.column(2), SMALL_SLICE):
                values, first = shingle_sets(data, offsets)
                made = sketches(values, first)
                whole = [run_hashes(values, first[:-1], first[1:], k).view(np.int64) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x, y - x), batch.column(1).slice(x, y - x), pa.array(np.diff(first)), *map(pa.array, whole), pa.array([s.tobytes() for s in made], pa.binary())], names=names)

    return docs.select("doc_id", F.xxhash64("text").alias("print"), "text").mapInArrow(run, "doc_id long, print long, n long, ha long, hb long, sketch binary")


def band_keys(sketch: F.Column) -> F.Column:
    width = 2 * BAND_ROWS
    return F.array(*[F.xxhash64(F.substring(sketch, 1 + width * k, width), F.lit(k)) for k in range(COORDINATES // BAND_ROWS)])


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``comp``, the smallest id of its component, of each end of an edge (``a``, ``b``).

    Each round takes the smallest label around and then the label's own label; rounds are written
    tables, and their number grows with the logarithm of a component's width.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("comp")), "labels")
    while True:
        around = both.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near"))
        nearer = labels.join(around, "id").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        nearer = materialize(nearer, "nearer")
        jump = nearer.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        after = materialize(nearer.join(jump, "comp").select("id", "old", F.least("comp", "next").alias("comp")), "labels")
        labels = after.select("id", "comp")
        if not after.where("comp <> old").limit(1).count():
            return labels


def in_common(values: list[np.ndarray], left: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with all sets."""
    n = len(values)
    owner, flat = np.repeat(np.arange(n, dtype=np.int32), [len(v) for v in values]), np.concatenate(values)
    by = np.argsort(flat, kind="stable")
    owner, flat = owner[by], flat[by]
    column = np.cumsum(np.r_[False, flat[1:] != flat[:-1]][: len(flat)])
    shared = np.bincount(column) > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    common = np.zeros((len(left), n), np.float32)
    step = max(256, CELLS // n)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        i, j = np.searchsorted(column, [low, low + step])
        block = np.zeros((n, step), np.float32)
        block[owner[i:j], column[i:j] - low] = 1
        common += (block if len(left) == n else block[left]) @ block.T
    return common


def linked(values: list[np.ndarray], sizes: np.ndarray, left: np.ndarray | None = None, piece: int = PIECE) -> np.ndarray:
    """Whether each pair of sets is a link, from exact intersections; rows ``left`` against all.

    Sets are ascending, so equal ranges of hashes are cut from all of them and counted one after
    the other: beside the sets themselves, memory holds about ``piece`` shingles, however long a set.
    """
    left = np.arange(len(values)) if left is None else left
    pieces = -(-int(sizes.sum()) // piece)
    bounds = np.array([k * 2**64 // pieces for k in range(1, pieces)], np.uint64)
    cuts = [np.r_[0, np.searchsorted(v, bounds), len(v)] for v in values]
    common = np.zeros((len(left), len(values)), np.int64)
    for k in range(pieces):
        common += np.rint(in_common([v[c[k] : c[k + 1]] for v, c in zip(values, cuts)], left)).astype(np.int64)
    return 100 * common >= PERCENT * (sizes[left][:, None] + sizes[None, :] - common)


def forest(ids: np.ndarray, link: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the links join."""
    parent = np.arange(len(ids))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for k, i in enumerate(rows.tolist()):
        for j in np.flatnonzero(link[k]).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(ids[j])))
    return out


def compare(group: pa.Table) -> pa.Table:
    """Links within one slice: all its members, or its strangers (``side`` 1) against all."""
    sets: dict[tuple[int, int], list[np.ndarray]] = {}
    for c, side, shingles in zip(*(group.column(name) for name in ("c", "side", "shingles"))):
        value = np.frombuffer(shingles.as_buffer(), np.uint64)  # no copy
        known = sets.setdefault((c.as_py(), side.as_py()), [])
        if not any(np.array_equal(value, v) for v in known):  # repeated rows once; one id may have several sets
            known.append(value)
    ids, side, values = (list(x) for x in zip(*((c, at, v) for (c, at), many in sets.items() for v in many)))
    edges = []
    if len(ids) > 1:
        sizes = np.array([len(v) for v in values])
        mine = np.flatnonzero(np.array(side) == 1) if 1 in side else np.arange(len(ids))
        edges = [e for e in forest(np.array(ids), linked(values, sizes, mine), mine) if e[0] != e[1]]
    a, b = zip(*edges) if edges else ((), ())
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def sets_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Full shingle sets of the classes (``c``, ``comp``, ``slices``), each from the text of one document."""
    need = classes.select("c", "comp", "slices", "rep", F.col("print").alias("of"))
    text = docs.withColumn("print", F.xxhash64("text"))
    # one plan at every size: texts are dealt out by their hash
    rows = text.join(need.hint("merge"), (text["print"] == need["of"]) & text["doc_id"].eqNullSafe(need["rep"])).select("c", "comp", "slices", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, data, offsets in text_slices(batch.column(3), SMALL_SLICE):
                values, first = shingle_sets(data, offsets)
                sets = [values[a:b].tobytes() for a, b in zip(first, first[1:])]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(x, y - x) for k in range(3)), pa.array(sets, pa.binary())], names=["c", "comp", "slices", "shingles"])

    return rows.mapInArrow(run, SETS)


def verify(placed: DataFrame) -> DataFrame:
    """Links among the sets of each ``(comp, slice)``: all with all, or those of ``side`` 1 with all."""
    return placed.select("c", "comp", "slice", "side", "shingles").groupBy("comp", "slice").applyInArrow(compare, "a long, b long")


def near_duplicates(documents: DataFrame, slice_size: int = SLICE, slice_shingles: int = SLICE_SHINGLES) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` and ``print``, a hash of the text, of each row.

    Rows of one ``doc_id`` are one document. Null and empty texts, and texts without words, have no
    shingles and are linked with nothing. A document without an id joins its component but never
    names it: it has the smallest id there, or none, and is kept only where no id is. An empty
    table gives no rows.
    """
    docs = whole_texts(documents, F.col("doc_id").cast("long").alias("doc_id"))
    table = materialize(sketched(docs), "sketches")
    named = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "print"))
    classes = table.where("n > 0").groupBy("ha", "hb").agg(named.alias("r"), F.first("sketch").alias("sketch"), F.first("n").alias("n"))
    number = F.coalesce("r.doc_id", F.col("ha").bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID))
    classes = materialize(classes.select("ha", "hb", number.alias("c"), F.col("r.doc_id").alias("rep"), F.col("r.print").alias("print"), "sketch", "n"), "classes")

    buckets = classes.select("c", F.explode(band_keys(F.col("sketch"))).alias("key"))
    heads = buckets.groupBy("key").agg(F.min("c").alias("head"), F.max("c").alias("tail")).where("head < tail")
    led = buckets.join(heads.select("key", "head").hint("merge"), "key").where("c <> head").groupBy("c").agg(F.collect_set("head").alias("heads"))
    # a class and all its heads hang on the least head: one edge a class, and few among heads
    stars = led.select(F.array_min("heads").alias("b"), F.explode(F.array_union("heads", F.array("c"))).alias("a")).where("a <> b").select("a", "b").distinct()
    # rows of one id are one document: their sets are linked at once
    candidates = materialize(components(materialize(stars, "stars")), "candidates")
    weighed = candidates.join(classes.groupBy("c").agg(F.sum("n").alias("weight")), candidates["id"] == F.col("c"))
    parts = F.greatest(F.ceil(F.count("*") / slice_size), F.ceil(F.sum("weight") / slice_shingles)).cast("int")
    sizes = weighed.groupBy("comp").agg(parts.alias("slices"))
    members = materialize(weighed.join(sizes, "comp").select("c", "comp", "slices", "weight"), "members")
    sets = materialize(sets_of(docs, classes.join(members.drop("weight"), "c")), "sets")

    def sliced(rows: DataFrame, seed: int) -> DataFrame:
        at = F.pmod(F.xxhash64("c", F.lit(seed)), F.col("slices")).cast("int")
        return rows.withColumns({"slice": at, "side": F.lit(0)})

    links = materialize(verify(sliced(sets, 0)), "links")
    large = sets.where("slices > 1")
    if large.limit(1).count():
        for seed in range(1, RESLICES + 1):
            links = materialize(links.union(verify(sliced(large, seed))), "links")
        cells = strangers(members.where("slices > 1"), components(links), slice_size, slice_shingles)
        links = materialize(links.union(verify(large.select("c", "shingles").join(cells, "c"))), "links")
    labels = components(links)

    marked = table.join(classes.select("ha", "hb", "c", "rep", F.col("print").alias("of")), ["ha", "hb"], "left").join(labels.withColumnRenamed("id", "c"), "c", "left")
    alone, label = F.col("n") == 0, F.coalesce("comp", "c")
    component = F.when(alone, F.col("doc_id")).when(label < NO_ID, label)
    nameless = F.col("doc_id").isNull() & (alone | ((label >= NO_ID) & (label == F.col("c")) & (F.col("print") == F.col("of"))))
    marked = marked.select("doc_id", "print", F.col("n").alias("n_shingles"), component.alias("component_id"), nameless.alias("nameless"))
    return marked.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), "nameless")).drop("nameless")


def survivors(documents: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns; repeated rows once."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-NO_ID))
    found = near_duplicates(documents).where("kept")
    of_row, print_, size, row = (free_name(documents, c) for c in ("_key", "_print", "_n", "_row"))
    kept = found.groupBy(key.alias(of_row), F.col("print").alias(print_)).agg(F.max("n_shingles").alias(size))
    rows = documents.withColumns({of_row: key, print_: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    rows = rows.join(kept, [of_row, print_]).withColumn(row, F.when(F.col(size) == 0, F.monotonically_increasing_id()))
    return rows.dropDuplicates([of_row, print_, row]).select(*documents.columns)


def strangers(large: DataFrame, labels: DataFrame, slice_size: int, slice_shingles: int) -> DataFrame:
    """Slices in which every member outside its candidate component's largest part meets all members."""
    part = large.join(labels.withColumnRenamed("comp", "part"), large["c"] == labels["id"], "left").select("c", "comp", "slices", "weight", F.coalesce("part", "c").alias("part"))
    part = materialize(part, "parts")
    largest = part.groupBy("comp", "part").agg(F.count("*").alias("n")).groupBy("comp").agg(F.max(F.struct("n", "part")).alias("top")).select("comp", F.col("top.part").alias("top"), "top.n")
    part = part.join(largest, "comp")
    apart = part.where("part <> top")
    blocks = F.greatest(F.ceil(F.count("*") / slice_size), F.ceil(F.sum("weight") / slice_shingles)).cast("int")
    rest = apart.groupBy("comp").agg(blocks.alias("blocks"))
    # block i of the strangers meets slice j of all members in the cell i * slices + j
    rows = apart.join(rest, "comp").withColumn("block", F.pmod(F.xxhash64("c", F.lit(91)), F.col("blocks")).cast("int"))
    cell = lambda block, at: (block * F.col("slices") + at).cast("int").alias("slice")
    ours = rows.select("c", "comp", "block", "slices", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("at")).select("c", "comp", cell(F.col("block"), F.col("at")), F.lit(1).alias("side"))
    theirs = part.join(rest, "comp").withColumn("at", F.pmod(F.xxhash64("c", F.lit(92)), F.col("slices")).cast("int"))
    theirs = theirs.select("c", "comp", "slices", "at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).select("c", "comp", cell(F.col("block"), F.col("at")), F.lit(0).alias("side"))
    return ours.union(theirs)
