"""Language-model scores of documents by Brown classes: exchange clustering, then class bigrams.

Words that make up a fixed share of all tokens are units of their own, so that there is a fixed
number of them at most however large the corpus; all other words are pooled by their form (ending and
length) into a fixed number of units. Exchange clustering moves units between classes wherever that raises
the likelihood of the class bigrams. A token's probability is the class transition times the word's
emission from its class, mixed with the plain word frequency. Counts of words and of unit pairs cover
all training texts; counts of words outside the dictionary reach the documents by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.llm.text import LOWER, mix, text_slices, whole_texts, word_hashes, word_spans
from courierflow.session import materialize

#: Share of all tokens from which a word's count lies in the dictionary (at most 1 / share words do) ...
DICTIONARY_SHARE = 1e-6
#: ... and from which it is a unit of its own.
UNIT_SHARE = 1e-5
FORMS, CLASSES, ROUNDS = 1024, 64, 5
#: Added to every word's count.
DELTA = 0.1
#: Weight of the class model against plain frequencies; tokens that the prior of a transition is worth.
CLASS_WEIGHT, PRIOR = 0.8, 1.0
#: Distinct keys a task counts before it sends them on.
TALLY_KEYS = 1 << 21
END = 0  # the unit of the token that ends a text; forms follow, then words


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training; one without an id isn't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and form of each word of a slice, and the index of each text's first word."""
    data = LOWER[data] if len(data) else data
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends).view(np.int64)
    form = np.minimum(ends - starts, 12).astype(np.uint64)
    for back in (1, 2, 3):
        letter = np.where(ends - starts >= back, data[np.maximum(ends - back, 0)] if len(data) else 0, 0)
        form = form * np.uint64(257) + letter.astype(np.uint64)
    return hashes, (mix(form) % np.uint64(FORMS)).astype(np.int32), first


class Tally:
    """Counts of keys, merged now and then; each key has one ``extra`` number."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = self.merged = 0

    def add(self, keys: np.ndarray, extra: np.ndarray | None = None, counts: np.ndarray | None = None) -> None:
        found, at, back = np.unique(keys, return_index=True, return_inverse=True)
        n = np.bincount(back, counts, len(found)).astype(np.int64)
        self.parts.append((found, n, extra[at] if extra is not None else np.zeros(len(found), np.int32)))
        self.size += len(found)

    def full(self) -> bool:
        if self.size > 2 * max(self.merged, TALLY_KEYS // 8):
            keys, n, extra = self.take()
            self.parts, self.size = [(keys, n, extra)], len(keys)
            self.merged = len(keys)
        return self.size >= TALLY_KEYS

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        keys, n, extra = (np.concatenate(x) for x in zip(*self.parts))
        found, at, back = np.unique(keys, return_index=True, return_inverse=True)
        out = found, np.bincount(back, n, len(found)).astype(np.int64), extra[at]
        self.parts, self.size, self.merged = [], 0, 0
        return out


def _batch(keys: np.ndarray, n: np.ndarray, extra: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.array(extra, pa.int32())], names=["k", "n", "form"])


def word_counts(texts: DataFrame) -> DataFrame:
    """``k`` (hash of the word), ``n`` and ``form`` of each distinct word of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                hashes, form, _ = words_of(data, offsets)
                tally.add(hashes, form)
                if tally.full():
                    yield _batch(*tally.take())
        yield _batch(*tally.take())

    return texts.select("text").mapInArrow(run, "k bigint, n bigint, form int").groupBy("k").agg(F.sum("n").alias("n"), F.max("form").alias("form"))


@dataclass(frozen=True)
class Dictionary:
    """Hashes of frequent words, sorted, with the logarithm of their counts and their units."""

    hashes: np.ndarray
    logs: np.ndarray
    units: np.ndarray

    def find(self, hashes: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is held here, its place, and its unit."""
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), 1 + form
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        held = self.hashes[at] == hashes
        return held, at, np.where(held, self.units[at], 1 + form)


def sequence(units: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The units of all texts one after the other, each text followed by an end, and an end before all."""
    out = np.full(len(units) + len(first), END, np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out[np.arange(len(units)) + row + 1] = units
    return out


def pair_counts(texts: DataFrame, words: Dictionary, n_units: int) -> DataFrame:
    """``k`` (a unit times ``n_units`` plus the next unit) and ``n`` over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                hashes, form, first = words_of(data, offsets)
                s = sequence(words.find(hashes, form)[2], first)
                tally.add(s[:-1] * n_units + s[1:])
                if tally.full():
                    yield _batch(*tally.take())
        yield _batch(*tally.take())

    return texts.select("text").mapInArrow(run, "k bigint, n bigint, form int").groupBy("k").agg(F.sum("n").alias("n"))


_CONTEXTS = "u bigint, prev binary, prev_n binary, next binary, next_n binary"


def contexts(pairs: DataFrame, n_units: int) -> DataFrame:
    """One row for each unit: the units before and behind it with their counts, packed.

    A unit has at most as many neighbours as there are units, which is bounded.
    """
    left, right = F.floor(F.col("k") / n_units), F.pmod("k", F.lit(n_units))
    sides = F.array(F.struct(left.alias("u"), F.lit(1).alias("side"), right.alias("v")), F.struct(right.alias("u"), F.lit(0).alias("side"), left.alias("v")))
    rows = pairs.select("n", F.inline(sides)).select("u", "side", "v", "n").repartition("u").sortWithinPartitions("u")

    def packed(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        u, side, v, n = columns
        cuts = np.r_[0, np.flatnonzero(np.diff(u)) + 1, len(u)]
        out = []
        for s, e in zip(cuts[:-1], cuts[1:]):
            before, behind = s + np.flatnonzero(side[s:e] == 0), s + np.flatnonzero(side[s:e] == 1)
            out.append((int(u[s]), *(x.tobytes() for at in (before, behind) for x in (v[at].astype(np.int32), n[at].astype(np.int64)))))
            if len(out) == 64:
                yield made(out)
                out = []
        if out:
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        u, *rest = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), *(pa.array(x, pa.binary()) for x in rest)], names=["u", "prev", "prev_n", "next", "next_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            u = held[-1][0]
            if len(u) and (u[0] != u[-1] or (len(held) > 1 and held[0][0][0] != u[0])):  # the last unit may go on
                columns = [np.concatenate(c) for c in zip(*held)]
                cut = int(np.searchsorted(columns[0], u[-1]))
                yield from packed([c[:cut] for c in columns])
                held = [[c[cut:] for c in columns]]
        if held:
            yield from packed([np.concatenate(c) for c in zip(*held)])

    return rows.mapInArrow(run, _CONTEXTS)


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(between: np.ndarray) -> float:
    """What of the log-likelihood of class bigrams depends on the classes."""
    return float(_phi(between).sum() - _phi(between.sum(axis=1)).sum() - _phi(between.sum(axis=0)).sum())


def best_class(before: np.ndarray, behind: np.ndarray, itself: float, now: int, between: np.ndarray) -> int:
    """The class in which a unit makes class bigrams likeliest, all others staying where they are.

    ``before``/``behind``: the unit's counts with the classes before and behind it, ``itself`` its count
    with itself; all are part of ``between``, with the unit in class ``now``.
    """
    size = behind.sum()
    rest = between.copy()
    rest[:, now] -= before
    rest[now, :] -= behind
    rest[now, now] += itself
    before, behind = before.copy(), behind.copy()
    before[now] -= itself
    behind[now] -= itself
    out, into = rest.sum(axis=1) + before, rest.sum(axis=0) + behind  # of the other units
    p, s = np.flatnonzero(before), np.flatnonzero(behind)
    gain = (_phi(rest[p] + before[p, None]) - _phi(rest[p])).sum(axis=0)
    gain += (_phi(rest[:, s] + behind[s]) - _phi(rest[:, s])).sum(axis=1)
    own = np.diag(rest)  # counted on both sides above, once each
    gain += _phi(own + before + behind + itself) - _phi(own + before) - _phi(own + behind) + _phi(own)
    gain -= _phi(out + size) - _phi(out) + _phi(into + size) - _phi(into)
    best = int(np.argmax(gain))
    return best if gain[best] > gain[now] + 1e-9 * size else now


def _class_pairs(table: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """Counts of class pairs: each task sends one row for each pair it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for batch in batches:
            for u, v, n in zip(*(batch.column(c).to_pylist() for c in ("u", "next", "next_n"))):
                at = classes[u] * k + classes[np.frombuffer(v, np.int32)]
                total += np.bincount(at, np.frombuffer(n, np.int64), k * k).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["at", "n"])

    out = np.zeros(k * k)
    for r in table.select("u", "next", "next_n").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r.at] = r.n
    return out.reshape(k, k)


def _moves(table: DataFrame, classes: np.ndarray, k: int, between: np.ndarray) -> list[tuple[int, int]]:
    """Units of a table, with the classes they should move to."""

    def counted(v: bytes, n: bytes) -> np.ndarray:
        return np.bincount(classes[np.frombuffer(v, np.int32)], np.frombuffer(n, np.int64), k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for u, prev, prev_n, behind, behind_n in zip(*(c.to_pylist() for c in batch.columns)):
                mine = np.frombuffer(behind, np.int32) == u
                itself = float(np.frombuffer(behind_n, np.int64)[mine].sum())
                to = best_class(counted(prev, prev_n), counted(behind, behind_n), itself, int(classes[u]), between)
                if to != classes[u]:
                    found.append((u, to))
            u, to = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(to, pa.int32())], names=["u", "to"])

    return [(r.u, r.to) for r in table.mapInArrow(run, "u bigint, to int").collect()]


def exchange(table: DataFrame, sizes: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """A class for each unit by exchange, and the counts of class pairs.

    Units start in turn by size. In each step a part of the units, half of them at first, is compared
    with all classes, side by side in Spark tasks; they move together. A step that lowers the
    likelihood, as moves made together may, is taken back, and parts are half as large from then on.
    """
    k = min(classes, len(sizes))
    order = np.lexsort((np.arange(len(sizes)), -sizes))
    now = np.empty(len(sizes), np.int64)
    now[order] = np.arange(len(sizes)) % k
    between = _class_pairs(table, now, k)
    score = likelihood(between)
    parts = 2
    for step in range(2 * rounds):
        moves = _moves(table.where(F.pmod(F.xxhash64("u"), F.lit(parts)) == step % parts), now, k, between)
        if not moves:
            continue
        after = now.copy()
        units, to = zip(*moves)
        after[list(units)] = to
        pairs = _class_pairs(table, after, k)
        reached = likelihood(pairs)
        if reached < score:
            parts *= 2
        else:
            now, between, score = after, pairs, reached
    return now, between


@dataclass(frozen=True)
class ClassModel:
    """A fitted model. ``steps`` holds, for each pair of classes, the logarithm that a transition adds
    to a token's; the count of the token's word adds the rest."""

    words: Dictionary
    rare: DataFrame
    classes: np.ndarray
    between: np.ndarray
    steps: np.ndarray
    tokens: int
    distinct: int
    ends: int

    @property
    def base(self) -> float:
        return float(np.log10(self.tokens + DELTA * (self.distinct + 1)))


def fit(documents: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> ClassModel:
    """The model of all rows of ``documents``. Null texts count as empty."""
    texts = whole_texts(documents)
    counts = materialize(word_counts(texts), "word-counts")
    of_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = texts.count()
    tokens, distinct = of_words["n"] + ends, of_words["v"] + (ends > 0)
    frequent = counts.where(F.col("n") >= DICTIONARY_SHARE * tokens).select("k", "n", "form").toArrow()  # at most 1 / share rows
    k, n, form = (frequent.column(c).to_numpy() for c in ("k", "n", "form"))
    order = np.argsort(k)
    k, n, form = k[order], n[order], form[order]
    own = n >= UNIT_SHARE * tokens
    units = np.where(own, FORMS + np.cumsum(own), 1 + form)
    words = Dictionary(k, np.log10(n + DELTA), units)
    n_units = 1 + FORMS + int(own.sum())
    sizes, kinds = np.zeros(n_units), np.zeros(n_units)
    sizes[END], kinds[END] = ends, ends > 0
    sizes[units[own]], kinds[units[own]] = n[own], 1
    pooled = counts.where(F.col("n") < UNIT_SHARE * tokens).groupBy("form").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    for r in pooled.collect():  # at most FORMS rows
        sizes[1 + r.form], kinds[1 + r.form] = r.n, r.v
    table = materialize(contexts(pair_counts(texts, words, n_units), n_units), "contexts")
    found, between = exchange(table, sizes, classes, rounds)
    c = between.shape[0]
    mass, known = np.bincount(found, sizes, c), np.bincount(found, kinds, c)
    prior = mass / tokens if tokens else np.full(c, 1 / c)
    turn = (between + PRIOR * prior) / (between.sum(axis=1, keepdims=True) + PRIOR)
    steps = np.log10(CLASS_WEIGHT * turn / (mass + DELTA * (known + 1)) + (1 - CLASS_WEIGHT) / (tokens + DELTA * (distinct + 1)))
    return ClassModel(words, counts.where(F.col("n") < DICTIONARY_SHARE * tokens).select("k", "n"), found, between, steps, tokens, distinct, ends)


def score(documents: DataFrame, model: ClassModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity`` of each row.

    Null and empty texts have one token, the end. Repeated rows and null ids each give a row.
    """
    texts = whole_texts(documents, "doc_id").withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "text")
    words, steps, classes = model.words, model.steps, model.classes
    end_log, end_known = float(np.log10(model.ends + DELTA)), int(model.ends > 0)
    names = ["row", "doc_id", "k", "times", "n_tokens", "n_known", "logs", "steps"]
    kind = documents.schema["doc_id"].dataType.simpleString()
    made = f"row bigint, doc_id {kind}, k bigint, times bigint, n_tokens bigint, n_known bigint, logs double, steps double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in text_slices(batch.column(2)):
                rows = batch.column(0).to_numpy()[start:stop]
                ids = batch.column(1).slice(start, stop - start)
                hashes, form, first = words_of(data, offsets)
                held, at, units = words.find(hashes, form)
                size = np.diff(first)
                row = np.repeat(np.arange(len(size)), size)
                s = classes[sequence(units, first)]
                added = steps[s[:-1], s[1:]]  # of each text's tokens and its end
                per = lambda x: np.bincount(row, x, len(size))
                logs = per(np.where(held, words.logs[at] if len(words.logs) else 0.0, 0.0)) + end_log
                total = np.bincount(np.repeat(np.arange(len(size)), size + 1), added, len(size))
                known = per(held).astype(np.int64) + end_known
                rare = np.flatnonzero(~held)
                order = rare[np.lexsort((hashes[rare], row[rare]))]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
                one = order[new]
                times = np.diff(np.r_[np.flatnonzero(new), len(order)])
                none, m = np.zeros(len(one), np.int64), len(size)
                # a text's own row travels under a key of its own, and counts no word
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[rows, rows[row[one]]]), pa.concat_arrays([ids, pa.nulls(len(one), ids.type)]),
                    pa.array(np.r_[mix(rows.astype(np.uint64)).view(np.int64), hashes[one]]), pa.array(np.r_[np.zeros(m, np.int64), times]),
                    pa.array(np.r_[size + 1, none]), pa.array(np.r_[known, none]), pa.array(np.r_[logs, none.astype(float)]), pa.array(np.r_[total, none.astype(float)])], names=names)

    parts = texts.mapInArrow(run, made).join(model.rare, "k", "left")
    rare_log = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(DELTA))
    sums = parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("logs") + rare_log).alias("logs"), F.sum("steps").alias("steps"))
    whole = F.col("logs") + F.col("steps")
    return sums.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(model.base)).alias("base_score"), whole.alias("score"),
        F.pow(F.lit(10.0), -whole / F.col("n_tokens")).alias("perplexity"))


def score_documents(documents: DataFrame) -> DataFrame:
    """``score`` of all rows by a model of those that aren't held out (a null id isn't).

    Without training texts the base score is 0 and every token scores alike; an empty table gives no
    rows. Other columns of the table are not looked at.
    """
    return score(documents, fit(documents.where(~held_out())))
