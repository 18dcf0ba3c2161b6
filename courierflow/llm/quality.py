"""Document quality by pairwise ranking: a Bradley-Terry model over features of whole texts.

A pair prefers a document labelled 1 to one labelled 0. Logistic loss on the difference of their
features gives one weight a feature; a document's strength is its weighted sum. The cut is a
quantile of the strengths of labelled documents, and the score is the logistic of the strength,
shifted so that the cut has the score ``CUT_SCORE``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from courierflow.llm.text import SMALL_SLICE, free_name, text_slices, whole_texts, with_columns, word_hashes, word_spans
from courierflow.session import materialize

CUT_SCORE = 0.3
#: Labelled rows that the model is fitted on at most, the smallest by a hash of their features.
TRAIN_ROWS = 20_000
PAIRS_EACH = 8
_b = np.arange(256)
CLASSES = [
    _b == ord("|"), (_b == ord("!")) | (_b == ord("?")), np.isin(_b, list(b"#*$%&<>~^=_@\\/")), (_b >= 65) & (_b <= 90),
    (_b >= 48) & (_b <= 57), (_b >= 97) & (_b <= 122), np.isin(_b, list(b".,;:")), _b == 10, _b >= 128, np.isin(_b, list(b"\"'()[]{}")),
]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features for each text: shares of kinds of characters, words and repeats."""
    rows = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    words = np.diff(first)
    row = np.repeat(np.arange(rows), words)
    length, n = np.diff(offsets).astype(float), np.maximum(words, 1).astype(float)
    total = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][offsets])
    shares = [np.minimum(total(c[data]) / np.maximum(length, 1), 1) for c in CLASSES]
    h = word_hashes(data, starts, ends)
    size = (ends - starts).astype(float)
    per = lambda x: np.bincount(row, x, rows) / n
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    lone = (size == 1) & ~((data[starts] | 32 >= 97) & (data[starts] | 32 <= 122)) if len(h) else np.zeros(0, bool)
    distinct = np.bincount(row[order][new], minlength=rows) / n
    spread = np.log1p(words)
    columns = [*shares, spread, spread < np.log(6), spread < np.log(30), per(size) / 10, np.minimum(per(size * size) / 100, 10), per(again), per(lone), distinct, distinct * spread,
               *[np.sqrt(s) for s in shares[:5]], np.sqrt(per(again))]
    return np.stack([np.asarray(c, float) for c in columns], axis=1).round(6)


def featured(documents: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``features`` of each whole text; a null text counts as empty."""
    df = whole_texts(documents, *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1])
    names = [*df.columns[:-1], "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(data, offsets) for _, _, data, offsets in text_slices(batch.column(len(names) - 1), SMALL_SLICE)]
            rows = np.concatenate(made) if made else np.zeros((0, 1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=names)

    return df.mapInArrow(run, f"{kinds}, features array<double>")


class Ranking:
    """Weights of a fitted model; ``score`` maps rows of features to 0..1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        self.mean, self.scale = x.mean(axis=0) if len(x) else 0.0, (x.std(axis=0) if len(x) else 0.0) + 1e-3
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        self.weights, self.cut = np.zeros(x.shape[1]), 0.0
        if not len(good) or not len(bad):
            return
        z, random = (x - self.mean) / self.scale, np.random.default_rng(seed)
        each = PAIRS_EACH * max(1, len(good) // len(bad))
        losers = np.repeat(bad, each)
        d = z[random.choice(good, len(losers))] - z[losers]
        for _ in range(25):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(d @ self.weights, -30, 30)))
            gradient = d.T @ (1 - p) / len(d) - 1e-3 * self.weights
            hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(d.shape[1])
            self.weights = self.weights + np.linalg.solve(hessian, gradient)
        strength = np.sort(z @ self.weights)
        # the quantile of all strengths that parts the labels best, each label weighing half
        s = z @ self.weights
        at = np.quantile(strength, np.linspace(0, 1, 401))
        right = [(s[good] >= t).mean() + (s[bad] < t).mean() for t in at]
        self.cut = float(at[int(np.argmax(right))])

    def score(self, x: np.ndarray) -> np.ndarray:
        s = (x - self.mean) / self.scale @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(s + np.log(CUT_SCORE / (1 - CUT_SCORE)), -30, 30)))


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Ranking:
    """The model of rows with ``features`` and ``quality`` (0 or 1; others are left out)."""
    sample = labelled.where(F.col("quality").isin(0, 1)).orderBy(F.xxhash64("features"), "quality").limit(rows).select("features", "quality").toPandas()
    width = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    x = np.stack(sample["features"].to_list()) if len(sample) else np.zeros((0, width))
    return Ranking(x, sample["quality"].to_numpy())


def scored(rows: DataFrame, model: Ranking) -> DataFrame:
    """``rows`` with ``score`` in place of ``features``."""
    kept = rows.select(*[c for c in rows.columns if c not in ("features", "score")], "features")
    names = [*kept.columns[:-1], "score"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack(batch.column(len(names) - 1).to_numpy(zero_copy_only=False)) if len(batch) else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.score(x) if len(x) else [], pa.float64())], names=names)

    return kept.mapInArrow(run, f"{kinds}, score double")


def held_out(doc_id: str = "doc_id"):
    """Whether a document's label is kept from the model."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def rank_documents(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each document row.

    Only labels whose ``doc_id`` is not held out are learned, from at most ``rows`` of them. Null
    and empty texts are scored like any other; a null id is not held out; repeated rows get equal
    scores; without labels of both kinds every score is ``CUT_SCORE``.
    """
    table = materialize(featured(documents, "doc_id"), "features")
    train = labels.where(~held_out()).select("doc_id", "quality").distinct().join(table, "doc_id")
    model = fit(train, rows)
    return scored(table, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``documents`` that score ``CUT_SCORE`` or more, by a model of their own labels."""
    train = labels.where(~held_out()).select("doc_id", "quality").distinct()
    model = fit(train.join(featured(documents, "doc_id"), "doc_id"), rows)

    def score(texts: pa.Array) -> list[pa.Array]:
        made = [model.score(features(data, offsets)) for _, _, data, offsets in text_slices(texts, SMALL_SLICE)]
        return [pa.array(np.concatenate(made) if made else [], pa.float64())]

    name = free_name(documents, "_score")
    scored_rows = with_columns(documents, StructType([StructField(name, DoubleType())]), score)
    return scored_rows.where(F.col(name) >= CUT_SCORE).select(*documents.columns)
