"""License scans: an exact set-similarity join of text blocks with license templates.

A template meets a block if the block holds at least ``CONTAINMENT`` of its distinct words. Words
are ordered by how often they stand in the corpus, rarest first; a block that meets a template
holds one of its first words (prefix filter), has enough words (length filter), and enough of the
template must follow the first word found (positional filter). Only such pairs are counted out.

Blocks are ``BLOCK`` words long, or the power of two times that holds a template of so many words
twice, and start every half block: each stretch of a template's length lies whole in one. Templates
are found by an inverted index of their prefixes and travel with the tasks: they are a parameter of
the size of a list of licenses, not of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.llm.text import LOWER, NOT_ALNUM, text_slices, whole_texts, word_hashes, word_spans

CONTAINMENT, BLOCK = 0.8, 48
# Phrases that stand for a license, and openings of license texts.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEMPLATES = [
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "it under the terms of the gnu general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "you may not use this file except in compliance with the apache license"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike license"),
]


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts and the index of each text's first word."""
    raw = [t.encode() for t in texts]
    data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    starts, ends, first = word_spans(data, np.cumsum([0, *map(len, raw)]), NOT_ALNUM)
    return word_hashes(data, starts, ends), first


def block_of(n: int) -> int:
    """Length of the blocks that templates of ``n`` words are sought in: twice as long at least."""
    size = BLOCK
    while size < 2 * n:
        size *= 2
    return size


@dataclass
class Template:
    label: str
    ordered: np.ndarray  # word numbers, rarest first
    need: int
    block: int

    @property
    def prefix(self) -> np.ndarray:
        return self.ordered[: len(self.ordered) - self.need + 1]


class Templates:
    """The vocabulary of the templates, ordered by corpus counts once these are known."""

    def __init__(self, templates: list[tuple[str, str]], containment: float):
        hashes, first = words([t for _, t in templates])
        self.vocabulary = np.unique(hashes)
        self.sets = [(label, np.unique(np.searchsorted(self.vocabulary, hashes[a:b])), block_of(b - a)) for (label, _), a, b in zip(templates, first, first[1:])]
        self.containment = containment
        self.order(np.zeros(len(self.vocabulary)))

    def order(self, counts: np.ndarray) -> None:
        self.rank = np.empty(len(counts), np.int64)
        self.rank[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
        self.templates = [Template(label, s[np.argsort(self.rank[s])], math.ceil(self.containment * len(s) - 1e-9), block) for label, s, block in self.sets if len(s)]
        self.in_prefix = np.zeros(len(counts), bool)
        self.index: dict[int, dict[int, list[tuple[int, int]]]] = {}  # block length, prefix word: templates and the word's position
        for k, t in enumerate(self.templates):
            self.in_prefix[t.prefix] = True
            for at, word in enumerate(t.prefix.tolist()):
                self.index.setdefault(t.block, {}).setdefault(word, []).append((k, at))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, -1 for other words."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def meet(self, numbers: np.ndarray) -> dict[str, float]:
        """Labels of the templates that some block of one text meets, with the largest containment."""
        found: dict[str, float] = {}
        hits = np.flatnonzero((numbers >= 0) & self.in_prefix[numbers])
        for size, index in self.index.items():
            half = size // 2
            for block in np.unique(np.r_[hits // half, hits // half - 1]):
                if block < 0:
                    continue
                here = numbers[block * half : block * half + size]
                held = np.unique(here[here >= 0])
                first: dict[int, int] = {}  # templates whose prefix is hit, and where
                for word in held[self.in_prefix[held]].tolist():
                    for k, at in index.get(word, ()):
                        first[k] = min(at, first.get(k, at))
                for k, at in first.items():
                    t = self.templates[k]
                    if len(held) < t.need or len(t.ordered) - at < t.need:
                        continue
                    n = int(np.isin(t.ordered[at:], held).sum())
                    if n >= t.need:
                        found[t.label] = max(found.get(t.label, 0.0), n / len(t.ordered))
        return found


def corpus_counts(documents: DataFrame, templates: Templates) -> np.ndarray:
    """How often each word of the templates stands in all documents: one row a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(templates.vocabulary), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                data = LOWER[data]
                starts, ends, _ = word_spans(data, offsets, NOT_ALNUM)
                numbers = templates.number(word_hashes(data, starts, ends))
                total += np.bincount(numbers[numbers >= 0], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "n"])

    out = np.zeros(len(templates.vocabulary))
    for row in whole_texts(documents).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect():
        out[row.word] = row.n
    return out


def scan(documents: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """``doc_id``, word and phrase counts, places and labels of each document row.

    Null and empty texts have no words, no labels and the score 0; repeated rows get equal results;
    an empty table gives no rows. ``score`` is 1 with a base phrase, else the largest containment of
    a template that a block meets.
    """
    known = Templates(templates, containment)
    known.order(corpus_counts(documents, known))
    phrase_hashes, first = words(list(phrases))
    sought = [(phrase_hashes[a:b], label) for a, b, label in zip(first, first[1:], phrases.values())]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    schema = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                data = LOWER[data]
                starts, ends, first = word_spans(data, offsets, NOT_ALNUM)
                hashes = word_hashes(data, starts, ends)
                row_of = np.repeat(np.arange(b - a), np.diff(first))
                n_base, low, high = np.zeros(b - a, np.int64), np.full(b - a, np.iinfo(np.int64).max), np.full(b - a, -1)
                labels: dict[int, set[str]] = {}
                for phrase, label in sought:
                    at = places(hashes, row_of, phrase)
                    rows = row_of[at]
                    np.add.at(n_base, rows, 1)
                    np.minimum.at(low, rows, at - first[rows])
                    np.maximum.at(high, rows, at - first[rows])
                    for r in np.unique(rows).tolist():
                        labels.setdefault(r, set()).add(label)
                numbers = known.number(hashes)
                met: dict[int, dict[str, float]] = {}
                hit = (numbers >= 0) & known.in_prefix[numbers] if len(known.vocabulary) else np.zeros(0, int)
                for r in np.unique(row_of[np.flatnonzero(hit)]).tolist():
                    if got := known.meet(numbers[first[r] : first[r + 1]]):
                        met[r] = got
                text = lambda s: ",".join(sorted(s))
                rows = range(b - a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(first)), pa.array(n_base), pa.array(low, mask=n_base == 0), pa.array(high, mask=n_base == 0),
                     pa.array([text(labels.get(r, ())) for r in rows], pa.string()), pa.array([text({*labels.get(r, ()), *met.get(r, ())}) for r in rows], pa.string()),
                     pa.array([1.0 if r in labels else max(met.get(r, {"": 0.0}).values()) for r in rows], pa.float64())], names=names)

    return whole_texts(documents, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, schema)


def places(hashes: np.ndarray, row_of: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Index of each word at which the phrase begins within one row."""
    n = len(phrase)
    at = np.flatnonzero(hashes[: max(0, len(hashes) - n + 1)] == phrase[0])
    at = at[row_of[at] == row_of[at + n - 1]]
    for k in range(1, n):
        at = at[hashes[at + k] == phrase[k]]
    return at
