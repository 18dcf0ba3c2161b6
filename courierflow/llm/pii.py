"""Personal data: base formats, and further spans chosen by boosted trees among many candidates.

Generators propose overlapping spans with high recall: long tokens, groups of digits, assigned
values. Trees score each by its format and its surroundings; they learn from the corpus itself, where
validated base spans and values assigned to a secret's name are positive and all other candidates
negative. Candidates above the calibrated threshold that touch no base span are added, the most
probable first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from courierflow.llm.boosted import Calibrated
from courierflow.llm.text import free_name, whole_texts, with_columns

#: Different candidates that the trees learn from at most, the smallest by a hash of their features.
TRAIN_CANDIDATES = 20_000
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "number")
SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("base", BooleanType())]))

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
DIGIT = re.compile("[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{12,}+")
NUMBER = re.compile(r"(?<![A-Za-z0-9])\(?[0-9](?:[ ().-]{0,2}[0-9])*+")
VALUE = re.compile(r"[A-Za-z_]{2,32}+\s{0,3}+[=:]\s{0,3}+[\"']?([^\s\"'|,;]{8,}+)")
SECRET_NAME = re.compile(r"(?i)(token|secret|passw|api.?key|access.?key|auth(?!ors?[^a-z_]))[a-z_]*\s*[=:]\s*[\"']?$")
NAMED = re.compile(r"(?i)(?:token|secret|passw|api.?key|access.?key|auth)[a-z_]{0,32}+\s{0,3}+[=:]")
NAMES = ("token", "key", "secret", "pass", "auth", "phone", "tel", "call", "card", "account", "iban", "id")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """From each ``@`` outwards: what stands before it is met once, however long."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then by kind as listed."""
    found = list(emails(text))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def numbers(text: str) -> Iterator[Span]:
    """Groups of at least seven digits that no letter follows: a run is judged whole, never tried again from within."""
    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= 7 and not (text[m.end() : m.end() + 1].isascii() and text[m.end() : m.end() + 1].isalpha()) and sum(c in "0123456789" for c in m[0]) >= 7:
            yield "number", m.start(), m.end()


def candidates(text: str) -> list[Span]:
    """Proposed spans, which may overlap; without a digit, only what is assigned to a secret's name."""
    if not DIGIT.search(text) and not NAMED.search(text):
        return []
    found = {("secret", m.start(), m.end()) for m in TOKEN.finditer(text) if DIGIT.search(m[0])}
    found |= set(numbers(text))
    found |= {("secret", m.start(1), m.end(1)) for m in VALUE.finditer(text) if DIGIT.search(m[1]) or SECRET_NAME.search(text[max(0, m.start(1) - 40) : m.start(1)])}
    return sorted(found, key=lambda s: (s[1], s[2], s[0]))


def features(text: str, span: Span) -> list[float]:
    """Format of a span and of the characters around it."""
    kind, start, end = span
    s, before, after = text[start:end], text[max(0, start - 32) : start], text[end : end + 2]
    n, head = len(s), s[:256]
    digits = sum(c in "0123456789" for c in head)
    hexes, uppers = (sum(c in chars for c in head) for chars in ("0123456789abcdefABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    changes = sum((a in "0123456789") != (b in "0123456789") for a, b in zip(head, head[1:]))
    low, only = before.lower(), "".join(c for c in head if c in "0123456789")
    return [
        float(kind == "secret"), n, digits, digits / len(head), hexes / len(head), uppers / len(head), len(set(head)) / min(len(head), 40), changes / len(head),
        s.count(" "), s.count("-"), s.count("."), float(luhn(only)), float(before[-1:] in ('"', "'")), float(before[-1:] == "+"), float(before[-1:].isspace()),
        float(after[:1] in ('"', "'")), float(bool(re.search(r"[=:]\s*[\"']?$", before))), float(sum(x in low for x in NAMES)), float(bool(SECRET_NAME.search(before))),
    ]


def taught(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and label of each candidate of a text."""
    base = {s[1:] for s in base_spans(text)}
    for span in candidates(text):
        secret = bool(SECRET_NAME.search(text[max(0, span[1] - 40) : span[1]])) and span[2] - span[1] >= 16
        yield features(text, span), int(span[1:] in base or secret)


def fit(documents: DataFrame, rows: int = TRAIN_CANDIDATES) -> Calibrated:
    """Trees of at most ``rows`` different feature vectors of candidates, each with its count and its share of positive ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [p for text in batch.column(0).to_pylist() for p in taught(text)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.list_(pa.float64())), pa.array([p[1] for p in pairs], pa.int32())], names=["x", "y"])

    pairs = whole_texts(documents).mapInArrow(run, "x array<double>, y int")
    counted = pairs.groupBy("x").agg(F.avg("y").alias("y"), F.count("*").cast("double").alias("n"))
    sample = counted.orderBy(F.xxhash64("x"), "x").limit(rows).toPandas()
    if not len(sample):
        return Calibrated(np.zeros((0, 1)), np.zeros(0))
    return Calibrated(np.stack(sample["x"].to_list()), sample["y"].to_numpy(float), sample["n"].to_numpy(float))


def all_spans(text: str, model: Calibrated) -> list[tuple[str, int, int, bool]]:
    """Base and added spans, by start and kind; added ones touch no other span."""
    base = base_spans(text)
    spans = [(*s, True) for s in base]
    if proposed := candidates(text):
        p = model.probability(np.array([features(text, s) for s in proposed]))
        taken = sorted((s[1], s[2]) for s in base)
        chosen: list[Span] = []
        ends: list[tuple[int, int]] = list(taken)
        for k in sorted(np.flatnonzero(p >= model.threshold).tolist(), key=lambda k: (-p[k], proposed[k][1] - proposed[k][2], proposed[k][1])):
            chosen.append(proposed[k])
        spans += [(*s, False) for s in apart(chosen, ends)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def apart(chosen: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """The spans, in their order, that overlap none taken before."""
    from bisect import bisect_left, insort

    out, ends = [], []
    for start, end in taken:  # base spans may overlap each other; joined ones don't
        if ends and start < ends[-1][1]:
            ends[-1] = (ends[-1][0], max(end, ends[-1][1]))
        else:
            ends.append((start, end))
    for s in chosen:
        k = bisect_left(ends, (s[1], s[2]))
        if (k == 0 or ends[k - 1][1] <= s[1]) and (k == len(ends) or s[2] <= ends[k][0]):
            insort(ends, (s[1], s[2]))
            out.append(s)
    return out


def find(documents: DataFrame, model: Calibrated, text: str = "text", spans: str = "spans") -> DataFrame:
    """``documents`` with an array of spans: kind, code-point start and end, whether it is a base one.

    Null and empty texts have no spans; very long runs of one character class cost linear time; a
    column named like ``spans`` is replaced, all others stay.
    """
    names = [f.name for f in SPANS.elementType]

    def run(texts: pa.Array) -> list[pa.Array]:
        rows = [[dict(zip(names, s)) for s in all_spans(t, model)] for t in texts.to_pylist()]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        return [pa.array(rows, kind)]

    return with_columns(documents, StructType([StructField(spans, SPANS)]), run, text)


def redacted(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each span, joined where they overlap, replaced by its kind in brackets."""
    out, end = [], 0
    for kind, start, stop, _ in spans:
        if start >= end:
            out += [text[end:start], f"[{kind}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def redact(documents: DataFrame, model: Calibrated) -> DataFrame:
    """``documents`` with all spans of ``text`` replaced; a null text becomes an empty one."""
    order, raw = documents.columns, free_name(documents, "_raw")
    new = StructType([StructField("text", StringType())])
    source = documents.withColumn(raw, F.col("text"))
    return with_columns(source, new, lambda texts: [pa.array([redacted(t, all_spans(t, model)) for t in texts.to_pylist()], pa.string())], raw).select(*order)
