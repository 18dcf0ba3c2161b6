"""Whitening, the prefix trie and class n-grams against plain versions of themselves."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from courierflow.llm import class_ngrams, prefix_trie, whitening
from courierflow.llm.queries import with_package
from courierflow.operators.skew import SkewPolicy
from corpus import documents, texts

WORD = r"[^\x20\x09-\x0D]+"

# -- whitening -------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, x int, d string, whitened double, deviation long"


def vectors(spark, rows):
    cast = [(i, v if v is None else [x if x is None else float(x) for x in v]) for i, v in rows]
    return with_package(spark).createDataFrame([(i, v, 1, "d", 0.5, 2) for i, v in cast], VECTORS)


def awkward_vectors():
    r = np.random.default_rng(3)
    mixing = r.normal(size=(6, 6)) * np.array([3, 2, 1.5, 1, 0.5, 0.2])
    good = [(k, (r.normal(size=6) @ mixing).tolist()) for k in range(60)]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (102, [float("nan")] * 6), (103, [float("inf"), 0, 0, 0, 0, 0]), (104, []),
           (105, [1.0, 2.0]), (106, [1e30, 0, 0, 0, 0, 0]), (None, good[0][1]), (0, good[0][1]), (107, good[1][1])]
    return good, good + odd


def test_whitening_of_awkward_rows(spark):
    good, rows = awkward_vectors()
    kept = [(i, v) for i, v in rows if v and len(v) == 6 and None not in v and np.isfinite(v).all() and max(v) < 1e20]
    x = np.floor(64 * np.array([v for _, v in kept], np.float32).astype(float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov((fit - 1_000_000).T.astype(float), bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    want = np.abs((x - total / n) @ axes / np.sqrt(values))
    got = defaultdict(list)
    for r in whitening.whitened(vectors(spark, rows), components=16).collect():
        assert r.n == n and abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12 and r.identity_error < 1e-9
        got[r.component].append((str(r.vec_id), r.deviation, abs(r.whitened)))
    assert sorted(got) == list(range(1, 7))
    for c, found in got.items():
        wanted = sorted((str(i), int(d), w) for (i, _), d, w in zip(kept, ((n * x - total) ** 2).sum(axis=1), want[:, c - 1]))
        assert [f[:2] for f in sorted(found)] == [w[:2] for w in wanted]
        assert np.allclose([f[2] for f in sorted(found)], [w[2] for w in wanted], atol=1e-8)


def test_whitening_with_equal_eigenvalues_and_low_rank(spark):
    axes = np.eye(5)[:4] * 2
    rows = list(enumerate([*axes.tolist(), *(-axes).tolist()]))  # four equal eigenvalues and one of 0
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and all(abs(r.explained - 0.25) < 1e-12 and r.identity_error < 1e-9 for r in got)
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    for none in ([], [(1, None)], [(1, [])]):
        out = whitening.whitened(vectors(spark, none))
        assert out.count() == 0 and out.columns[0] == "vec_id"


def test_a_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e9]), (2, [-1e9]), (3, [0.0])]
    got = {r.vec_id: r.deviation for r in whitening.whitened(vectors(spark, rows)).collect()}
    assert got[1] is None and got[2] is None and got[3] == 0


def test_characteristic_polynomial_and_roots(spark):
    with_package(spark)
    assert whitening.characteristic_polynomial(spark, [[2, 1], [1, 3]]) == [5, -5, 1]
    diagonal = [[k * (i == j) for j, k in enumerate([7, 7, 3, 0])] for i in range(4)]
    poly = whitening.characteristic_polynomial(spark, diagonal)
    assert poly == [0, -147, 91, -17, 1]
    assert [(round(r / 2**96, 9), m) for r, m in whitening.largest_roots(poly, 18, 3)] == [(7, 2), (3, 1)]
    r = np.random.default_rng(1).integers(-9, 9, (7, 7))
    m = (r @ r.T).tolist()
    poly = whitening.characteristic_polynomial(spark, m)
    assert np.allclose(np.array(poly[::-1], float), np.poly(np.array(m, float)), rtol=1e-6)


# -- conversations --------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, pos int, a string, depth double, words int"


def plain_trie(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    said = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = said.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, t in made.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    below = defaultdict(list)
    for p in nodes:
        if p:
            below[p[:-1]].append(p)
    out, sums = [], {}
    for p in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[p]) - 1) * len(re.findall(WORD, p[-1][1])) if p else 0
        sums[p] = (sum(sums[k][0] for k in below[p]) or 1, own + sum(sums[k][1] for k in below[p]))
        ends = ",".join(map(str, sorted(c for c in nodes[p] if len(made[c]) == len(p))))
        out.append((min(nodes[p]), len(p), min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(below[p]), *sums[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def awkward_turns():
    rows = [(c, t, "user" if t % 2 else "assistant", f"turn {t} of {c // 40}") for c in range(-45, 90) for t in range(1 + abs(c) % 6)]
    rows += [(200, None, None, None), (200, None, "user", ""), (200, 3, "u", "a b"), (200, 3, "u", "a b"), (200, 3, "u", "b a"), (None, 1, "u", "x"), (7, None, "user", "first")]
    rows += [(400 + c, t, "user", "the same words for all") for c in range(60) for t in range(4)]  # copies
    return rows + [(500, t, "user", f"w{t % 3} " * (t % 5)) for t in range(300)]  # one long conversation


@pytest.mark.parametrize("policy,shard", [(SkewPolicy(), 1 << 16), (SkewPolicy(max_rows=20), 1 << 16), (SkewPolicy(max_rows=20), 4)])
def test_trie(spark, monkeypatch, policy, shard):
    """Plain, with conversations cut into slices, and with long paths summed by a scan."""
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", shard)
    rows = awkward_turns()
    table = with_package(spark).createDataFrame([(*r, 1, "a", 0.5, 3) for r in rows], TURNS)
    assert sorted(map(tuple, prefix_trie.conversation_trie(table, policy).collect()), key=str) == plain_trie(rows)


def test_trie_of_nothing(spark):
    empty = with_package(spark).createDataFrame([], TURNS)
    assert prefix_trie.conversation_trie(empty).count() == 0


def test_slots_are_minimal_and_verified():
    r = np.random.default_rng(5)
    a, b = r.integers(-(2**62), 2**62, 5000), r.integers(-(2**62), 2**62, 5000)
    table = prefix_trie.SlotTable(a, b)
    assert sorted(table.slots(a, b)) == list(range(5000))
    assert (table.slots(a, b + 1) == -1).all()


# -- class n-grams ---------------------------------------------------------------------


def tokens(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


@pytest.mark.parametrize("rows", [texts(), [(5, None)], []])
def test_scores_of_awkward_documents(spark, rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = []
    for (i, t), h in zip(rows, held):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))
        want.append((str(i), h, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(base, 6)))
    with_package(spark)
    got = class_ngrams.score_documents(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score <= 1e-9 and r.perplexity >= 1 - 1e-9 for r in got)


def test_scores_without_training_texts(spark):
    with_package(spark)
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    got = class_ngrams.score_documents(documents(spark, [(held, "a b"), (held, None)])).collect()
    assert [(r.n_known, r.train_tokens, round(r.base_score, 9)) for r in got] == [(0, 0, 0.0)] * 2
    each = {round(r.score / r.n_tokens, 9) for r in got}
    assert len(each) == 1 and each.pop() <= 0


def test_classes_beat_plain_frequencies_on_held_out_texts(spark):
    """Words come in three kinds that follow each other in turn; kinds are what the classes should find."""
    r = np.random.default_rng(2)
    rows = [(i, " ".join(f"{'abc'[k % 3]}{r.integers(40)}" for k in range(60))) for i in range(400)]
    with_package(spark)
    docs = documents(spark, rows)
    model = class_ngrams.fit(docs.where(~class_ngrams.held_out()), classes=6)
    got = [x for x in class_ngrams.score(docs, model).collect() if x.held_out]
    n = sum(x.n_tokens for x in got)
    plain, scored = (10 ** (-sum(x[c] for x in got) / n) for c in ("base_score", "score"))
    assert got and scored < 0.5 * plain
    assert (model.between.sum(axis=0) == model.between.sum(axis=1)).all() and model.between.sum() == model.tokens


def test_best_class_is_the_likeliest():
    r = np.random.default_rng(4)
    for _ in range(20):
        units, k = 12, 4
        walk = r.integers(0, units, 400)  # closed, so that each unit stands before another as often as behind one
        pairs = np.zeros((units, units))
        np.add.at(pairs, (walk, np.roll(walk, -1)), 1)
        classes = r.integers(0, k, units)

        def between(c):
            out = np.zeros((k, k))
            np.add.at(out, (c[:, None], c[None, :]), pairs)
            return out

        u = int(r.integers(units))
        before, behind = np.bincount(classes, pairs[:, u], k), np.bincount(classes, pairs[u], k)
        got = class_ngrams.best_class(before, behind, pairs[u, u], int(classes[u]), between(classes))
        tried = [class_ngrams.likelihood(between(np.where(np.arange(units) == u, c, classes))) for c in range(k)]
        assert tried[got] >= max(tried) - 1e-6
