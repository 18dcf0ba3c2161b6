"""Operators across texts: near-duplicates, repeated words, repeated bytes, and the pipeline."""

import random

import numpy as np
import pytest

import corpus
from courierflow.llm import blocks, minhash, suffix
from courierflow.llm.queries import with_package


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.documents(with_package(spark)).cache()


@pytest.fixture(scope="module")
def none(spark):
    return corpus.documents(spark, [])


def ordered(rows):
    return sorted(rows, key=str)


def test_near_duplicates(spark, docs, none):
    want = [(d, *x) for (d, _), x in zip(corpus.texts(), corpus.near_duplicates(corpus.texts()))]
    got = minhash.near_duplicates(docs).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert minhash.near_duplicates(none).count() == 0
    left = minhash.survivors(docs)
    assert left.columns == docs.columns
    assert ordered(r.doc_id for r in left.collect()) == ordered([0, 3, 4, 5, None, 7, 8, 9, 10, 11, 12, 14, 15, 16, 17, 18, 19, 20, 21])


@pytest.mark.parametrize(("size", "shingles"), [(4, 1 << 20), (1000, 1 << 20), (1000, 300)])
def test_large_groups_lose_no_link(spark, size, shingles):
    r = random.Random(5)
    base = corpus.prose(50, 100).split()
    rows = []
    for i in range(40):
        w = base[:]
        for _ in range(r.randint(0, 3)):
            w[r.randrange(100)] = f"x{r.randrange(1000)}"
        rows.append((i, " ".join(w)))
    got = minhash.near_duplicates(corpus.documents(spark, rows), slice_size=size, slice_shingles=shingles).collect()
    assert {r.doc_id: r.component_id for r in got} == {d: c for (d, _), (_, c) in zip(rows, corpus.near_duplicates(rows))}


def test_one_id_with_two_texts_joins_both_groups(spark):
    a, b = corpus.prose(61, 60), corpus.prose(62, 60)
    rows = [(5, a), (5, b), (3, a + " more"), (9, b + " less"), (2, corpus.prose(63, 60))]
    got = minhash.near_duplicates(corpus.documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((d, c) for (d, _), (_, c) in zip(rows, corpus.near_duplicates(rows)))
    assert {r.component_id for r in got} == {2, 3}


def test_nameless_groups(spark):
    rows = [(None, corpus.prose(1, 30)), (None, corpus.prose(1, 30)), (None, corpus.prose(2, 30)), (None, ""), (None, "")]
    got = minhash.near_duplicates(corpus.documents(spark, rows)).collect()
    assert all(r.component_id is None and r.kept for r in got)
    assert minhash.survivors(corpus.documents(spark, rows)).count() == 4


def test_pieces_count_what_whole_sets_count():
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2)
    values = [np.unique(np.r_[r.choice(base, 3900, replace=False), r.integers(0, 1 << 63, k).astype(np.uint64)]) for k in (0, 9, 300, 900, 2000)] + [base[:1]]
    sizes = np.array([len(v) for v in values])
    want = np.array([[100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)) for b in values] for a in values])
    others = ~np.eye(len(values), dtype=bool)
    for piece in (100, 5000, 1 << 20):
        assert (minhash.linked(values, sizes, piece=piece) == want)[others].all()
        assert (minhash.linked(values, sizes, np.array([1, 4]), piece) == want[[1, 4]])[others[[1, 4]]].all()


def test_sketches_estimate_and_fill():
    r = np.random.default_rng(2)
    a, b = np.unique(r.integers(0, 1 << 62, 900).astype(np.uint64)), np.unique(r.integers(0, 1 << 62, 300).astype(np.uint64))
    rows = [np.unique(np.r_[a, b]), a, a[:3], a[:1], a[:0]]
    got = minhash.sketches(np.concatenate(rows), np.cumsum([0, *map(len, rows)]))
    share = (got[0] == got[1]).mean()
    assert abs(share - len(a) / len(rows[0])) < 0.15 and (got[4] == 0).all()
    assert len(np.unique(got[3])) > 100  # one element alone fills every coordinate
    again = minhash.sketches(a[:3], np.array([0, 3]))
    assert (again[0] == got[2]).all()


def test_repeated_words(spark, docs, none):
    want = [(d, *x) for (d, _), x in zip(corpus.texts(), corpus.without_repeats(corpus.texts()))]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in blocks.dedup(docs).collect()]
    assert ordered(got) == ordered(want)
    assert blocks.dedup(none).count() == 0


def test_repeated_words_in_any_place(spark):
    r = random.Random(8)
    passages = [corpus.prose(100 + k, r.randint(18, 45)) for k in range(6)]
    rows = [(r.randrange(10_000) * 50 + i, " ".join(r.choice([corpus.prose(1000 * i + j, r.randint(1, 25)), r.choice(passages)]) for j in range(6))) for i in range(50)]
    want = [(d, *x) for (d, _), x in zip(rows, corpus.without_repeats(rows))]
    assert ordered((r.doc_id, r.n_words, r.n_removed, r.kept) for r in blocks.dedup(corpus.documents(spark, rows), bucket_bytes=2000).collect()) == ordered(want)


def test_copies_spread_over_the_parts():
    ids, prints = np.r_[np.arange(800), 5], np.full(801, 77)
    rows = blocks.decided(np.repeat(np.arange(801), 3), np.tile([0, 1, 2], 801), ids, prints, 3)
    found = [np.array(r[5])[blocks.unplanes(r[4], np.uint32)] for r in rows]
    assert len(rows) == 8 and max(map(len, found)) < 2 * 3 * 801 / 8
    assert sum(5 in f for f in found) == 1  # rows of one id and text stay together
    assert blocks.decided(np.zeros(0, int), np.zeros(0, int), ids, prints, 3) == []


@pytest.mark.parametrize("most", [2, 4096])
def test_repeated_bytes(spark, docs, none, most):
    want = [(d, *x) for (d, _), x in zip(corpus.texts(), corpus.without_strings(corpus.texts()))]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.dedup(docs, most_windows=most).collect()]
    assert ordered(got) == ordered(want)
    assert suffix.dedup(none).count() == 0


@pytest.mark.parametrize("most", [2, 4096])
def test_repeated_bytes_in_any_place(spark, most):
    r = random.Random(8)
    passages = [corpus.prose(100 + k, r.randint(30, 90)) for k in range(6)]
    rows = [(i, " ".join(r.choice([corpus.prose(1000 * i + j, r.randint(1, 25)), r.choice(passages)]) for j in range(6))) for i in range(40)]
    want = [(d, *x) for (d, _), x in zip(rows, corpus.without_strings(rows))]
    got = suffix.dedup(corpus.documents(spark, rows), bucket_bytes=2000, most_windows=most).collect()
    assert ordered((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == ordered(want)


def test_windows_spread_over_the_buckets(spark):
    rows = corpus.documents(spark, [(i, corpus.prose(i, 400)) for i in range(60)]).selectExpr("doc_id", "xxhash64(text)", "text")
    found = rows.mapInArrow(suffix.anchors(4), blocks.ROW).where(f"kind = {blocks.HASHES}").selectExpr("bucket", "size(ids) n")
    sizes = dict(found.groupBy("bucket").sum("n").collect())
    assert len(sizes) == 16 and max(sizes.values()) < 2 * sum(sizes.values()) / 16


def test_long_prefixes():
    r = np.random.default_rng(3)
    for top, n, least in [(2, 60, 4), (3, 300, 6), (2, 500, 9), (4, 200, 3)]:
        text = r.integers(1, 1 + top, n).astype(np.uint8)
        text[-1] = 0
        order, long = suffix.long_prefixes(text, least)
        turned = [bytes(np.roll(text, -i)) for i in range(n)]
        assert [turned[i][: least + 5] for i in order] == sorted(t[: least + 5] for t in turned)
        for k in range(1, n):
            assert long[k] == (turned[order[k]][:least] == turned[order[k - 1]][:least])


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(11)
    item = corpus.prose(900, 50)
    good = [(i, corpus.prose(i, 80)) for i in range(120)]
    bad = [(1000 + i, " | ".join(corpus.prose(i, 40).split()) + " !! ##") for i in range(80)]
    extra = [(2000, good[3][1]), (2001, item + " " + corpus.prose(7000, 20)), (2002, corpus.prose(7001, 60) + " write a.b@c.org now"), (None, corpus.prose(7002, 60))]
    rows = good + bad + extra
    docs = corpus.documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, int(d < 1000)) for d, _ in good + bad if r.random() < 0.8], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    step = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == docs.columns
        seen[name] = {x.doc_id: x.text for x in step.collect()}
    assert set(seen["quality"]) == {d for d, _ in good + extra}
    assert set(seen["near_duplicates"]) == set(seen["quality"]) - {2000}
    assert set(seen["decontamination"]) == set(seen["near_duplicates"]) - {2001}
    assert seen["personal_data"][2002].endswith(" write [email] now")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in out} == set(seen["personal_data"]) and all(x.decodes and x.n_tokens > 0 for x in out)
