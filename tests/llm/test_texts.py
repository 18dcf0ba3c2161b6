"""Operators on single texts: BPE, wavelet shards, personal data, licenses, quality, host rules, tiling."""

import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus
from corpus import prose, texts
from courierflow.llm import boosted, bpe, host_rules, license_join, minhash, pii, quality, tiling, wavelet
from courierflow.llm.queries import with_package
from courierflow.session import scratch

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "᠎", "​", "a", "'s", "'re", "1", "²", "é", "é", "\U0001f600", "<|endoftext|>", "<|endof", "\x00", "'S", "　", "\r\n", "_", "%%%", "ʰ"]


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.documents(with_package(spark)).cache()


@pytest.fixture(scope="module")
def none(spark):
    return corpus.documents(spark, [])


def odd_texts():
    r = random.Random(4)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 12))) for _ in range(3000)] + [t or "" for _, t in corpus.texts()] + ["ab" * 5000]


def test_bpe_equals_the_library():
    own, library = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    for text, ids in zip(odd_texts(), own.encode(odd_texts())):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text[:50])
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_bpe_forgets_and_stays_right(monkeypatch):
    own, library = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    monkeypatch.setattr(bpe.trim, "__defaults__", (5,))
    for text in [t or "" for _, t in corpus.texts()] * 2:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.pieces) <= 5


def test_bpe_columns(docs, none):
    rows = bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in rows) == sorted((d or 0, t or "") for d, t in corpus.texts())
    assert all(len(r["ids"]) % 4 == 0 and r.score == r.n for r in rows)
    assert bpe.round_trip(none, BYTE).count() == 0


def test_wavelet_matrix():
    r = np.random.default_rng(1)
    for n, top in [(0, 1), (1, 1), (65, 2), (5000, 49_408), (3000, 3)]:
        ids = r.integers(0, top, n).astype(np.uint32)
        m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
        assert m.tokens().tolist() == ids.tolist()
        assert m.access(np.arange(n)).tolist() == ids.tolist()
        for token in [0, 1, 7, int(ids[0]) if n else 5, 100_000]:
            assert m.count(token) == (ids == token).sum() and m.occurrences(token).tolist() == np.flatnonzero(ids == token).tolist()
            assert m.count(token, n // 3, n // 2) == (ids[n // 3 : n // 2] == token).sum()


def test_decomposed_words_equal_the_library():
    own, library = wavelet.WordEncoder(WORD), Tokenizer.from_file(WORD)
    texts = [f"{x}amza so{x} Plain {x.lower()}" for x in ("H\u0331", "T\u0308", "J\u030c", "W\u030a", "Y\u030a", "E\u0301", "\u00c9")] + [t or "" for _, t in corpus.texts()]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts], b"")):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:50])


def test_words_of_letters_need_merges_only(monkeypatch):
    """The library's whole path gets marks and odd words; cores of Latin letters are learned once, by merges."""
    own, library, asked = wavelet.WordEncoder(WORD), Tokenizer.from_file(WORD), []

    class Watched:
        def encode_batch_fast(self, words, **options):
            asked.extend(words)
            return library.encode_batch_fast(words, **options)

    own.tokenizer = Watched()
    monkeypatch.setattr(wavelet, "KEPT_WORDS", 4)
    texts = ["Plain words stay, words!! End%%% \u00c9clair gr\u00f6\u00dfer, \u00c5ngstr\u00f6m", "x'S re's 12ab <|endoftext|> <|EndOfText|>A, \u0391\u03a3, e\u0301 ** *", "", " \n", "words again\x1c \u00d7 \u00ba \u00f7a <|a"]
    for _ in range(2):
        for text, ids in zip(texts, own.encode([t.encode() for t in texts], b"")):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert not {"plain", "words", "stay", "end", "stay,", "end%%%", "\u00e9clair", "gr\u00f6\u00dfer,"} & {w.lower() for w in asked}
    assert {",", "%%%", "12ab", "<|endoftext|>"} <= {*asked}
    assert len(own.older) + len(own.known) < 60
    assert own.encode([], b"") == [] and own.encode([b""], b"\1\0\0\0") == [b"\1\0\0\0"]


def test_words_are_known_without_their_marks():
    """One look-up for a word, whatever marks follow it; only marks after a letter or digit are parted from it."""
    own, library = wavelet.WordEncoder(WORD), Tokenizer.from_file(WORD)
    texts = ["plain plain, Plain. caf\u00e9 caf\u00e9; 12%% a*** ... ,", "", "x.y, \u00d7, \u0391\u03a3. a-, \u4e2d! <|endoftext|>, '. plain:", "."]
    for text, ids in zip(texts, own.encode([t.encode() for t in texts], b""), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    words = "plain caf\u00e9 12 a x.y , . ; : %% *** ... \u00d7, \u0391\u03a3. a-, \u4e2d! <|endoftext|>, '."
    assert {*own.known} == {w.encode() for w in words.split()}


def test_wavelet_shards(spark, docs, none):
    folder, library = scratch(spark, "shards"), Tokenizer.from_file(WORD)
    wavelet.write_shards(docs, folder, WORD, shard_tokens=500)
    shards = wavelet.read_shards(spark, folder)
    assert shards.count() > 5
    want, start = [], 0
    for d, t in sorted(corpus.texts(), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    rows = sorted(wavelet.documents_of(shards).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r["ids"])) for r in rows] == want
    assert {r.token: r.n for r in wavelet.token_counts(shards, [1, 5]).collect()}[1] >= len(want)
    assert wavelet.occurrences(shards, 1).count() >= len(want)
    folder = scratch(spark, "shards")
    wavelet.write_shards(none, folder, WORD)
    assert wavelet.documents_of(wavelet.read_shards(spark, folder)).count() == 0


def test_base_spans_are_the_formats():
    r = random.Random(9)
    parts = ["1", "22", "255", "999", ".", ".", "@", "a", "b-c", "+", " ", "-", "(", ")", "4111111111111111", "x.org", "%", "é"]
    for text in ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(4000)] + [t for _, t in corpus.texts()]:
        assert pii.base_spans(text or "") == corpus.base_spans(text), text
    assert pii.base_spans("a" * 200_000 + "1" * 200_000) == []


def test_numbers_are_judged_once():
    text = "call (555) 123-4567, not 1 2 3 4 5 6 7x or 123456, but 12.34.56.7"
    assert [text[a:b] for _, a, b in pii.numbers(text)] == ["(555) 123-4567", "12.34.56.7"]
    assert pii.candidates("1 " * 500_000 + "1a") == []  # a megabyte that fails at its end


def test_personal_data(spark, docs, none):
    r = random.Random(3)
    taught = [(i, f"so token = \"{r.randbytes(16).hex()}\" and call +49 30 {r.randint(10**6, 10**7 - 1)} or {r.randint(10**8, 10**9)} in 20{r.randint(10, 99)}-{r.randint(10, 99)}-01") for i in range(400)]
    model = pii.fit(corpus.documents(spark, taught))
    spans = {x.doc_id: [(s.kind, s.start, s.end, s.base) for s in x.spans] for x in pii.find(docs, model).collect()}
    text = dict(corpus.texts())[15]
    assert [s[:3] for s in spans[15] if s[3]] == corpus.base_spans(text)
    assert [text[a:b] for _, a, b, base in spans[15] if not base] == ["00ff11aa22bb33cc44dd55ee"]
    assert all(spans[d] == [] for d in (0, 3, 4, 8, 20))
    clean = {x.doc_id: x.text for x in pii.redact(docs, model).collect()}
    assert clean[15] == "mail [email] and [ip] or 300.1.2.3, [card] x [phone] token = \"[secret]\" end" and clean[3] == ""
    assert pii.find(none, pii.fit(none)).count() == 0


def test_many_equal_candidates_leave_room_for_others(spark, monkeypatch):
    r = random.Random(3)
    rows = [f"so token = \"{r.randbytes(16).hex()}\" and call +49 30 {r.randint(10**6, 10**7 - 1)} or {r.randint(10**8, 10**9)}" for _ in range(400)]
    rows += [f"{after} {'7' * n} end" for after in ("no", "id", "call", "in -") for n in (7, 8, 9, 10) for _ in range(300)]
    samples = []
    monkeypatch.setattr(pii, "Calibrated", lambda *sample: samples.append(sample) or boosted.Calibrated(*sample))
    model = pii.fit(corpus.documents(spark, list(enumerate(rows))), rows=250)
    assert len(samples[0][0]) == len(np.unique(samples[0][0], axis=0)) == 250
    assert model.threshold <= 1
    text = 'the token = "00ff11aa22bb33cc44dd55ee66ff7788" end'
    assert [text[a:b] for _, a, b, _ in pii.all_spans(text, model)] == ["00ff11aa22bb33cc44dd55ee66ff7788"]
    assert pii.all_spans("no 7777777 end", model) == []


def test_secrets_without_a_digit_are_proposed():
    for text in ('password = "correct-horse-battery-staple" x', 'page 3, password = "correct-horse-battery-staple" x'):
        assert [text[a:b] for _, a, b in pii.candidates(text)] == ["correct-horse-battery-staple"]
    assert pii.candidates("Author: somebody-with-a-long-name, title: anything-goes-here") == []


def test_boosted_trees_learn():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    model = boosted.Calibrated(x, y)
    assert ((model.probability(x) >= model.threshold) == y).mean() > 0.95 and 0.8 <= model.threshold <= 1


def test_licenses(docs, none):
    got = {r.doc_id: r for r in license_join.scan(docs).collect() if r.doc_id is not None}
    for d, t in corpus.texts():
        if d is not None:
            n, found = corpus.phrase_places(t, license_join.PHRASES)
            labels = ",".join(sorted({x for _, x in found}))
            want = (n, len(found), found[0][0] if found else None, found[-1][0] if found else None, labels)
            r = got[d]
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
            assert set(filter(None, labels.split(","))) <= set(r.labels.split(","))
    assert license_join.scan(none).count() == 0


def test_license_join_is_exact():
    r = random.Random(2)
    templates = [(str(k), " ".join(r.sample("abcdefghijklmnop", 9))) for k in range(5)]
    for seed in range(60):
        r.seed(seed)
        text = [r.choice("abcdefghijklmnopqrstuvwxyzABC").lower() + r.choice(["", "", "x", "y"]) for _ in range(300)]
        known = license_join.Templates(templates, 0.7)
        hashes, _ = license_join.words([" ".join(text)])
        known.order(np.bincount(known.number(hashes)[known.number(hashes) >= 0], minlength=len(known.vocabulary)))
        want = {}
        for b in range(0, 300, license_join.BLOCK // 2):
            block = set(text[b : b + license_join.BLOCK])
            for label, t in templates:
                share = len(set(t.split()) & block) / 9
                if share >= 0.7 - 1e-9:
                    want[label] = max(want.get(label, 0), share)
        assert known.meet(known.number(hashes)) == want


@pytest.mark.parametrize("n", [24, 41, 80, 1500])
def test_whole_license_texts_are_found_wherever_they_stand(n):
    template = corpus.prose(70, n)
    known = license_join.Templates([("whole", template), ("short", corpus.prose(71, 12))], 0.8)
    for before in (0, 1, 23, 47, 90, 2000):
        hashes, _ = license_join.words([f"{' '.join(f'w{i}' for i in range(before))} {template} and more words of this text"])
        assert known.meet(known.number(hashes))["whole"] == 1.0
    hashes, _ = license_join.words([" ".join(template.split()[: n // 3]) if n > 24 else "nothing of it"])
    share = len(set(template.split()[: n // 3])) / len(set(template.split())) if n > 24 else 0
    assert share >= 0.8 or "whole" not in known.meet(known.number(hashes))


def test_quality(spark, docs, none):
    rows = [(i, corpus.prose(i, 80) if i % 2 else " | ".join(corpus.prose(i, 40).split()) + " !!") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (5, None), (7, 9), (99_999, 1)], "doc_id long, quality int")
    out = quality.rank_documents(corpus.documents(spark, rows), labels).collect()
    assert len(out) == 300 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in out)
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in out)
    held = [x for x in out if x.held_out]
    assert sum(x.predicted == x.doc_id % 2 for x in held) >= 0.95 * len(held)
    assert quality.rank_documents(docs, labels).count() == docs.count()
    assert quality.rank_documents(none, labels).count() == 0
    assert all(x.score == pytest.approx(0.3) for x in quality.rank_documents(docs, labels.limit(0)).collect())



def test_host_rules(docs, none):
    got = host_rules.judge(docs, "doc_id").collect()
    want = []
    for d, t in corpus.texts():
        t, w = t or "", corpus.words(t)
        lines = [x for x in t.split("\n") if corpus.words(x)]
        runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        repeats = {p for i, x in enumerate(runs) if runs.count(x) > 1 for p in (i, i + 1, i + 2)} if len(w) < 3500 else set()
        want.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeats), len(w) < 50 or 100 * len(repeats) > 50 * len(w)))
    small = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]
    assert sorted((x for x in small if x[1] < 3500), key=str) == sorted((x for x in want if x[1] < 3500), key=str)
    assert not any(r.kept and r.base_failed for r in got)
    assert host_rules.judge(none, "doc_id").count() == 0


def test_strict_hosts(spark):
    rows = [(i, corpus.prose(i, 80) + (" |" * 30 if i % 10 else ""), "bad", 0) for i in range(60)] + [(100 + i, corpus.prose(i, 80) + (" |" * 30 if i == 0 else ""), "good", 0) for i in range(60)]
    got = {r.doc_id: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string, kept int"), "doc_id").collect()}
    assert not got[1].kept and got[0].kept and got[100].kept


def plain_tiles(doc, item, least):
    """The longest free match is marked until none of ``least`` words is left."""
    used_d, used_i, covered = set(), set(), 0
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and i + k not in used_d and j + k not in used_i:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return covered
        used_d |= set(range(best[1], best[1] + best[0]))
        used_i |= set(range(best[2], best[2] + best[0]))
        covered += best[0]


def test_tiles_cover_what_plain_tiling_covers():
    r = random.Random(6)
    for _ in range(60):
        item = [r.randint(1, 6) for _ in range(r.randint(5, 40))]
        cut = r.randint(1, len(item) - 1)
        doc = [r.randint(1, 6) for _ in range(20)] + item[cut:] + [99] + item[:cut] + [r.randint(1, 6) for _ in range(20)]
        got = tiling.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), 3)
        assert all(doc[i : i + n] == item[j : j + n] for n, i, j in got)
        places = [p for n, _, j in got for p in range(j, j + n)]
        assert len(places) == len(set(places)) and abs(sum(n for n, _, _ in got) - plain_tiles(doc, item, 3)) <= 2


def test_decontamination(spark, docs, none):
    item = corpus.prose(77, 40)
    w = item.split()
    rows = [(0, "x " + re.sub("[a-z]", lambda m: m[0].upper(), item) + " y"), (1, " ".join(w[20:] + ["and"] + w[:20])), (2, " ".join(w[:15])), (3, None), (None, item), (5, item), (5, item), (6, corpus.prose(8, 200))]
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, item + " " + corpus.prose(78, 60))], "item_id long, text string")
    got = tiling.contaminated(corpus.documents(spark, rows), bench).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.item_id) for r in got) == [(-1, 1), (0, 1), (1, 1), (5, 1), (5, 1)]
    assert {r.n_tiles for r in got if r.doc_id == 1} == {2}
    assert sorted(r.doc_id for r in tiling.clean(corpus.documents(spark, rows), bench).collect()) == [2, 3, 6]
    assert tiling.contaminated(none, bench).count() == 0 and tiling.contaminated(docs, bench.limit(0)).count() == 0
    blocks = list(tiling.blocks(bench, most=10))
    assert [len(b) for b in blocks] == [1, 1, 1, 1] or sum(map(len, blocks)) == 4


def test_stages_keep_columns_with_the_names_they_use(spark):
    """Each stage passes on extra columns untouched, those called like its own working columns too."""
    names = ["_raw", "_leaks", "_score", "_key", "_print", "_n", "_row"]
    rows = [(i, t, *[f"{i} {n}" for n in names]) for i, t in texts() if i is not None]
    docs = with_package(spark).createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    labels = spark.createDataFrame([(i, k % 2) for k, (i, *_) in enumerate(rows)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, prose(77, 40))], "item_id long, text string")
    stages = [quality.accepted(docs, labels), minhash.survivors(docs), tiling.clean(docs, items), pii.redact(docs, pii.fit(docs))]
    for kept in stages:
        assert kept.columns == docs.columns
        found = kept.collect()
        assert found and all(r[n] == f"{r.doc_id} {n}" for r in found for n in names)
    assert not any("@" in (r.text or "") for r in found)
