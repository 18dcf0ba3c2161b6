"""A small corpus of awkward documents, and plain versions of the operators to compare with."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

EXTRA = ["score", "kept", "ids", "spans", "features", "print", "bucket", "chunk", "key", "comp", "n", "_leaks"]
SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())]
    + [StructField(c, IntegerType()) for c in EXTRA])


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "do", "ri", "ste", "ло", "ü", "ka", "th"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def texts():
    base, other = prose(1, 120), prose(2, 300)
    words = base.split()
    near = " ".join([*words[:50], "changed", *words[51:]])
    far = " ".join([*words[:60], *prose(3, 60).split()])
    return [
        (0, base), (1, base), (2, near), (3, None), (4, ""), (5, " \n\t "), (None, base), (None, None), (7, other), (7, other), (8, "a" * 30_000),
        (9, "word " * 3000), (10, far), (11, other + "\n" + base), (12, "one two"), (13, "one two"), (14, other[:250] + " x " + other[:250]),
        (15, "mail a.b+c@d-e.org and 1.2.3.4 or 300.1.2.3, 4111 1111 1111 1111 x +49 (30) 1234-5678 token = \"00ff11aa22bb33cc44dd55ee\" end"),
        (16, "Licensed under CC BY-NC 4.0. Released under the MIT License"), (17, "<|endoftext|>x  y\r\n z's 　 q"), (18, "é\U0001f600 " * 400),
        (19, " ".join(f"w{i % 7}" for i in range(400))), (20, prose(5, 4000)), (21, prose(5, 4000)[3000:9000]),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", 1, *[k] * len(EXTRA)) for k, (i, t) in enumerate(rows)], SCHEMA)


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(t):
    t, out, kinds = t or "", [], ["email", "ip", "card", "phone"]
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def near_duplicates(rows):
    """``(n_shingles, component, kept)`` of rows with an id; rows of one id are one document."""
    sets = []
    for _, t in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i]
            if same or (n and 100 * n >= 75 * len(sets[i] | sets[j])):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    named = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            named[root(i)].append(d)
    return [(len(sets[i]), min(named[root(i)], default=None)) for i in range(len(rows))]


def without_repeats(rows, size=20):
    """``(n_words, n_removed, kept)`` of each row; a null id is the smallest."""
    first = {}
    keyed = [(-1 if d is None else d, words(t)) for d, t in rows]
    for d, w in keyed:
        for s in range(len(w) - size + 1):
            k = tuple(w[s : s + size])
            first[k] = min(first.get(k, (d, s)), (d, s))
    out = []
    for d, w in keyed:
        gone = set()
        for s in range(len(w) - size + 1):
            if (d, s) > first[tuple(w[s : s + size])]:
                gone |= set(range(s, s + size))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def without_strings(rows, size=200):
    """``(n_bytes, n_removed, n_spans, kept)`` of each row."""
    raws = [(t or "").encode() for _, t in rows]
    times = Counter(b[i : i + size] for b in raws for i in range(len(b) - size + 1))
    out = []
    for b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if times[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def phrase_places(t, phrases):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return len(w), sorted((i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
