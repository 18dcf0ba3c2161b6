"""DuckDB statements with the same rows as the queries that SQL can express."""

from __future__ import annotations

from courierflow.llm.license_join import BLOCK, CONTAINMENT, PHRASES, TEMPLATES

SPACE = r"[\x20\x09-\x0D]+"
WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"

# The host verdict is stated with the same prior: moments of the hosts' rates, worth 1 to 1000 documents.
_RULES = {
    "short": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
    "lines": "n_dup_lines >= 10", "lengths": "word_chars > 15 * n_words OR word_chars < 2 * n_words",
}
_SHRUNK = ", ".join(f"(sum({n}) + avg_{n} * worth_{n}) / (count(*) + worth_{n})" for n in _RULES)
OP7 = f"""
WITH d AS (SELECT rowid AS r, doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
runs AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM d),
keyed AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times FROM runs),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM keyed WHERE times > 1) GROUP BY r),
m AS (SELECT d.r, doc_id, source, len(w) AS n_words, length(regexp_replace(text, '{SPACE}', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{SPACE}', '', 'g') <> ''))
    - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{SPACE}', '', 'g') <> ''))) AS n_dup_lines,
  coalesce(n, 0) AS n_repeat_words FROM d LEFT JOIN repeats USING (r)),
f AS (SELECT *, {", ".join(f"({c})::INT AS {n}" for n, c in _RULES.items())} FROM m),
rates AS (SELECT source, {", ".join(f"avg({n}) AS {n}" for n in _RULES)} FROM f GROUP BY source),
moments AS (SELECT {", ".join(f"avg({n}) AS avg_{n}, var_pop({n}) AS var_{n}" for n in _RULES)} FROM rates),
prior AS (SELECT {", ".join(f"avg_{n}, CASE WHEN var_{n} > 0 THEN least(1000, greatest(1, avg_{n} * (1 - avg_{n}) / var_{n} - 1)) ELSE 1000 END AS worth_{n}" for n in _RULES)} FROM moments),
hosts AS (SELECT source, greatest({_SHRUNK}) > 0.5 AS strict FROM f, prior GROUP BY source, {", ".join(f"avg_{n}, worth_{n}" for n in _RULES)})
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, (short = 1 OR repeats = 1) AS base_failed,
  NOT (short = 1 OR repeats = 1) AND NOT (strict AND ({" + ".join(_RULES)}) > 0) AS kept
FROM f JOIN hosts ON f.source IS NOT DISTINCT FROM hosts.source
"""

SQL = {"op7_host_rules": OP7}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

# Pairs of documents that share a shingle, and the documents reachable over links.
OP3 = f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex({LOWERED}, '{SPACE}'), lambda x: x <> '') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
runs AS (SELECT doc_id, string_agg(word, ' ') OVER five AS run, count(*) OVER five AS n
  FROM words WINDOW five AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
shingles AS (SELECT DISTINCT doc_id, run FROM runs WHERE n = 5 UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.run = b.run AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_id AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM least_id LEFT JOIN sizes USING (doc_id)
"""

_SETS = ", ".join(f"({k}, '{label}', {sorted(set(t.split()))!r})" for k, (label, t) in enumerate(TEMPLATES))
_SOUGHT = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
_PHRASE_RUNS = " UNION ALL ".join(
    f"SELECT doc_id, p, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS run FROM words"
    for n in sorted({len(p.split()) for p in PHRASES}))
OP9 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM d),
sought(phrase, label, n) AS (VALUES {_SOUGHT}),
base AS (SELECT DISTINCT doc_id, p, label FROM ({_PHRASE_RUNS}) JOIN sought ON run = phrase),
based AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
sets(k, label, t) AS (VALUES {_SETS}),
parts AS (SELECT k, label, len(t) AS size, unnest(t) AS word FROM sets),
placed AS (SELECT DISTINCT doc_id, unnest([p // {BLOCK // 2}, p // {BLOCK // 2} - 1]) AS block, word FROM words WHERE word IN (SELECT word FROM parts)),
met AS (SELECT doc_id, label, count(*) / any_value(size) AS share FROM placed JOIN parts USING (word) WHERE block >= 0
  GROUP BY doc_id, block, k, label HAVING count(*) >= ceil({CONTAINMENT} * any_value(size) - 1e-9)),
found AS (SELECT doc_id, label, share FROM met UNION ALL SELECT doc_id, label, 1.0 FROM base),
labelled AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN based USING (doc_id) LEFT JOIN labelled USING (doc_id)
"""

OP10 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
runs AS (SELECT doc_id, p, word, md5(string_agg(word, ' ') OVER twenty) AS run, count(*) OVER twenty = 20 AS whole
  FROM words WINDOW twenty AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
firsts AS (SELECT run, min((doc_id, p)) AS first FROM runs WHERE whole GROUP BY run),
marked AS (SELECT doc_id, p, word, whole AND (doc_id, p) > first AS later FROM runs LEFT JOIN firsts USING (run)),
covered AS (SELECT doc_id, p, word, coalesce(bool_or(later) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone FROM marked),
kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS text FROM covered GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

SQL |= {"op3_minhash": OP3, "op9_licenses": OP9, "op10_blocks": OP10}

# crc32 of a decimal number, byte by byte; a node's key is the digests of its turns, one after the other.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, bit: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"""
OP12 = f"""
WITH said AS (SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, mark) - 1 AS pos FROM said),
convs AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS head, {_CRC} % 4 AS taken FROM said),
firsts AS (SELECT c.conv_id, pos, mark, words FROM convs c JOIN placed p ON p.conv_id = c.head WHERE pos < taken),
given AS (SELECT c.conv_id, taken, count(f.pos) AS n FROM convs c LEFT JOIN firsts f USING (conv_id) GROUP BY ALL),
turns AS (SELECT * FROM firsts UNION ALL SELECT conv_id, pos - taken + n, mark, words FROM placed JOIN given USING (conv_id) WHERE pos >= taken),
members AS (SELECT conv_id, pos + 1 AS depth, words, string_agg(mark, '') OVER (PARTITION BY conv_id ORDER BY pos) AS k FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ended AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM members),
nodes AS (SELECT k, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words, bool_and(ends) AS leaf,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM ended GROUP BY k),
sums AS (SELECT left(k, 64 * up) AS k, sum(leaf::INT) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM nodes) GROUP BY 1),
children AS (SELECT left(k, 64 * (depth - 1)) AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (k) LEFT JOIN children USING (k) LEFT JOIN nodes p ON n.depth > 0 AND p.k = left(n.k, 64 * (n.depth - 1))
"""

SQL |= {"op12_prefix_trie": OP12}
