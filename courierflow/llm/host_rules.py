"""Quality rules by host, native: failure rates of hosts shrunk by an empirical beta prior.

Each text is measured in its row, without a shuffle. Rule failures are summed by host; the prior of
each rule comes from the moments of the hosts' rates; a host whose shrunk rate is high is strict:
its documents must pass every rule, those of other hosts only the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierflow.llm.text import whole_texts
from courierflow.session import materialize

BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
#: A host with a shrunk failure rate above this is strict.
STRICT_RATE = 0.5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "n_dup_lines >= 10",
    "lengths": "word_chars > 15 * n_words or word_chars < 2 * n_words",
}
BASE = ("short", "repeats")


def held(df: DataFrame, *keep: str, **new: Column) -> DataFrame:
    """The kept and new columns behind a generator: lambdas that use a new column don't compute it again."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in new.items()]))))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def measures(documents: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``MEASURES`` of each whole text; a null text counts as empty.

    Word windows are compared by 64-bit hashes within their own text.
    """
    df = whole_texts(documents, *keep)
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    df = held(
        df.select(*keep, "text", lines.alias("lines")), *keep,
        hashes=F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)),
        word_chars=F.length(F.translate("text", BLANKS, "")).cast("long"),
        n_symbols=(F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
    )
    plain = [*keep, "word_chars", "n_symbols", "n_dup_lines"]
    n = F.size("hashes")
    window = F.transform("hashes", lambda h, i: F.struct(F.xxhash64(h, F.get("hashes", i + 1), F.get("hashes", i + 2)).alias("h"), i.alias("i")))
    df = held(df, *plain, n_words=n.cast("long"), runs=F.sort_array(F.slice(window, F.lit(1), F.greatest(n - 2, F.lit(0)))))
    plain.append("n_words")
    same = lambda x, k: F.coalesce(F.get("runs", k)["h"] == x["h"], F.lit(False))
    twice = F.filter("runs", lambda x, k: same(x, k - 1) | same(x, k + 1))
    df = held(df, *plain, places=F.sort_array(F.transform(twice, lambda x: x["i"])))
    cover = F.aggregate(
        "places", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"].cast("long"))
    return df.select(*plain, cover.alias("n_repeat_words"))


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """Documents, failures and shrunk failure rate of each host and rule, ``strict`` if any rate is high.

    The prior of a rule is the beta distribution with the mean and the variance of its rates over
    hosts, worth 1 to 1000 documents. A null host is a host of its own.
    """
    fails = measured.groupBy(host).agg(F.count("*").alias("docs"), *[F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in RULES.items()])
    hosts = materialize(fails, "hosts")
    rate = lambda name: F.col(name) / F.col("docs")
    prior = hosts.agg(*[f(rate(name)).alias(f"{k}_{name}") for name in RULES for k, f in (("mean", F.avg), ("var", F.var_pop))]).first()
    shrunk = {}
    for name in RULES:
        mean, var = prior[f"mean_{name}"] or 0.0, prior[f"var_{name}"] or 0.0
        worth = min(1000.0, max(1.0, mean * (1 - mean) / var - 1)) if var > 0 else 1000.0
        shrunk[f"rate_{name}"] = (F.col(name) + mean * worth) / (F.col("docs") + worth)
    return hosts.select(host, "docs", *[c.alias(n) for n, c in shrunk.items()], (F.greatest(*shrunk.values()) > STRICT_RATE).alias("strict"))


def judge(documents: DataFrame, *keep: str, host: str = "source") -> DataFrame:
    """The kept columns, ``MEASURES``, ``base_failed``, ``strict`` and ``kept`` of each document.

    Every row is judged, repeated ones too; an empty or null text fails the base rules; an empty
    table gives no rows.
    """
    table = documents.select(*[F.col(k) for k in keep], F.col(host).alias("_host"), "text")
    measured = materialize(measures(table, *keep, "_host"), "measures")
    hosts = host_rates(measured, "_host").select(F.col("_host").alias("_of"), "strict")
    joined = measured.join(hosts, measured["_host"].eqNullSafe(hosts["_of"]), "left")
    any_of = lambda names: F.expr(" or ".join(f"({RULES[n]})" for n in names))
    base, failed = any_of(BASE), any_of(RULES)
    return joined.select(*keep, *MEASURES, base.alias("base_failed"), "strict", (~base & ~(F.coalesce("strict", F.lit(False)) & failed)).alias("kept"))
