"""Hot-key handling shared by all keyed operators.

A key is *hot* when it holds more rows than one task should order or join
(``SkewPolicy.max_rows``). The rows of such a key are cut into slices of about that many rows along
their order columns. Where to cut comes from a sample picked by a hash of key and order, ranked per
key, inside the same plan: no job runs while a query is planned, and the plan is the same with hot
keys and without. A cut is a whole tuple of the order columns, so rows that bunch together, share a
time or are ordered by text are cut like any others, as long as the tuple tells them apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewPolicy:
    """``max_rows``: rows of one key a task should hold. ``samples``: sampled rows a slice is
    measured by (256 put a slice's size within a fifth of ``max_rows``). ``salts``: parts a lookup
    join cuts every key into."""

    max_rows: int = 2_000_000
    samples: int = 256
    salts: int = 1


DEFAULT = SkewPolicy()

SLICE = "_slice"


def slice_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], policy: SkewPolicy = DEFAULT) -> DataFrame:
    """The hot keys of ``df`` with ``_cuts``, the sorted order tuples their slices start at.

    One row in ``max_rows / samples`` is looked at, only its keys and order columns, and only every
    ``samples``-th of a key becomes a cut: there is one cut for each ``max_rows`` rows of a hot
    key, and none elsewhere. The sample goes by values, so that computing it again, after a lost
    executor or in another branch of a plan, gives the same cuts.
    """
    every = max(1, policy.max_rows // policy.samples)
    step = policy.max_rows // every
    named = list(dict.fromkeys([*keys, *order]))
    thin = df.select(*named)
    if every > 1:
        thin = thin.where(F.pmod(F.xxhash64(*named), F.lit(every)) == 0)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    starts = thin.withColumn("_place", place).where((F.col("_place") > 1) & (F.col("_place") % step == 1 % step))
    return starts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_cuts"))


def one_key(column: str) -> Column:
    """The same key for all rows, as a value the planner doesn't fold: a join on a constant would
    lose its equality and become a nested loop."""
    return F.pmod(F.xxhash64(column), F.lit(1)).cast("int")


def cut_levels(hot: DataFrame) -> list[DataFrame]:
    """The cuts of hot keys as search trees of three levels, root first.

    With ``f`` the cube root of a key's number of cuts, block ``_block`` of a level holds up to ``f``
    of the cuts ``f * f``, ``f`` or one place apart; the cut at place ``t`` of a level opens block
    ``t`` of the next one.
    """
    n, fan = F.size("_cuts"), F.col("_fan")
    fanned = hot.withColumn("_fan", F.ceil(F.pow(F.size("_cuts"), F.lit(1 / 3))).cast("int"))

    def level(stride: Column) -> DataFrame:
        last = F.floor((n - 1) / stride).cast("int")
        block = lambda j: F.transform(F.sequence(j * fan, F.least((j + 1) * fan - 1, last)), lambda t: F.get("_cuts", t * stride))
        blocks = F.transform(F.sequence(F.lit(0), F.floor(last / fan).cast("int")), lambda j: F.struct(j.alias("_block"), block(j).alias("_some")))
        rows = fanned.select(*[c for c in hot.columns if c != "_cuts"], "_fan", F.inline(blocks))
        # the powers of two that a search among the cuts goes through
        powers = F.transform(F.sequence(F.floor(F.log2(F.size("_some"))).cast("int"), F.lit(0), F.lit(-1)), lambda e: F.pow(F.lit(2), e).cast("int"))
        return rows.withColumn("_powers", powers)

    return [level(fan * fan), level(fan), level(F.lit(1))]


def _place(order: Sequence[str]) -> Column:
    """The last place of a level whose cut a row stands at or behind, by binary search; -1 in front of all."""
    at = F.struct(*order)
    closer = lambda n, p: F.when(F.get("_some", n + p - 1) <= at, n + p).otherwise(n)
    found = F.aggregate("_powers", F.lit(0), closer)
    return F.when(found > 0, F.col("_block") * F.col("_fan") + found - 1).otherwise(-1)


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: DataFrame, only: bool = False) -> DataFrame:
    """``df`` with the row's slice of its key, NULL where the key isn't hot; or hot keys' rows ``only``.

    The cuts are broadcast: one for each ``max_rows`` rows of hot keys, 500,000 of some thirty
    bytes for 10^12 rows under the default policy. A joined row carries the array that it searches,
    so it goes down a tree of short arrays (``cut_levels``) and never meets all cuts of its key.
    """
    rows = df
    for depth, level in enumerate(cut_levels(hot)):
        table = F.broadcast(level.withColumnsRenamed({k: f"_k_{k}" for k in keys}))
        same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(table[f"_k_{k}"]) for k in keys])
        found = F.when(F.col("_some").isNotNull(), _place(order))
        if depth:  # a row in front of all cuts meets no block
            same = same & (F.col("_at") == F.col("_block"))
            found = F.coalesce(found, "_at")
        joined = rows.join(table, same, "inner" if only and not depth else "left")
        kept = [c for c in rows.columns if c != "_at"]
        rows = joined.select(*kept, found.alias("_at"))
    return rows.withColumn(SLICE, (F.col("_at") + 1).cast("int")).drop("_at")


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Join facts to a dimension table. Below the optimizer's byte threshold it is broadcast,
    at run time too, so that the facts stay where they are."""
    return lookup_join(facts, dimension, keys, how, spread_by, policy)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] = (),
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Join facts to a table with one (or a few) rows per key.

    Adaptive execution splits the facts of a hot key. Where it cannot, below an aggregate on the
    same keys say, a policy with ``salts`` spreads all keys over so many salts by a hash of
    ``spread_by`` (columns that vary inside the key) and repeats the lookup rows once per salt.
    """
    if policy.salts == 1:
        return facts.join(lookup, list(keys), how)
    varying = [F.col(c) for c in (spread_by or [c for c in facts.columns if c not in keys])]
    left = facts.withColumn("_salt", F.pmod(F.xxhash64(*varying), F.lit(policy.salts)).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(policy.salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
