"""Ordered operators that never need all rows of a key in one task: a prefix scan over slices.

``Window.partitionBy(key)`` sorts a key's rows in one task, which a hot key turns into a straggler.
Here the window runs per ``(key, slice)``, with the slices of ``skew.slice_cuts``; keys that aren't
hot are one slice. What a slice has to know about the rest of its key travels in as extra *carry*
rows: the nearest rows of the neighbouring slices for ``lag``/``lead``, or one row with the totals
of all earlier slices (an exclusive scan of the slices' summaries) for running aggregates. Carry
rows come from summaries of hot keys only and are dropped again at the end. The rows themselves
are shuffled once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from courierflow.operators.skew import DEFAULT, SLICE, SkewPolicy, slice_cuts, sliced

HALO = "_halo"
Stage = Callable[[WindowSpec], dict[str, Column]]


def _edge_rows(hot: DataFrame, keys: Sequence[str], order: Sequence[str], depth: int, before: bool) -> DataFrame:
    """For each slice of a hot key, the ``depth`` rows just before (or after) it."""
    ranked = [F.col(c).desc() if before else F.col(c).asc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*ranked))
    edges = hot.withColumn("_rank", rank).where(F.col("_rank") <= depth)
    payload = [c for c in hot.columns if c not in {*keys, *order, SLICE}]
    packed = F.sort_array(F.collect_list(F.struct(*order, *payload)))  # at most `depth` rows
    per_slice = edges.groupBy(*keys, SLICE).agg(packed.alias("_rows"))
    near = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(*((-depth, -1) if before else (1, depth)))
    pool = per_slice.withColumn("_near", F.flatten(F.collect_list("_rows").over(near)))
    start = F.greatest(F.size("_near") - depth, F.lit(0)) + 1 if before else F.lit(1)
    return pool.select(*keys, SLICE, F.inline(F.slice("_near", start, F.lit(depth))))


# kind -> (aggregate of a slice, window function over slices and over rows)
_KINDS = {
    "sum": (lambda x, at: F.sum(x), F.sum),
    "xor": (lambda x, at: F.bit_xor(x), F.bit_xor),
    "max": (lambda x, at: F.max(x), F.max),
    "min": (lambda x, at: F.min(x), F.min),
    "last": (lambda x, at: F.max(F.when(x.isNotNull(), F.struct(at, x.alias("v")))).getField("v"),
             lambda x: F.last(x, ignorenulls=True)),
}


def _total_rows(hot: DataFrame, keys: Sequence[str], order: Sequence[str], kinds: dict[str, str]) -> DataFrame:
    """For each slice of a hot key, one row with the totals of all earlier slices."""
    at = F.struct(*[F.col(c) for c in order]).alias("at")
    totals = [_KINDS[kind][0](F.col(c), at).alias(c) for c, kind in kinds.items()]
    per_slice = hot.groupBy(*keys, SLICE).agg(*totals)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sums = [_KINDS[kind][1](F.col(c)).over(earlier).alias(c) for c, kind in kinds.items()]
    return per_slice.select(*keys, SLICE, *sums)


def sweep(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, tuple[str, Column]] | None = None,
    stages: Sequence[Stage] = (),
    before: int = 0,
    after: int = 0,
    policy: SkewPolicy = DEFAULT,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """One pass over each key's rows in ``order``: running totals, then window expressions.

    ``totals`` maps a column to ``(kind, expression)`` with kind ``sum``, ``xor``, ``max``, ``min``
    or ``last`` (last value that is not NULL), from the key's first row up to the current
    one; a kind with the suffix ``_before`` leaves the current row out. ``stages`` map a
    window to further columns, which may reach ``before``/``after`` neighbouring rows of
    the input; a later stage may use the columns of an earlier one. ``order`` must be unique
    within a key for a deterministic result, and for a hot key's slices to stay small. Pass
    ``cuts`` (of ``slice_cuts``) to share them between passes over the same keys and order.
    """
    totals = totals or {}
    kinds = {n: kind.removesuffix("_before") for n, (kind, _) in totals.items()}
    cuts = slice_cuts(df, keys, order, policy) if cuts is None else cuts
    rows = df.withColumns({f"_in_{n}": expr for n, (_, expr) in totals.items()}) if totals else df
    parts = [sliced(rows, keys, order, cuts).withColumn(HALO, F.lit(0))]
    if totals:
        hot = sliced(rows, keys, order, cuts, only=True)
        parts.append(_total_rows(hot, keys, order, {f"_in_{n}": k for n, k in kinds.items()}).withColumn(HALO, F.lit(-2)))
    for depth, is_before, mark in ((before, True, -1), (after, False, 1)):
        if depth:
            hot = sliced(df, keys, order, cuts, only=True)
            parts.append(_edge_rows(hot, keys, order, depth, is_before).withColumn(HALO, F.lit(mark)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    window = Window.partitionBy(*keys, SLICE).orderBy(HALO, *order)

    def total(name: str, kind: str) -> Column:
        last = -1 if kind.endswith("_before") else 0
        frame = window.rowsBetween(Window.unboundedPreceding, last)
        return _KINDS[kinds[name]][1](F.col(f"_in_{name}")).over(frame)

    if totals:
        rows = rows.withColumns({n: total(n, kind) for n, (kind, _) in totals.items()})
        rows = rows.drop(*[f"_in_{n}" for n in totals])
    if totals and stages:
        rows = rows.where(F.col(HALO) > -2)  # neighbours are real rows only
    for stage in stages:
        rows = rows.withColumns(stage(window))
    return rows.where(F.col(HALO) == 0).drop(HALO, SLICE)


def windowed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *stages: Stage,
    before: int = 0,
    after: int = 0,
    policy: SkewPolicy = DEFAULT,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Window expressions over each key's rows in ``order`` (see ``sweep``)."""
    return sweep(df, keys, order, None, stages, before, after, policy, cuts)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, tuple[str, Column]],
    policy: SkewPolicy = DEFAULT,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Running totals over each key's rows in ``order`` (see ``sweep``)."""
    return sweep(df, keys, order, totals, policy=policy, cuts=cuts)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key. The rank filter is applied before the shuffle as well
    (``WindowGroupLimit``), so a map task sends at most one row per key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def asof_join(
    probes: DataFrame,
    states: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Give each probe row the ``values`` (and ``asof_<time>``) of the last state row of its
    key at or before its time. One pass over probes and states together; no pairs are built.
    Among state rows of equal time the greatest value wins."""
    state = F.struct(F.col(time).alias(f"asof_{time}"), *values)
    stacked = probes.withColumn("_kind", F.lit(1)).unionByName(
        states.select(*keys, time, state.alias("_state")).withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )
    carried = running(stacked, keys, [time, "_kind", "_state"], {"_asof": ("last", F.col("_state"))}, policy)
    return carried.where(F.col("_kind") == 1).select(*probes.columns, "_asof.*")
