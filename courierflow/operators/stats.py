"""Exact distribution statistics from value histograms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierflow.operators.sequence import running
from courierflow.operators.skew import DEFAULT, SkewPolicy, one_key


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    value: Column,
    points: dict[str, float],
    *extra: Column,
    digits: int = 6,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Exact interpolated percentiles of a column by distributed selection, with any extra aggregates.

    Rows are counted per distinct value, combined on the map side. A prefix scan over the values of
    each group gives the ranks a value covers, and only the values at the sought ranks go on: no
    task or buffer holds a group's values, however many differ. ``extra`` aggregates run over the
    histogram and may use ``_v`` (value) and ``_n`` (rows with that value).
    """
    histogram = df.where(value.isNotNull()).groupBy(*by, value.alias("_v")).agg(F.count("*").alias("_n"))
    if not by:
        histogram = histogram.withColumn("_all", one_key("_v"))
    keys = list(by) or ["_all"]
    ranked = running(histogram, keys, ["_v"], {"_upto": ("sum", F.col("_n"))}, policy)
    whole = histogram.groupBy(*keys).agg(F.sum("_n").alias("_total"), *extra)
    carried = [c for c in whole.columns if c not in keys]
    whole = whole.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [ranked[k].eqNullSafe(whole[f"_k_{k}"]) for k in keys])

    place = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in points.items()}
    sought = {name: (F.floor(at), F.ceil(at)) for name, at in place.items()}
    covers = lambda rank: (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))
    hit = reduce(lambda a, b: a | b, [covers(r) for pair in sought.values() for r in pair])
    found = ranked.join(whole, same).where(hit).groupBy(*keys, *carried).agg(
        *[F.max(F.when(covers(r), F.col("_v"))).alias(f"_{end}_{name}") for name, pair in sought.items() for end, r in zip("ab", pair)]
    )

    def between(name: str) -> Column:
        low, high = F.col(f"_a_{name}").cast("double"), F.col(f"_b_{name}").cast("double")
        mixed = (F.ceil(place[name]) - place[name]) * low + (place[name] - F.floor(place[name])) * high
        return F.round(F.when(low == high, low).otherwise(mixed), digits).alias(name)

    return found.select(*by, *[c for c in carried if c != "_total"], *[between(name) for name in points])


def mean_of_histogram(digits: int = 6) -> Column:
    return F.round(F.sum(F.col("_v") * F.col("_n")) / F.sum("_n"), digits)


def stddev_of_histogram(digits: int = 6) -> Column:
    """Sample standard deviation."""
    v, total = F.col("_v").cast("double"), F.sum("_n")
    mean = F.sum(v * F.col("_n")) / total
    spread = F.sum(v * v * F.col("_n")) - mean * mean * total
    return F.round(F.sqrt(F.try_divide(F.greatest(F.lit(0.0), spread), (total - 1).cast("double"))), digits)
