"""Intervals against a time grid, without expanding each interval over the grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_buckets(df: DataFrame, by: Sequence[str], bucket: str, seconds: int) -> DataFrame:
    """All buckets between the first and last of each group of an aggregated frame."""
    ends = df.groupBy(*by).agg(F.min(bucket).alias("_a"), F.max(bucket).alias("_b"))
    return ends.select(*by, F.explode(F.sequence("_a", "_b", F.lit(seconds).cast("long"))).alias(bucket))


def running_level(changes: DataFrame, by: Sequence[str], bucket: str, columns: Sequence[str]) -> DataFrame:
    """Running sums over buckets. Input is aggregated: one row per group and bucket."""
    w = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    return changes.withColumns({c: F.sum(c).over(w) for c in columns})


def spread_over_buckets(
    spans: DataFrame, by: Sequence[str], start: str, end: str, seconds: int, measures: dict[str, Column]
) -> DataFrame:
    """Seconds of ``[start, end)`` that fall into each bucket, summed per group.

    A span gives at most four rows whatever its length: its parts in the first and last
    bucket, and the +1/-1 marks of the full buckets between, which a running sum over the
    (small) aggregated grid turns into full-bucket counts. ``measures`` maps a result
    column to the 0/1 weight of a span.
    """
    size = F.lit(seconds).cast("long")
    first, last = F.col(start) - F.pmod(F.col(start), size), F.col(end) - F.pmod(F.col(end), size)
    same = first == last
    zero = F.lit(0).cast("long")

    def mark(at: Column, part: Column, open_: Column) -> Column:
        return F.struct(at.alias("bucket_s"), part.alias("_part"), open_.cast("long").alias("_open"))

    marks = F.array(
        mark(first, F.when(same, F.col(end)).otherwise(first + size) - F.col(start), zero),
        mark(last, F.when(same, zero).otherwise(F.col(end) - last), zero),
        mark(F.when(same, first).otherwise(first + size), zero, F.when(same, 0).otherwise(1)),
        mark(last, zero, F.when(same, 0).otherwise(-1)),
    )
    rows = spans.select(*by, *[m.alias(f"_w_{n}") for n, m in measures.items()], F.inline(marks))
    aggs = []
    for n in measures:
        aggs.append(F.sum(F.col("_part") * F.col(f"_w_{n}")).alias(f"_p_{n}"))
        aggs.append(F.sum(F.col("_open") * F.col(f"_w_{n}")).alias(f"_o_{n}"))
    summed = rows.groupBy(*by, "bucket_s").agg(*aggs)
    filled = dense_buckets(summed, by, "bucket_s", seconds).join(summed, [*by, "bucket_s"], "left").fillna(0)
    level = running_level(filled, by, "bucket_s", [f"_o_{n}" for n in measures])
    return level.select(
        *by, "bucket_s", *[(F.col(f"_p_{n}") + F.col(f"_o_{n}") * size).alias(n) for n in measures]
    )
