"""Duplicates, lateness and ordering of event streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierflow.operators.sequence import running, windowed
from courierflow.operators.skew import DEFAULT, SkewPolicy


def dedup(events: DataFrame, key: str = "event_id", order: Sequence[str] = ("off",)) -> DataFrame:
    """First arrival of each event. The rank filter runs before the shuffle too, so the
    copies of one event collapse on the map side."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return events.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def duplicate_rate(events: DataFrame, by: str, key: str = "event_id") -> DataFrame:
    per_event = events.groupBy(by, key).agg(F.count("*").alias("_copies"))
    out = per_event.groupBy(by).agg(F.sum("_copies").alias("events"), F.count("*").alias("distinct_events"))
    extra = F.col("events") - F.col("distinct_events")
    return out.withColumns({"duplicates": extra, "duplicate_rate": F.round(F.try_divide(extra, F.col("events")), 6)})


def approx_duplicate_rate(events: DataFrame, by: str, key: str = "event_id", rsd: float = 0.01) -> DataFrame:
    """One-shuffle estimate with a sketch per group instead of a row per event."""
    out = events.groupBy(by).agg(F.count("*").alias("events"), F.approx_count_distinct(key, rsd).alias("_d"))
    return out.select(by, "events", F.greatest(F.lit(0.0), 1 - F.col("_d") / F.col("events")).alias("duplicate_rate"))


def duplicate_sketches(events: DataFrame, by: Sequence[str], key: str = "event_id", lg_k: int = 16) -> DataFrame:
    """Rows and a mergeable sketch of the distinct keys of each group: what is kept of a day, say, so
    that later days never read it again. ``lg_k`` 16 errs by 0.4 % and takes 32 KB at most."""
    return events.groupBy(*by).agg(F.count("*").alias("events"), F.hll_sketch_agg(key, lg_k).alias("sketch"))


def merged_duplicate_rate(sketches: DataFrame, by: Sequence[str], digits: int = 3) -> DataFrame:
    """Duplicate rate over any union of groups, from their sketches alone."""
    merged = sketches.groupBy(*by).agg(F.sum("events").alias("events"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_d"))
    rate = F.greatest(F.lit(0.0), 1 - F.col("_d") / F.col("events"))
    return merged.select(*by, "events", F.round(rate, digits).alias("duplicate_rate"))


def lateness(
    events: DataFrame, partition: str = "part", offset: str = "off", time: str = "event_s", policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """``late_s``: how far an event lies behind the newest event that arrived before it
    in its partition. A partition is one long sequence, so it is sliced by offset."""
    seen = running(events, [partition], [offset], {"newest_s": ("max", F.col(time))}, policy)
    return seen.withColumn("late_s", F.col("newest_s") - F.col(time))


def out_of_order(
    events: DataFrame, partition: str = "part", offset: str = "off", time: str = "event_s", policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """``is_out_of_order``: the preceding record of the partition has a later event time."""
    return windowed(
        events,
        [partition],
        [offset],
        lambda w: {"is_out_of_order": F.coalesce(F.lag(time).over(w) > F.col(time), F.lit(False))},
        before=1,
        policy=policy,
    )


def lateness_profile(events: DataFrame, by: str, bounds: Sequence[int], policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Events per lateness class; ``bounds`` are the class edges in seconds."""
    late = lateness(events, policy=policy)
    label: Column = F.lit(f"over_{bounds[-1]}s")
    for bound in sorted(bounds, reverse=True):
        label = F.when(F.col("late_s") <= bound, f"within_{bound}s").otherwise(label)
    return (
        late.groupBy(by, label.alias("lateness"))
        .agg(F.count("*").alias("events"), F.max("late_s").alias("max_late_s"))
    )
