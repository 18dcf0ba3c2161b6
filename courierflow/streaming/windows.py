"""Event-time operators over streams. Each takes and returns a streaming DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierflow.functions.scoring import is_over_capacity


def with_watermark(stream: DataFrame, delay: str, epoch_s: str = "event_s") -> DataFrame:
    """Turn epoch seconds into the TIMESTAMP a watermark needs."""
    return stream.withColumn("event_ts", F.timestamp_seconds(epoch_s)).withWatermark("event_ts", delay)


def _window_columns(df: DataFrame) -> DataFrame:
    start, end = F.unix_seconds("window.start"), F.unix_seconds("window.end")
    return df.select(start.alias("window_s"), end.alias("window_end_s"), *[c for c in df.columns if c != "window"])


def counts(events: DataFrame, key: str, width: str, delay: str) -> DataFrame:
    """Events per key and tumbling window. Rows whose window closed before they arrived are
    dropped, and the query's progress reports them."""
    out = with_watermark(events, delay).groupBy(F.window("event_ts", width), key).agg(F.count("*").alias("events"))
    return _window_columns(out)


def tumbling_orders(orders: DataFrame, width: str, delay: str) -> DataFrame:
    """Placed orders and their value per zone and window."""
    placed = with_watermark(orders.where(F.col("state") == "PLACED"), delay)
    out = placed.groupBy(F.window("event_ts", width), "zone_id").agg(F.count("*").alias("orders"))
    return _window_columns(out)


def sliding_failures(payments: DataFrame, width: str, slide: str, delay: str) -> DataFrame:
    """Terminal and failed payment results per gateway and sliding window."""
    results = with_watermark(payments.where(F.col("status").isin("SUCCESS", "FAILED")), delay)
    out = results.groupBy(F.window("event_ts", width, slide), "gateway").agg(
        F.count("*").alias("results"), F.count_if(F.col("status") == "FAILED").alias("failed")
    )
    return _window_columns(out)


def sessions(events: DataFrame, key: str, gap: str, delay: str) -> DataFrame:
    """Bursts of events per key with silences shorter than ``gap``."""
    out = with_watermark(events, delay).groupBy(F.session_window("event_ts", gap).alias("window"), key)
    return _window_columns(out.agg(F.count("*").alias("events")))


def dedup(events: DataFrame, delay: str, key: str = "event_id") -> DataFrame:
    """Drop repeats of an event that arrive within the watermark delay."""
    return with_watermark(events, delay).dropDuplicatesWithinWatermark([key]).drop("event_ts")


def matched_pairs(
    first: DataFrame, second: DataFrame, keys: Sequence[str], within_s: int, delay: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Events of ``first`` with the events of ``second`` of the same keys that follow within
    ``within_s`` seconds: ``keys``, ``carry`` columns of the first, ``first_s``, ``took_s``.

    The time slot is part of the join key, so a key with very many events spreads over
    slots and old slots leave the state. A second event looks into its own and the
    preceding slot, which together hold every first event it may match.
    """
    slot = F.floor(F.col("event_s") / F.lit(within_s))

    def side(rows: DataFrame, name: str, slots: Column, more: Sequence[str]) -> DataFrame:
        renamed = [F.col(c).alias(f"{name}_{c}") for c in (*keys, "event_s", "event_ts", *more)]
        return with_watermark(rows, delay).select(*renamed, slots.alias(f"{name}_slot"))

    a = side(first, "a", slot, carry)
    b = side(second, "b", F.explode(F.array(slot - 1, slot)), ())
    until = F.col("a_event_ts") + F.make_dt_interval(secs=F.lit(within_s))
    same = reduce(lambda x, y: x & y, [F.col(f"a_{k}") == F.col(f"b_{k}") for k in (*keys, "slot")])
    joined = a.join(b, same & (F.col("b_event_ts") >= F.col("a_event_ts")) & (F.col("b_event_ts") <= until))
    return joined.select(
        *[F.col(f"a_{c}").alias(c) for c in (*keys, *carry)],
        F.col("a_event_s").alias("first_s"),
        (F.col("b_event_s") - F.col("a_event_s")).alias("took_s"),
    )


def accept_latency(orders: DataFrame, within_s: int, delay: str) -> DataFrame:
    """PLACED to ACCEPTED per order."""
    of = lambda state: orders.where(F.col("state") == state)
    pairs = matched_pairs(of("PLACED"), of("ACCEPTED"), ["order_id"], within_s, delay, ["zone_id"])
    return pairs.withColumnsRenamed({"first_s": "placed_s", "took_s": "latency_s"})


def pickup_wait(status: DataFrame, within_s: int, delay: str) -> DataFrame:
    """WAITING_AT_RESTAURANT to PICKED_UP per partner and order."""
    of = lambda state: status.where(F.col("status") == state)
    pairs = matched_pairs(of("WAITING_AT_RESTAURANT"), of("PICKED_UP"), ["dp_id", "order_id"], within_s, delay)
    return pairs.withColumnsRenamed({"first_s": "waiting_s", "took_s": "wait_s"})


def backlog_windows(status: DataFrame, width: str, delay: str) -> DataFrame:
    """Average and greatest load and share of full reports per restaurant and window."""
    load = F.try_divide(F.col("current_backlog"), F.col("capacity_orders"))
    full = F.when(is_over_capacity(F.col("current_backlog"), F.col("capacity_orders")), 1.0).otherwise(0.0)
    out = with_watermark(status, delay).groupBy(F.window("event_ts", width), "restaurant_id").agg(
        F.count("*").alias("reports"),
        F.round(F.avg(load), 6).alias("avg_load"),
        F.round(F.max(load), 6).alias("max_load"),
        F.round(F.avg(full), 6).alias("busy_share"),
    )
    return _window_columns(out)


def enrich(stream: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Join each batch to a static dimension; its size decides the strategy at run time."""
    return stream.join(dimension, key, "left")
