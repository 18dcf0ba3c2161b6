"""Restaurant metrics: backlog, busy share, uptime, selection weight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.functions import clock, scoring
from courierflow.operators.sequence import latest, running, windowed
from courierflow.operators.skew import DEFAULT, SkewPolicy, slice_cuts
from courierflow.plans.orders import order_times


def backlog_latest(status: DataFrame) -> DataFrame:
    """Latest backlog against capacity per restaurant."""
    rows = status.select("restaurant_id", "zone_id", "event_s", "event_id", "current_backlog", "capacity_orders")
    load = F.round(F.try_divide(F.col("current_backlog"), F.col("capacity_orders")), 6)
    return latest(rows, ["restaurant_id"], ["event_s", "event_id"]).drop("event_id").withColumn("load", load)


def backlog_windowed(status: DataFrame, seconds: int) -> DataFrame:
    load = F.try_divide(F.col("current_backlog"), F.col("capacity_orders"))
    busy = F.when(scoring.is_over_capacity(F.col("current_backlog"), F.col("capacity_orders")), 1.0).otherwise(0.0)
    return status.groupBy("restaurant_id", clock.bucket_start(F.col("event_s"), seconds).alias("window_s")).agg(
        F.count("*").alias("reports"),
        F.round(F.avg(load), 6).alias("avg_load"),
        F.round(F.max(load), 6).alias("max_load"),
        F.round(F.avg(busy), 6).alias("busy_share"),
    )


def busy_audit(status: DataFrame) -> DataFrame:
    """Reports at or over capacity, and heartbeats whose flag says otherwise."""
    full = scoring.is_over_capacity(F.col("current_backlog"), F.col("capacity_orders"))
    heartbeat = F.col("status").isin("BUSY", "NORMAL")
    return status.groupBy("restaurant_id").agg(
        F.count_if(heartbeat).alias("heartbeats"),
        F.count_if(full).alias("full_reports"),
        F.max("current_backlog").alias("max_backlog"),
        F.count_if(heartbeat & (full != (F.col("status") == "BUSY"))).alias("wrong_flags"),
    )


def backlog_running(events: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Backlog rebuilt from order events: +1 on ACCEPTED, -1 on READY or a later cancel.

    The counter never goes below zero. With S the running sum, the floored counter is
    S - min(0, running minimum of S), so two running aggregates give it exactly.
    """
    times = order_times(events).where(F.col("accepted_s").isNotNull())
    cancel = F.when(F.col("cancelled_s") > F.col("accepted_s"), F.col("cancelled_s"))
    changes = times.select(
        "restaurant_id",
        "order_id",
        F.inline(
            F.array(
                F.struct(F.col("accepted_s").alias("event_s"), F.lit(1).alias("delta")),
                F.struct(F.least("ready_s", cancel).alias("event_s"), F.lit(-1).alias("delta")),
            )
        ),
    ).where(F.col("event_s").isNotNull())
    key, order = ["restaurant_id"], ["event_s", "order_id", "delta"]
    cuts = slice_cuts(changes, key, order, policy)
    level = running(changes, key, order, {"level": ("sum", F.col("delta"))}, policy, cuts)
    low = running(level, key, order, {"lowest": ("min", F.col("level"))}, policy, cuts)
    return low.select(*key, *order, (F.col("level") - F.least(F.lit(0), F.col("lowest"))).alias("backlog"))


def uptime(status: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Online seconds between ONLINE/OFFLINE events; heartbeats say nothing about uptime."""
    switches = status.where(F.col("status").isin("ONLINE", "OFFLINE")).select("restaurant_id", "event_s", "event_id", "status")
    spans = windowed(
        switches,
        ["restaurant_id"],
        ["event_s", "event_id"],
        lambda w: {"took_s": F.lead("event_s").over(w) - F.col("event_s")},
        after=1,
        policy=policy,
    )
    online = F.sum(F.when(F.col("status") == "ONLINE", F.col("took_s")).otherwise(0))
    out = spans.where(F.col("took_s").isNotNull()).groupBy("restaurant_id").agg(
        online.alias("online_s"), F.sum("took_s").alias("observed_s")
    )
    return out.withColumn("uptime", F.round(F.try_divide(F.col("online_s"), F.col("observed_s")), 6))


def weight_rank(restaurants: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Selection weight of the online restaurants and their rank in the zone."""
    weight = F.round(scoring.restaurant_weight(F.col("rating"), F.col("current_backlog")), 6)
    online = restaurants.where("is_online").select("restaurant_id", "zone_id", weight.alias("weight"))
    ordered = online.withColumn("_down", -F.round(F.col("weight") * 1_000_000).cast("long"))
    return running(ordered, ["zone_id"], ["_down", "restaurant_id"], {"rank": ("sum", F.lit(1))}, policy).drop("_down")
