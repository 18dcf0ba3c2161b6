"""Partner supply: utilization, idle pool, supply-demand ratio, deficit, illegal moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.functions import clock, scoring
from courierflow.operators.intervals import dense_buckets, running_level, spread_over_buckets
from courierflow.operators.sequence import latest, windowed
from courierflow.operators.skew import DEFAULT, SkewPolicy
from courierflow.states import NOT_BUSY, legal_moves_frame

_ORDER = ["event_s", "event_id"]


def status_spans(status: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Each status event with the time (``until_s``) and status of the partner's next event."""
    rows = status.select("dp_id", "zone_id", "event_s", "event_id", "status", "order_id")
    return windowed(
        rows,
        ["dp_id"],
        _ORDER,
        lambda w: {"until_s": F.lead("event_s").over(w), "next_status": F.lead("status").over(w)},
        after=1,
        policy=policy,
    )


def utilization(status: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Busy over online seconds per partner; the open last span is left out."""
    took = F.col("until_s") - F.col("event_s")
    out = (
        status_spans(status, policy)
        .where(F.col("until_s").isNotNull())
        .groupBy("dp_id")
        .agg(
            F.sum(F.when(~F.col("status").isin(*NOT_BUSY), took).otherwise(0)).alias("busy_s"),
            F.sum(F.when(F.col("status") != "OFFLINE", took).otherwise(0)).alias("online_s"),
        )
    )
    return out.withColumn("utilization", F.round(F.try_divide(F.col("busy_s"), F.col("online_s")), 6))


def utilization_hourly(status: DataFrame, seconds: int = 3600, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Busy and online partner-seconds per zone and hour."""
    spans = status_spans(status, policy).where(F.col("until_s") > F.col("event_s"))
    busy = F.when(F.col("status").isin(*NOT_BUSY), 0).otherwise(1)
    online = F.when(F.col("status") == "OFFLINE", 0).otherwise(1)
    out = spread_over_buckets(spans, ["zone_id"], "event_s", "until_s", seconds, {"busy_s": busy, "online_s": online})
    return out.withColumn("utilization", F.round(F.try_divide(F.col("busy_s"), F.col("online_s")), 6))


def idle_at_bucket_ends(status: DataFrame, seconds: int, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Changes of the idle count at bucket ends: +1 at the first end a partner is idle at,
    -1 at the first end it no longer is. A running sum gives the as-of count of every
    bucket without a partner x bucket grid."""
    idle = status_spans(status, policy).where(F.col("status") == "IDLE")
    size = F.lit(seconds).cast("long")
    # bucket whose end (start + seconds) is the first one at or after a time
    def holding(t):
        return F.ceil(t / size).cast("long") * size - size

    marks = F.array(
        F.struct(holding(F.col("event_s")).alias("window_s"), F.lit(1).alias("_d")),
        F.struct(holding(F.col("until_s")).alias("window_s"), F.lit(-1).alias("_d")),
    )
    return idle.select("zone_id", F.inline(marks)).where(F.col("window_s").isNotNull())


def supply_demand_ratio(
    status: DataFrame, orders: DataFrame, seconds: int = 3600, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Idle partners at the window's end per order placed in it, by zone.

    An event exactly at the window's end counts, as ``as of`` includes its moment.
    """
    idle = idle_at_bucket_ends(status, seconds, policy).withColumn("_o", F.lit(0))
    placed = orders.where(F.col("state") == "PLACED").select(
        "zone_id",
        clock.bucket_start(F.col("event_s"), seconds).alias("window_s"),
        F.lit(0).alias("_d"),
        F.lit(1).alias("_o"),
    )
    summed = idle.unionByName(placed).groupBy("zone_id", "window_s").agg(
        F.sum("_d").alias("idle_partners"), F.sum("_o").alias("orders_placed")
    )
    grid = dense_buckets(summed, ["zone_id"], "window_s", seconds)
    filled = grid.join(summed, ["zone_id", "window_s"], "left").fillna(0)
    level = running_level(filled, ["zone_id"], "window_s", ["idle_partners"])
    return level.withColumn("ratio", F.round(F.try_divide(F.col("idle_partners"), F.col("orders_placed")), 6))


def partner_state(status: DataFrame, as_of_s: int | None = None) -> DataFrame:
    """Latest status per partner, optionally as of a moment."""
    seen = status if as_of_s is None else status.where(F.col("event_s") <= as_of_s)
    return latest(seen.select("dp_id", "zone_id", "status", *_ORDER), ["dp_id"], _ORDER).drop("event_id")


def idle_pool(status: DataFrame, as_of_s: int | None = None) -> DataFrame:
    return partner_state(status, as_of_s).groupBy("zone_id").agg(
        F.count_if(F.col("status") == "IDLE").alias("idle"), F.count_if(F.col("status") != "OFFLINE").alias("online")
    )


def illegal_partner_moves(status: DataFrame, machines=("dp", "dp_observed"), policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Moves outside the transition table. The previous state comes from the event order:
    the payload's own ``previous_status`` is wrong on release."""
    moves = windowed(
        status.select("dp_id", "status", *_ORDER),
        ["dp_id"],
        _ORDER,
        lambda w: {"from_state": F.lag("status").over(w)},
        before=1,
        policy=policy,
    ).select("event_id", "dp_id", "event_s", "from_state", F.col("status").alias("to_state"))
    legal = legal_moves_frame(status.sparkSession, *machines)
    return moves.where("from_state IS NOT NULL").join(F.broadcast(legal), ["from_state", "to_state"], "left_anti")


def supply_deficit(
    status: DataFrame,
    partners: DataFrame,
    as_of_s: int,
    base_ratio: float = 0.55,
    peak_ratio: float = 0.80,
    shortage_zones: tuple[str, ...] = (),
    shortage_factor: float = 0.6,
) -> DataFrame:
    """Online partners of each zone against the target for the hour."""
    hour = clock.hour_of_day(F.lit(as_of_s))
    ratio = F.when(clock.peak_label(hour) == clock.OFF_PEAK, base_ratio).otherwise(peak_ratio)
    ratio = ratio * F.when(F.col("zone_id").isin(*shortage_zones), shortage_factor).otherwise(1.0)
    now = partner_state(status, as_of_s).select("dp_id", "status")
    known = partners.select("dp_id", "zone_id").join(now, "dp_id", "left")
    online = F.coalesce(F.col("status") != "OFFLINE", F.lit(False))
    zone = known.groupBy("zone_id").agg(
        F.count("*").alias("partners"),
        F.count_if(online).alias("online"),
        F.count_if(F.col("status") == "IDLE").alias("idle"),
    )
    gap = F.col("target") - F.col("online")
    return zone.withColumn("target", scoring.supply_target(F.col("partners"), ratio)).withColumns(
        {
            "deficit": F.greatest(gap, F.lit(0)),
            "surplus": F.greatest(-gap, F.lit(0)),
            # a call goes to as many offline partners as there are; only idle ones are sent home
            "to_call": F.least(F.greatest(gap, F.lit(0)), F.col("partners") - F.col("online")),
            "to_release": F.least(F.greatest(-gap, F.lit(0)), F.col("idle")),
        }
    )
