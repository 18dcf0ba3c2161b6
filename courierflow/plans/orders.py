"""Order life-cycle metrics: current state, funnel, acceptance, ETA, cancellation, demand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierflow.functions import clock, geo, scoring
from courierflow.operators.sequence import latest, windowed
from courierflow.operators.skew import DEFAULT, SkewPolicy, dimension_join, lookup_join
from courierflow.operators.stats import mean_of_histogram, percentiles, stddev_of_histogram
from courierflow.states import ORDER_STATES, ORDER_TERMINAL, legal_moves_frame, state_ordinal

ORDER_KEY = ("order_id", "zone_id", "restaurant_id")


def time_of(state: str, when: Column | None = None) -> Column:
    hit = F.col("state") == state
    return F.min(F.when(hit if when is None else hit & when, F.col("event_s")))


def order_times(events: DataFrame) -> DataFrame:
    """One row per order with the first time of every state (a pivot by conditional min).

    All buffers are fixed-width, so this is a map-side combined hash aggregate; orders
    with many events collapse before the shuffle.
    """
    silent = F.col("cancelled_by").eqNullSafe("SYSTEM") & F.col("cancellation_reason").eqNullSafe("restaurant_no_response")
    return events.groupBy(*ORDER_KEY).agg(
        *[time_of(s).alias(f"{s.lower()}_s") for s in ORDER_STATES],
        time_of("CANCELLED", silent).alias("no_response_s"),
        F.min("promised_s").alias("promised_s"),
        # value and item count are only meaningful on the PLACED event
        F.max(F.when(F.col("state") == "PLACED", F.col("order_value_inr"))).alias("order_value_inr"),
        F.max("dp_id").alias("dp_id"),
    )


def order_restaurants(events: DataFrame) -> DataFrame:
    """Restaurant per order, hash-partitioned by the order and so ready to join on it."""
    return events.groupBy("order_id").agg(F.max("restaurant_id").alias("restaurant_id"))


def current_orders(events: DataFrame, as_of_s: int | None = None) -> DataFrame:
    """Latest state per order, optionally as of a moment."""
    seen = events if as_of_s is None else events.where(F.col("event_s") <= as_of_s)
    rank = state_ordinal(F.col("state"))
    ranked = seen.select("order_id", "zone_id", "restaurant_id", "state", "event_s", rank.alias("_ord"))
    return latest(ranked, ["order_id"], ["event_s", "_ord"]).drop("_ord")


def active_orders(events: DataFrame, as_of_s: int | None = None) -> DataFrame:
    return current_orders(events, as_of_s).where(~F.col("state").isin(*ORDER_TERMINAL))


def illegal_order_moves(events: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Moves that are not in the transition table; CANCELLED is legal from any state."""
    rows = events.select("order_id", "event_s", "state", state_ordinal(F.col("state")).alias("_ord"))
    moves = windowed(
        rows,
        ["order_id"],
        ["event_s", "_ord"],
        lambda w: {"from_state": F.lag("state").over(w)},
        before=1,
        policy=policy,
    ).select("order_id", "event_s", "from_state", F.col("state").alias("to_state"))
    suspects = moves.where(F.col("from_state").isNotNull() & (F.col("to_state") != "CANCELLED"))
    legal = legal_moves_frame(events.sparkSession, "order")
    return suspects.join(F.broadcast(legal), ["from_state", "to_state"], "left_anti")


def order_funnel(events: DataFrame) -> DataFrame:
    """Orders of each zone that reached each state."""
    reached = [F.count(f"{s.lower()}_s").alias(s.lower()) for s in ORDER_STATES]
    return order_times(events).groupBy("zone_id").agg(F.count("*").alias("orders"), *reached)


# consecutive stages of a delivered order
STAGES = (
    ("PLACED", "ACCEPTED"),
    ("ACCEPTED", "READY"),
    ("READY", "ASSIGNED"),
    ("ASSIGNED", "PICKED_UP"),
    ("PICKED_UP", "DELIVERED"),
)


def stage_durations(events: DataFrame) -> DataFrame:
    """Mean, median and p95 seconds per stage over the orders that completed the stage."""
    spans = [
        F.struct(F.lit(f"{a}->{b}").alias("stage"), (F.col(f"{b.lower()}_s") - F.col(f"{a.lower()}_s")).alias("took_s"))
        for a, b in STAGES
    ]
    long = order_times(events).select(F.inline(F.array(*spans)))
    return percentiles(
        long,
        ["stage"],
        F.col("took_s"),
        {"p50_s": 0.5, "p95_s": 0.95},
        F.sum("_n").alias("orders"),
        mean_of_histogram().alias("mean_s"),
    )


def acceptance(events: DataFrame, sla_s: int = 90) -> DataFrame:
    """Acceptance rate and restaurant response time per zone."""
    orders = order_times(events).withColumn("latency_s", F.least("accepted_s", "rejected_s") - F.col("placed_s"))
    answered = F.col("accepted") + F.col("rejected") + F.col("no_response")
    rate = orders.groupBy("zone_id").agg(
        F.count("accepted_s").alias("accepted"),
        F.count("rejected_s").alias("rejected"),
        F.count("no_response_s").alias("no_response"),
    )
    latency = percentiles(
        orders,
        ["zone_id"],
        F.col("latency_s"),
        {"p50_latency_s": 0.5, "p95_latency_s": 0.95},
        mean_of_histogram().alias("avg_latency_s"),
        F.round(F.sum(F.when(F.col("_v") > sla_s, F.col("_n")).otherwise(0)) / F.sum("_n"), 6).alias("over_sla_share"),
    )
    rated = rate.withColumn("acceptance_rate", F.round(F.try_divide(F.col("accepted"), answered), 6))
    return rated.join(latency, "zone_id", "left")


def eta_variance(events: DataFrame, by: Sequence[str] = ("zone_id",), policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Delivered minus promised, in seconds; negative is early."""
    orders = order_times(events).where(F.col("delivered_s").isNotNull())
    return percentiles(
        orders,
        list(by),
        F.col("delivered_s") - F.col("promised_s"),
        {"p50_error_s": 0.5, "p95_error_s": 0.95},
        F.sum("_n").alias("delivered"),
        mean_of_histogram(4).alias("mean_error_s"),
        stddev_of_histogram(4).alias("stddev_error_s"),
        F.round(F.sum(F.when(F.col("_v") <= 0, F.col("_n")).otherwise(0)) / F.sum("_n"), 6).alias("on_time_share"),
        policy=policy,
    )


def cancellations(events: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Cancelled orders by who, why and at which stage, as a share of placed orders.

    The stage is the state before the cancel, read from the event order.
    """
    rows = events.select(
        "order_id", "event_s", "state", "cancelled_by", "cancellation_reason", state_ordinal(F.col("state")).alias("_ord")
    )
    staged = windowed(
        rows, ["order_id"], ["event_s", "_ord"], lambda w: {"stage": F.lag("state").over(w)}, before=1, policy=policy
    )
    # one aggregate carries both the classes and, under a NULL class, the number of placed orders
    hit = F.col("state") == "CANCELLED"
    counted = (
        staged.where(F.col("state").isin("PLACED", "CANCELLED"))
        .groupBy(*[F.when(hit, F.col(c)).alias(c) for c in ("cancelled_by", "cancellation_reason", "stage")])
        .agg(F.count_if(hit).alias("cancelled"), F.count_if(~hit).alias("_placed"))
    )
    total = Window.partitionBy()  # a handful of class rows
    return (
        counted.withColumn("placed", F.sum("_placed").over(total))
        .where(F.col("cancelled") > 0)
        .select(
            "cancelled_by",
            "cancellation_reason",
            "stage",
            "cancelled",
            F.round(F.col("cancelled") / F.col("placed"), 6).alias("cancellation_rate"),
        )
    )


def cancellation_rollup(events: DataFrame) -> DataFrame:
    """Cancelled orders by zone and canceller with subtotals; rows are counted before the rollup."""
    counts = events.where(F.col("state") == "CANCELLED").groupBy("zone_id", "cancelled_by").agg(F.count("*").alias("_n"))
    return counts.rollup("zone_id", "cancelled_by").agg(
        F.sum("_n").alias("cancelled"), F.grouping_id().cast("long").alias("level")
    )


def cancellation_rate(events: DataFrame) -> DataFrame:
    zone = events.groupBy("zone_id").agg(
        F.count_if(F.col("state") == "PLACED").alias("placed"), F.count_if(F.col("state") == "CANCELLED").alias("cancelled")
    )
    return zone.withColumn("cancellation_rate", F.round(F.try_divide(F.col("cancelled"), F.col("placed")), 6))


def peak_window_demand(events: DataFrame, windows: DataFrame, base_orders_per_min: float = 4.0) -> DataFrame:
    """Orders per minute by zone and demand window, against the off-peak base rate.

    Placed orders are first counted per zone and second of day (at most 86,400 rows a
    zone). The range join runs on those counts, as an equi join on the hours that a
    window touches.
    """
    placed = events.where(F.col("state") == "PLACED")
    sod = clock.second_of_day(F.col("event_s"))
    per_second = placed.groupBy("zone_id", sod.alias("sod")).agg(F.count("*").alias("n"))
    days = placed.groupBy("zone_id").agg(
        (F.floor(F.max("event_s") / 86400) - F.floor(F.min("event_s") / 86400) + 1).alias("days")
    )
    hour = clock.hour_of_day(F.col("sod"))
    touched = F.explode(F.sequence(F.floor("start_h"), F.floor("end_h")))
    by_hour = windows.select("ord", "label", "start_h", "end_h", touched.alias("_h"))
    inside = (F.floor(F.col("sod") / 3600) == F.col("_h")) & hour.between(F.col("start_h"), F.col("end_h"))
    matched = per_second.join(by_hour, inside, "left")
    # windows may overlap: the first one wins
    first = matched.groupBy("zone_id", "sod").agg(F.max("n").alias("n"), F.min(F.struct("ord", "label")).alias("w"))
    by_label = first.groupBy("zone_id", F.coalesce("w.label", F.lit(clock.OFF_PEAK)).alias("label")).agg(
        F.sum("n").alias("orders")
    )
    # minutes per day of each label; off-peak lasts whatever the windows leave
    open_minutes = (F.col("end_h") - F.col("start_h")) * 60
    labels = windows.groupBy("label").agg(F.max("multiplier").alias("multiplier"), F.sum(open_minutes).alias("minutes"))
    left_over = F.lit(1440.0) - F.sum(open_minutes)
    rest = windows.agg(
        F.lit(clock.OFF_PEAK).alias("label"), F.lit(1.0).alias("multiplier"), left_over.alias("minutes")
    )
    minutes = F.col("minutes") * F.col("days")
    return (
        by_label.join(days, "zone_id")
        .join(labels.unionByName(rest), "label")
        .select(
            "zone_id",
            "label",
            "multiplier",
            "orders",
            F.round(F.col("orders") / minutes, 6).alias("orders_per_min"),
            F.round(F.col("orders") / minutes / base_orders_per_min, 6).alias("vs_base"),
        )
    )


def top_zones(events: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` zones with the largest share of placed orders."""
    counts = events.where(F.col("state") == "PLACED").groupBy("zone_id").agg(F.count("*").alias("orders"))
    share = F.round(F.col("orders") / F.sum("orders").over(Window.partitionBy()), 6)  # one row per zone
    return counts.withColumn("share", share).orderBy(F.desc("orders"), "zone_id").limit(k)


def eta_estimate(
    events: DataFrame,
    restaurants: DataFrame,
    zones: DataFrame,
    km_per_minute: float = 0.35,
    buffer_minutes: float = 5.0,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Promised time of each placed order from kitchen queue and distance to the zone centre."""
    placed = events.where(F.col("state") == "PLACED").select("order_id", "restaurant_id", "zone_id", "event_s")
    kitchens = restaurants.select(
        "restaurant_id",
        F.col("lat").alias("r_lat"),
        F.col("lon").alias("r_lon"),
        scoring.queue_prep_minutes(F.col("avg_prep_minutes"), F.col("current_backlog")).alias("prep_minutes"),
    )
    centres = zones.select("zone_id", F.col("lat").alias("z_lat"), F.col("lon").alias("z_lon"))
    rows = dimension_join(placed, kitchens, ["restaurant_id"], "left", ["order_id"], policy)
    rows = dimension_join(rows, centres, ["zone_id"], "left", ["order_id"], policy)
    km = geo.haversine_km(F.col("r_lat"), F.col("r_lon"), F.col("z_lat"), F.col("z_lon"))
    minutes = scoring.eta_minutes(F.col("prep_minutes"), km, km_per_minute, buffer_minutes)
    out = rows.withColumn("eta_minutes", F.round(minutes, 6))
    return out.select(
        "order_id",
        F.round("prep_minutes", 6).alias("prep_minutes"),
        "eta_minutes",
        (F.col("event_s") + F.floor(F.col("eta_minutes") * 60)).cast("long").alias("eta_s"),
    )


def enriched(
    events: DataFrame, zones: DataFrame, restaurants: DataFrame, customers: DataFrame, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Placed orders with their zone's name, the restaurant's rating and the customer's
    segment. Zones and restaurants are dimensions; customers grow with the orders."""
    placed = events.where(F.col("state") == "PLACED").select(
        "order_id", "customer_id", "restaurant_id", "zone_id", "event_s", "order_value_inr"
    )
    names = zones.select("zone_id", F.col("name").alias("zone_name"))
    ratings = restaurants.select("restaurant_id", F.col("rating").alias("restaurant_rating"))
    rows = dimension_join(placed, names, ["zone_id"], "left", ["order_id"], policy)
    rows = dimension_join(rows, ratings, ["restaurant_id"], "left", ["order_id"], policy)
    return lookup_join(rows, customers, ["customer_id"], "left", ["order_id"], policy)


def sales_by_segment(orders: DataFrame) -> DataFrame:
    return orders.groupBy("zone_name", F.coalesce("segment", F.lit("unknown")).alias("segment")).agg(
        F.count("*").alias("orders"),
        F.round(F.sum("order_value_inr"), 2).alias("order_value"),
        F.round(F.avg("restaurant_rating"), 6).alias("avg_rating"),
    )
