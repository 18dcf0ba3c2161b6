"""GPS metrics: distance, legs, gaps, anomalies, waiting time, integrity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierflow.functions import geo
from courierflow.operators.sequence import asof_join, latest, windowed
from courierflow.operators.skew import DEFAULT, SkewPolicy, lookup_join
from courierflow.plans.orders import order_restaurants, order_times
from courierflow.plans.supply import status_spans

_ORDER = ["event_s", "event_id"]


def _step(w) -> dict[str, Column]:
    """Distance and seconds from the previous ping of the sequence."""
    return {
        "step_km": geo.haversine_km(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon")),
        "step_s": F.col("event_s") - F.lag("event_s").over(w),
    }


def steps(pings: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT) -> DataFrame:
    rows = pings.select(*{k: None for k in [*keys, *_ORDER, "lat", "lon"]})
    return windowed(rows, keys, _ORDER, _step, before=1, policy=policy)


def leg_profile(pings: DataFrame, slow_kmph: float = 14.0, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Distance, duration and mean speed per partner, order and leg; slow legs are flagged."""
    legs = (
        steps(pings, ["dp_id", "order_id", "trip_leg"], policy)
        .groupBy("dp_id", "order_id", "trip_leg")
        .agg(
            F.count("*").alias("pings"),
            F.coalesce(F.sum("step_km"), F.lit(0.0)).alias("km"),
            (F.max("event_s") - F.min("event_s")).alias("took_s"),
        )
    )
    kmph = F.try_divide(F.col("km") * 3600, F.col("took_s"))
    return legs.withColumns(
        {
            "km": F.round("km", 6),
            "mean_kmph": F.round(kmph, 4),
            "is_slow": F.coalesce(kmph < slow_kmph, F.lit(False)),
        }
    )


def gaps(pings: DataFrame, nominal_s: int, factor: float, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Pings that follow a silence longer than ``factor`` x the nominal spacing."""
    rows = windowed(
        pings.select("dp_id", *_ORDER),
        ["dp_id"],
        _ORDER,
        lambda w: {"gap_s": F.col("event_s") - F.lag("event_s").over(w)},
        before=1,
        policy=policy,
    )
    return rows.where(F.col("gap_s") > F.lit(nominal_s * factor))


def teleports(pings: DataFrame, max_kmph: float, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Implied speed between consecutive positions above ``max_kmph``. The speed field is
    the leg's nominal speed and does not show jumps. ``near_label``/``near_flag`` look one
    ping to either side: a jump shows up twice, on the way out and back."""

    def flag(w):
        kmph = F.try_divide(F.col("step_km") * 3600, F.col("step_s"))
        return {"kmph": kmph, "flagged": F.coalesce(kmph > max_kmph, F.lit(False))}

    return _scored(pings, ["dp_id"], "teleport", [_step, flag], 2, policy)


def standstills(pings: DataFrame, eps_km: float, k: int, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Pings that end ``k`` successive steps shorter than ``eps_km`` within a leg."""

    def still(w):
        return {"_still": F.when(F.col("step_km") < eps_km, 1).otherwise(0)}

    def flag(w):
        return {"flagged": F.sum("_still").over(w.rowsBetween(1 - k, 0)) == k}

    return _scored(pings, ["dp_id", "order_id", "trip_leg"], "stationary_drift", [_step, still, flag], k + 1, policy)


def _scored(pings, keys, label, stages, before, policy) -> DataFrame:
    rows = pings.select(
        *keys, *_ORDER, "lat", "lon", F.col("debug_anomaly_type").eqNullSafe(label).alias("labelled")
    )

    def near(w):
        around = lambda c: F.max(c).over(w.rowsBetween(-1, 1))
        return {"near_label": around("labelled"), "near_flag": around("flagged")}

    return windowed(rows, keys, _ORDER, *stages, near, before=before, after=1, policy=policy)


def detector_quality(scored: DataFrame, detector: str) -> DataFrame:
    """Confusion counts with a tolerance of one ping to either side."""
    out = scored.agg(
        F.count_if(F.col("flagged") & F.col("near_label")).alias("true_flags"),
        F.count_if(F.col("flagged") & ~F.col("near_label")).alias("false_flags"),
        F.count_if(F.col("labelled") & F.col("near_flag")).alias("found"),
        F.count_if(F.col("labelled") & ~F.col("near_flag")).alias("missed"),
    )
    return out.select(
        F.lit(detector).alias("detector"),
        "*",
        F.round(F.try_divide(F.col("true_flags"), F.col("true_flags") + F.col("false_flags")), 6).alias("precision"),
        F.round(F.try_divide(F.col("found"), F.col("found") + F.col("missed")), 6).alias("recall"),
    )


def anomalies(
    pings: DataFrame, max_kmph: float, trip_pings: DataFrame, eps_km: float, k: int, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    jumps = teleports(pings, max_kmph, policy).where("flagged")
    stops = standstills(trip_pings, eps_km, k, policy).where("flagged")
    pick = lambda df, kind: df.select("event_id", "dp_id", "event_s", F.lit(kind).alias("anomaly"))
    return pick(jumps, "teleport").unionByName(pick(stops, "stationary"))


def wait_time(status: DataFrame, orders: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """WAITING_AT_RESTAURANT directly followed by PICKED_UP, per restaurant of the order."""
    waits = status_spans(status, policy).where("status = 'WAITING_AT_RESTAURANT' AND next_status = 'PICKED_UP'")
    wait = F.col("until_s") - F.col("event_s")
    # one row per order on both sides of the join
    per_order = waits.groupBy("order_id").agg(
        F.count("*").alias("_n"), F.sum(wait).alias("_sum"), F.max(wait).alias("_max")
    )
    return _wait_summary(per_order.join(order_restaurants(orders), "order_id"))


def wait_time_gps(pings: DataFrame, orders: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Arrival (last ping of the inbound leg) to the order's PICKED_UP event: as-of join."""
    picked = orders.where(F.col("state") == "PICKED_UP").select("order_id", "restaurant_id", "event_s")
    arrivals = pings.where(F.col("trip_leg") == "TO_RESTAURANT").select("order_id", "event_s", "event_id")
    matched = asof_join(picked, arrivals, ["order_id"], "event_s", ["event_id"], policy)
    wait = F.col("event_s") - F.col("asof_event_s")
    waits = matched.where("event_id IS NOT NULL")
    return _wait_summary(waits.select("restaurant_id", F.lit(1).alias("_n"), wait.alias("_sum"), wait.alias("_max")))


def _wait_summary(waits: DataFrame) -> DataFrame:
    return waits.groupBy("restaurant_id").agg(
        F.sum("_n").alias("trips"),
        F.round(F.sum("_sum") / F.sum("_n"), 6).alias("avg_wait_s"),
        F.max("_max").alias("max_wait_s"),
    )


def trip_distance(pings: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Driven kilometres per partner and order."""
    km = F.coalesce(F.sum("step_km"), F.lit(0.0))
    return steps(pings, ["dp_id", "order_id"], policy).groupBy("dp_id", "order_id").agg(km.alias("actual_km"))


def detour(pings: DataFrame, dispatch: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Driven over planned kilometres, apart for single and batched orders (their plans
    measure different routes). Orders without a usable plan are counted, not divided."""
    driven = trip_distance(pings, policy).groupBy("order_id").agg(F.sum("actual_km").alias("actual_km"))
    plan = (
        dispatch.where(F.col("decision") == "ASSIGNED")
        .groupBy("order_id")
        .agg(F.max("planned_route_distance_km").alias("planned_km"), F.max("is_batched").alias("is_batched"))
    )
    both = driven.join(plan, "order_id")  # one row per order on either side
    ratio = F.try_divide(F.col("actual_km"), F.nullif(F.col("planned_km"), F.lit(0.0)))
    planned = lambda c: F.sum(F.when(F.col("ratio").isNotNull(), F.col(c)))
    return (
        both.withColumn("ratio", ratio)
        .groupBy("is_batched")
        .agg(
            F.count("*").alias("orders"),
            F.count("ratio").alias("with_plan"),
            F.round(F.avg("ratio"), 6).alias("avg_detour_ratio"),
            F.round(planned("actual_km") / planned("planned_km"), 6).alias("total_detour_ratio"),
        )
    )


def orphans(pings: DataFrame, orders: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Pings whose order is unknown, or not in flight (ASSIGNED up to its end) at the time."""
    spans = order_times(orders).select(
        "order_id",
        F.lit(True).alias("_known"),
        F.col("assigned_s").alias("_from"),
        F.least("delivered_s", "cancelled_s").alias("_to"),
    )
    rows = pings.select("order_id", "event_s", "event_id", "trip_leg")
    joined = lookup_join(rows, spans, ["order_id"], "left", ["event_id"], policy)
    in_flight = (F.col("event_s") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("event_s") <= F.col("_to")))
    astray = ~F.coalesce(in_flight, F.lit(False))
    reason = F.when(F.col("_known").isNull(), "unknown_order").when(astray, "not_in_flight")
    found = joined.withColumn("reason", reason).where("reason IS NOT NULL")
    return found.groupBy("order_id", "reason", "trip_leg").agg(
        F.count("*").alias("pings"), F.min("event_s").alias("first_s")
    )


def densify(legs: DataFrame, ping_s: float, kmph: float) -> DataFrame:
    """Points of each straight leg at ``ping_s`` spacing, at least three per leg."""
    km = geo.haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    seconds = F.greatest(F.lit(0.05), km) / F.lit(kmph) * 3600
    n = F.greatest(F.lit(3), F.floor(seconds / F.lit(ping_s)).cast("int"))
    points = legs.withColumn("n_points", n).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n_points"))))
    f = F.col("i") / F.col("n_points")
    return points.select(
        *[c for c in legs.columns if c not in ("lat1", "lon1", "lat2", "lon2")],
        F.col("i").cast("long").alias("i"),
        F.round(geo.along_route(F.col("lat1"), F.col("lat2"), f), 6).alias("lat"),
        F.round(geo.along_route(F.col("lon1"), F.col("lon2"), f), 6).alias("lon"),
    )


def leg_ends(pings: DataFrame) -> DataFrame:
    """First and last position of each leg."""
    at = F.struct(*_ORDER, "lat", "lon")
    ends = pings.groupBy("order_id", "trip_leg").agg(F.min(at).alias("a"), F.max(at).alias("b"))
    return ends.select(
        "order_id",
        "trip_leg",
        *[F.col(f"{end}.{c}").alias(f"{c}{n}") for n, end in ((1, "a"), (2, "b")) for c in ("lat", "lon")],
    )


def drop_points(pings: DataFrame) -> DataFrame:
    """Last outbound position of each order; a task sends one row an order at most."""
    outbound = pings.where(F.col("trip_leg") == "TO_CUSTOMER").select("order_id", *_ORDER, "lat", "lon")
    return latest(outbound, ["order_id"], _ORDER).select("order_id", F.col("lat").alias("drop_lat"), F.col("lon").alias("drop_lon"))
