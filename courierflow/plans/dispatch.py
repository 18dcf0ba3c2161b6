"""Dispatch: nearest partners, batching, trips, drop order, planned distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierflow.functions import geo, scoring
from courierflow.operators.knn import nearest_k
from courierflow.operators.sequence import running, sweep, windowed
from courierflow.operators.skew import DEFAULT, SkewPolicy, dimension_join, lookup_join, slice_cuts
from courierflow.plans.orders import order_restaurants, order_times
from courierflow.schemas import SCHEMAS
from courierflow.session import materialize

NEVER = 2**62  # end of a span that is still open


def top_partners(
    orders: DataFrame, restaurants: DataFrame, partners: DataFrame, k: int = 8, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """The ``k`` nearest partners of each order that became READY, with the dispatch score.

    The pickup point is the restaurant, so the search runs once per (restaurant, zone) and
    its k rows are joined back to the orders. Pass the idle pool as ``partners``.
    """
    ready = orders.where(F.col("state") == "READY").select("order_id", "restaurant_id", "zone_id")
    spots = restaurants.select("restaurant_id", "lat", "lon")
    origins = ready.select("restaurant_id", "zone_id").distinct().join(spots, "restaurant_id")
    near = nearest_k(origins, partners, k, "restaurant_id", "dp_id", carry=["rating"])
    out = dimension_join(ready, near, ["restaurant_id", "zone_id"], "inner", ["order_id"], policy)
    score = scoring.dispatch_score(F.col("distance_km"), F.col("rating"))
    rank = F.col("rank").cast("long")
    return out.select("order_id", "dp_id", "distance_km", rank.alias("rank"), score.alias("score"))


def trips(dispatch: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Give each assigned order its trip. A batched order rides on the partner's latest
    unbatched assignment: ``batch_id`` alone misses the first order of a trip."""
    rows = dispatch.where(F.col("decision") == "ASSIGNED").select(
        F.col("assigned_dp_id").alias("dp_id"), "event_s", "dispatch_id", "order_id", "zone_id", "is_batched"
    )
    lead_order = F.when(~F.col("is_batched"), F.col("dispatch_id"))
    out = running(rows, ["dp_id"], ["event_s", "dispatch_id"], {"_trip": ("last", lead_order)}, policy)
    return out.withColumn("trip_id", F.coalesce("_trip", "dispatch_id")).drop("_trip")


def batch_share(dispatch: DataFrame) -> DataFrame:
    zone = dispatch.where(F.col("decision") == "ASSIGNED").groupBy("zone_id").agg(
        F.count("*").alias("assigned"), F.count_if("is_batched").alias("batched")
    )
    return zone.withColumn("batched_share", F.round(F.try_divide(F.col("batched"), F.col("assigned")), 6))


def orders_per_trip(dispatch: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """How many trips carried how many orders."""
    sizes = trips(dispatch, policy).groupBy("dp_id", "trip_id").agg(F.count("*").alias("orders"))
    return sizes.groupBy("orders").agg(F.count("*").alias("trips"))


def drop_sequence(
    dispatch: DataFrame, orders: DataFrame, restaurants: DataFrame, drops: DataFrame, policy: SkewPolicy = DEFAULT
) -> DataFrame:
    """Position of each order in its trip: nearest to its restaurant first, sorted once; orders
    whose distance is unknown come last."""
    owner = order_restaurants(orders)
    rows = trips(dispatch, policy).select("dp_id", "trip_id", "order_id")
    key = ["dp_id", "trip_id"]
    rows = rows.join(owner, "order_id", "left").join(drops, "order_id", "left")
    spots = restaurants.select("restaurant_id", "lat", "lon")
    placed = dimension_join(rows, spots, ["restaurant_id"], "left", ["order_id"], policy)
    km = F.round(geo.haversine_km(F.col("lat"), F.col("lon"), F.col("drop_lat"), F.col("drop_lon")), 6)
    placed = placed.select("dp_id", "trip_id", "order_id", km.alias("drop_km"))
    ranked = {"position": ("sum", F.lit(1))}
    placed = placed.withColumn("_km", F.coalesce("drop_km", F.lit(float("inf"))))
    return running(placed, key, ["_km", "order_id"], ranked, policy).drop("_km")


def planned_distance(
    dispatch: DataFrame,
    orders: DataFrame,
    partners: DataFrame,
    restaurants: DataFrame,
    drops: DataFrame,
    policy: SkewPolicy = DEFAULT,
) -> DataFrame:
    """Planned kilometres per assigned order from positions (see ``planned_distance_km``); NULL
    with the class ``missing`` where a position is not known."""
    owner = order_restaurants(orders)
    rows = (
        dispatch.where(F.col("decision") == "ASSIGNED")
        .select("order_id", F.col("assigned_dp_id").alias("dp_id"), "is_batched")
        .join(owner, "order_id", "left")
        .join(drops, "order_id", "left")
    )
    kitchens = restaurants.select("restaurant_id", F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))
    riders = partners.select("dp_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    rows = dimension_join(rows, kitchens, ["restaurant_id"], "left", ["order_id"], policy)
    rows = dimension_join(rows, riders, ["dp_id"], "left", ["order_id"], policy)

    def km(a, b):
        return geo.haversine_km(F.col(f"{a}_lat"), F.col(f"{a}_lon"), F.col(f"{b}_lat"), F.col(f"{b}_lon"))

    planned = scoring.planned_distance_km(km("p", "r"), km("r", "drop"), km("p", "drop"), F.col("is_batched"))
    known = F.when(planned.isNull(), "missing").otherwise("known")
    return rows.select("order_id", "is_batched", planned.alias("planned_km"), known.alias("positions"))


def batch_events(dispatch: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Dispatch events as JSON, with the order a batched one rides along with."""
    rows = windowed(
        trips(dispatch, policy),
        ["dp_id", "trip_id"],
        ["event_s", "dispatch_id"],
        lambda w: {"_mate": F.lag("order_id").over(w)},
        before=1,
        policy=policy,
    )
    text = lambda c: F.col(c).cast("string")
    nobody = F.array().cast("array<string>")
    mates = F.when(F.col("is_batched") & F.col("_mate").isNotNull(), F.array(text("_mate"))).otherwise(nobody)
    payload = F.struct(
        text("event_s").alias("event_time"),
        F.lit(1).alias("schema_version"),
        text("dispatch_id").alias("event_id"),
        text("order_id").alias("order_id"),
        "zone_id",
        text("dp_id").alias("assigned_dp_id"),
        "is_batched",
        mates.alias("batched_with_order_ids"),
        F.lit("ASSIGNED").alias("decision"),
    )
    return rows.select(text("order_id").alias("key"), F.to_json(payload).alias("value"))


def batch_members(events_json: DataFrame) -> DataFrame:
    """Read the array column back: one row per order and companion."""
    event = F.from_json("value", SCHEMAS["dispatch_decision"])
    rows = events_json.select(event.alias("e")).select("e.order_id", "e.is_batched", "e.batched_with_order_ids")
    return rows.select(
        F.col("order_id").cast("long").alias("order_id"),
        F.size("batched_with_order_ids").cast("long").alias("companions"),
        F.explode("batched_with_order_ids").alias("companion_id"),
    ).withColumn("companion_id", F.col("companion_id").cast("long"))


def numbered(df: DataFrame, name: str, number: str, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """``df`` with its id as a number: itself, or the place of a text id among all sorted ones.

    Distinct ids are sorted by ranges; each range numbers its own from its offset, so that no two ids
    share a number and numbers sort like the texts. The dictionary is a written table. No id is -1.
    """
    if isinstance(df.schema[name].dataType, T.LongType):
        return df.withColumn(number, F.col(name))
    ids = df.select(name).where(F.col(name).isNotNull()).distinct().orderBy(name)
    ids = materialize(ids.withColumn(number, F.monotonically_increasing_id()), "ids")
    return lookup_join(df, ids, [name], "left", policy=policy).withColumn(number, F.coalesce(number, F.lit(-1)))


def batch_candidates(orders: DataFrame, status: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """For each order that becomes READY: another order of the same restaurant whose
    partner is waiting at a restaurant and carries that order alone.

    Two sweeps replace the self join. The partner's timeline of assignments, endings and
    status changes gives the spells in which it waits with exactly one order: the XOR of
    the ids of all orders taken and finished so far *is* that order while the load is one.
    The restaurant's timeline of spells then answers each READY event: some spell holds at
    that moment iff the greatest end among the spells begun so far lies after it. A
    second-best end, of a different order, stands in when the best spell belongs to the
    asking order itself. The spell that lasts longest is the answer.
    """
    times = order_times(orders)
    times = numbered(numbered(times, "order_id", "_order", policy), "restaurant_id", "_rest", policy)
    carried = times.where("assigned_s IS NOT NULL AND dp_id IS NOT NULL")

    def change(at, sign):
        return F.struct(at.alias("event_s"), F.lit(sign).alias("d_load"))

    finish = F.least("delivered_s", "cancelled_s")
    changes = F.inline(F.array(change(F.col("assigned_s"), 1), change(finish, -1)))
    loads = carried.select("dp_id", changes, "_order", "_rest", F.col("_order").alias("_id")).where("event_s IS NOT NULL")
    loads = loads.withColumn("_kind", F.col("d_load"))
    marks = status.select("dp_id", "event_s", "status", F.col("event_id").alias("_id"), F.lit(0).alias("_kind"))
    line = loads.unionByName(marks, allowMissingColumns=True)
    line = sweep(
        line,
        ["dp_id"],
        ["event_s", "_kind", "_id"],
        {
            "load": ("sum", F.coalesce("d_load", F.lit(0))),
            "other": ("xor", F.coalesce("_order", F.lit(0))),
            "at_rest": ("xor", F.coalesce("_rest", F.lit(0))),
            "now": ("last", F.col("status")),
        },
        [lambda w: {"until_s": F.lead("event_s").over(w)}],
        after=1,
        policy=policy,
    )
    spells = line.where("load = 1 AND now = 'WAITING_AT_RESTAURANT' AND (until_s IS NULL OR until_s > event_s)")
    spell = F.struct(F.coalesce("until_s", F.lit(NEVER)).alias("until_s"), "other", "dp_id")

    starts = spells.select(
        F.col("at_rest").alias("_rest"),
        "event_s",
        F.lit(0).alias("_kind"),
        F.col("_id").alias("_order"),
        spell.alias("spell"),
    )
    ready = times.where("ready_s IS NOT NULL")
    ready = ready.select("_rest", F.col("ready_s").alias("event_s"), "_order", "order_id", "restaurant_id")
    asks = starts.unionByName(ready.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    key, order = ["_rest"], ["event_s", "_kind", "_order", "spell"]
    asks = materialize(asks, "batch-asks")  # three passes read it
    cuts = slice_cuts(asks, key, order, policy)
    best = {"best": ("max", F.col("spell")), "was_best": ("max_before", F.col("spell"))}
    asks = sweep(asks, key, order, best, policy=policy, cuts=cuts)
    loser = F.when(
        F.col("spell").isNotNull() & (F.col("spell.other") != F.col("was_best.other")),
        F.when(F.col("spell") < F.col("was_best"), F.col("spell")).otherwise(F.col("was_best")),
    )
    asks = running(asks, key, order, {"second": ("max", loser)}, policy, cuts)
    pick = F.when(F.col("best.other") != F.col("_order"), F.col("best")).otherwise(F.col("second"))
    found = asks.where("_kind = 1").withColumn("pick", pick).where(F.col("pick.until_s") > F.col("event_s"))
    found = found.select(
        "order_id",
        "restaurant_id",
        F.col("event_s").alias("ready_s"),
        F.col("pick.other").alias("_other"),
        F.col("pick.dp_id").alias("dp_id"),
    )
    if isinstance(orders.schema["order_id"].dataType, T.LongType):
        return found.withColumnRenamed("_other", "with_order_id")
    names = carried.select(F.col("_order").alias("_other"), F.col("order_id").alias("with_order_id"))
    return lookup_join(found, names, ["_other"], "inner", ["order_id"], policy).drop("_other")
