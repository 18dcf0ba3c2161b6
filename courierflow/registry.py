"""Named queries: ``name -> (spark, folder) -> DataFrame``, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierflow.fixtures import DAY0, Views
from courierflow.functions import clock, geo
from courierflow.operators import ingest, quality
from courierflow.operators.skew import SkewPolicy
from courierflow.plans import dispatch, health, kitchen, orders, payments, supply, trips
from courierflow.plans.scorecard import zone_scorecard
from courierflow.schemas import ENVELOPE, STRING, struct_of
from courierflow.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The moment of the as-of queries: 15 January 2024, 12:30 UTC.
AS_OF_S = DAY0 + 14 * 86400 + 45000
CENTRE = (17.385, 78.4867)
# All topics of the test envelope carry this payload.
ENVELOPE_SCHEMA = struct_of(ENVELOPE | {"dp_id": STRING, "status": STRING})


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Views(prepare(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def r6(c) -> F.Column:
    return F.round(c, 6)


# -- ingestion -----------------------------------------------------------------


def parsed(v: Views) -> DataFrame:
    stamp = F.col("timestamp")
    return ingest.parse(v.kafka, ENVELOPE_SCHEMA, ingest.topic_key_of(F.col("topic")), stamp, F.to_date(stamp))


@query
def bronze_good(v):
    return ingest.good(parsed(v), ENVELOPE_SCHEMA).select(
        *ENVELOPE_SCHEMA.names,
        "raw_value",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        F.unix_seconds("kafka_timestamp").alias("kafka_s"),
        F.col("ingest_date").cast("string").alias("ingest_date"),
    )


@query
def bronze_malformed(v):
    return ingest.malformed(parsed(v)).select(
        "source_topic_key",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        F.unix_seconds("kafka_timestamp").alias("kafka_s"),
        "raw_key",
        "raw_value",
        "error_reason",
    )


@query
def bronze_split_counts(v):
    return parsed(v).groupBy(F.coalesce("error_reason", F.lit("good")).alias("class")).agg(F.count("*").alias("records"))


@query
def topic_routing_counts(v):
    return parsed(v).groupBy("kafka_topic", "source_topic_key").agg(F.count("*").alias("records"))


@query
def malformed_replay(v):
    """Replay the quarantine under a contract that no longer asks for event_id and event_time."""
    again = ingest.as_records(ingest.malformed(parsed(v)))
    key = ingest.topic_key_of(F.col("topic"))
    fixed = ingest.parse(again, ENVELOPE_SCHEMA, key, F.col("timestamp"), required=("dp_id",))
    return fixed.groupBy("source_topic_key", F.coalesce("error_reason", F.lit("good")).alias("class")).agg(
        F.count("*").alias("records"), F.count("_event.dp_id").alias("with_dp")
    )


@query
def payload_shapes(v):
    """What fields of what types each schema version really holds, malformed records left out."""
    return ingest.payload_shapes(v.kafka)


@query
def silver_event_time(v):
    """Typed event time per topic. The envelope holds epoch text, so it is formatted as ISO
    text first; every seventh day gets a broken text to show the error class."""
    ts = F.timestamp_seconds(F.col("event_time").cast("long"))
    text = F.when(F.dayofmonth(ts) % 7 == 0, F.lit("no time")).otherwise(clock.iso_millis(ts))
    typed = ingest.with_event_ts(ingest.good(parsed(v), ENVELOPE_SCHEMA), text)
    return typed.groupBy("kafka_topic", F.coalesce("time_error", F.lit("ok")).alias("class")).agg(
        F.count("*").alias("events"),
        F.min(F.unix_seconds("event_ts")).alias("first_s"),
        F.max(F.unix_seconds("event_ts")).alias("last_s"),
    )


@query
def schema_version_profile(v):
    return ingest.good(parsed(v), ENVELOPE_SCHEMA).groupBy("schema_version", "kafka_topic").agg(
        F.count("*").alias("events"), F.count_if(F.col("status").isNotNull()).alias("with_status")
    )


# -- geography and scalar functions --------------------------------------------


@query
def geo_distance(v):
    lat, lon = map(F.lit, CENTRE)
    return v.gps.select("event_id", r6(geo.haversine_km(lat, lon, F.col("lat"), F.col("lon"))).alias("km"))


@query
def geo_bearing(v):
    lat, lon = map(F.lit, CENTRE)
    return v.gps.select("event_id", F.round(geo.bearing_degrees(lat, lon, F.col("lat"), F.col("lon")), 5).alias("degrees"))


@query
def geo_cell_counts(v):
    row, col = geo.grid_cell(F.col("lat"), F.col("lon"), 0.01)
    return v.gps.groupBy(row.alias("cell_row"), col.alias("cell_col")).agg(F.count("*").alias("pings"))


@query
def route_densify(v):
    return trips.densify(trips.leg_ends(v.trip_gps), ping_s=45, kmph=20.0)


@query
def peak_window_demand(v):
    return orders.peak_window_demand(v.order_lifecycle, v.peak_windows)


@query
def dispatch_topk(v):
    return dispatch.top_partners(v.order_lifecycle, v.restaurants, v.partners, k=8)


@query
def planned_distance(v):
    drops = trips.drop_points(v.trip_gps)
    return dispatch.planned_distance(v.dispatch, v.order_lifecycle, v.partners, v.restaurants, drops)


@query
def eta_estimate(v):
    return orders.eta_estimate(v.order_lifecycle, v.restaurants, v.zones)


@query
def restaurant_weight_rank(v):
    return kitchen.weight_rank(v.restaurants)


@query
def restaurant_backlog(v):
    return kitchen.busy_audit(v.restaurant_status)


@query
def batch_members(v):
    return dispatch.batch_members(dispatch.batch_events(v.dispatch))


# -- the ten metrics -----------------------------------------------------------


@query
def m01_utilization(v):
    return supply.utilization(v.dp_status)


@query
def m01_utilization_hourly(v):
    return supply.utilization_hourly(v.dp_status)


@query
def m02_zone_ratio(v):
    return supply.supply_demand_ratio(v.dp_status, v.order_lifecycle)


@query
def m03_backlog_latest(v):
    return kitchen.backlog_latest(v.restaurant_status)


@query
def m03_backlog_windowed(v):
    return kitchen.backlog_windowed(v.restaurant_status, 6 * 3600)


@query
def m04_acceptance(v):
    return orders.acceptance(v.order_lifecycle, sla_s=75)


@query
def m05_eta_variance(v):
    return orders.eta_variance(v.order_lifecycle)


@query
def m05_eta_variance_restaurant(v):
    return orders.eta_variance(v.order_lifecycle, ["restaurant_id"])


@query
def m06_cancellation(v):
    return orders.cancellations(v.order_lifecycle)


@query
def m06_cancellation_zone(v):
    return orders.cancellation_rate(v.order_lifecycle)


@query
def m06_cancellation_rollup(v):
    return orders.cancellation_rollup(v.order_lifecycle)


@query
def m07_wait_time(v):
    return trips.wait_time(v.dp_status, v.order_lifecycle)


@query
def m07_wait_gps(v):
    return trips.wait_time_gps(v.trip_gps, v.order_lifecycle)


@query
def m08_batch_share(v):
    return dispatch.batch_share(v.dispatch)


@query
def m08_orders_per_trip(v):
    return dispatch.orders_per_trip(v.dispatch)


@query
def m08_detour_ratio(v):
    return trips.detour(v.trip_gps, v.dispatch)


# thresholds fit the test views, where a partner's pings are hours apart
MAX_KMPH, STILL_KM, STILL_STEPS = 3.0, 0.01, 2


@query
def m09_gps_anomalies(v):
    return trips.anomalies(v.gps, MAX_KMPH, v.trip_gps, STILL_KM, STILL_STEPS)


@query
def m09_detector_quality(v):
    jumps = trips.detector_quality(trips.teleports(v.gps, MAX_KMPH), "teleport")
    return jumps.unionByName(trips.detector_quality(trips.standstills(v.trip_gps, STILL_KM, STILL_STEPS), "stationary"))


@query
def m10_failure_rate(v):
    return payments.failure_rate(v.payment)


@query
def m10_retry_storms(v):
    return payments.retry_storms(v.payment, 1800, 0.3, 2)


@query
def m10_permanent_failures(v):
    return payments.permanent_failures(v.payment)


# -- windows, joins, top-k and state -------------------------------------------


@query
def orders_current(v):
    return orders.current_orders(v.order_lifecycle)


@query
def orders_active(v):
    return orders.active_orders(v.order_lifecycle, AS_OF_S)


@query
def illegal_transitions_order(v):
    return orders.illegal_order_moves(v.order_lifecycle)


@query
def illegal_transitions_dp(v):
    return supply.illegal_partner_moves(v.dp_status)


@query
def order_funnel(v):
    return orders.order_funnel(v.order_lifecycle)


@query
def stage_durations(v):
    return orders.stage_durations(v.order_lifecycle)


@query
def backlog_running(v):
    return kitchen.backlog_running(v.order_lifecycle)


@query
def idle_pool_by_zone(v):
    return supply.idle_pool(v.dp_status, AS_OF_S)


@query
def batch_candidates(v):
    return dispatch.batch_candidates(v.order_lifecycle, v.dp_status)


@query
def batch_candidates_text_ids(v):
    """The same on ids as texts, as the events carry them."""
    named = v.order_lifecycle
    for name in ("order_id", "restaurant_id"):
        named = named.withColumn(name, F.concat(F.lit(name[0]), F.lpad(F.col(name).cast("string"), 12, "0")))
    return dispatch.batch_candidates(named, v.dp_status)


@query
def drop_sequence(v):
    return dispatch.drop_sequence(v.dispatch, v.order_lifecycle, v.restaurants, trips.drop_points(v.trip_gps))


@query
def retry_chains(v):
    return payments.retry_chains(v.payment)


@query
def gateway_outages(v):
    return payments.outages(v.payment)


@query
def gateway_outages_by_gateway(v):
    return payments.outages(v.payment, ["gateway"])


@query
def zone_supply_deficit(v):
    return supply.supply_deficit(v.dp_status, v.partners, AS_OF_S)


@query
def restaurant_uptime(v):
    return kitchen.uptime(v.restaurant_status)


@query
def gps_gaps(v):
    return trips.gaps(v.gps, 86400, 3.0)


@query
def leg_profile(v):
    return trips.leg_profile(v.trip_gps)


@query
def gps_orphans(v):
    return trips.orphans(v.trip_gps, v.order_lifecycle)


@query
def payment_orphans(v):
    return payments.orphans(v.payment, v.order_lifecycle)


@query
def payment_orphans_found(v):
    """Orphans in a table that lost the first attempts of some orders and holds orders nobody placed."""
    rows = v.payment.where("payment_id % 10 <> 1 OR order_id % 5 > 0")
    strange = F.when(F.col("order_id") % 7 == 3, -F.col("order_id")).otherwise(F.col("order_id"))
    return payments.orphans(rows.withColumn("order_id", strange), v.order_lifecycle)


@query
def zone_scorecard_report(v):
    return zone_scorecard(v.order_lifecycle, v.dispatch, v.payment, v.zones)


QUERIES["zone_scorecard"] = QUERIES.pop("zone_scorecard_report")


@query
def order_enrichment(v):
    customers = v.table("customer").selectExpr("c_custkey AS customer_id", "c_mktsegment AS segment")
    return orders.sales_by_segment(orders.enriched(v.order_lifecycle, v.zones, v.restaurants, customers))


@query
def top_zones(v):
    return orders.top_zones(v.order_lifecycle)


# -- data quality --------------------------------------------------------------


@query
def dedup_events(v):
    return quality.dedup(v.arrivals)


@query
def duplicate_rate(v):
    return quality.duplicate_rate(v.arrivals, "event_type")


@query
def duplicate_rate_estimate(v):
    """Sketch-based rate per event type, next to the exact one; a bound on their distance."""
    exact = quality.duplicate_rate(v.arrivals, "event_type").withColumnRenamed("duplicate_rate", "_exact")
    estimate = quality.approx_duplicate_rate(v.arrivals, "event_type", rsd=0.01).drop("events")
    close = F.abs(F.col("_exact") - F.col("duplicate_rate")) < 0.05
    return exact.join(estimate, "event_type").select("event_type", "events", close.alias("within_5_points"))


@query
def duplicate_rate_sketched(v):
    """Duplicate rate per event type over all days, merged from the sketches of each day."""
    days = v.arrivals.withColumn("day", F.floor(F.col("event_s") / 86400))
    return quality.merged_duplicate_rate(quality.duplicate_sketches(days, ["event_type", "day"]), ["event_type"])


@query
def lateness_profile(v):
    return quality.lateness_profile(v.arrivals, "event_type", (0, 600, 3600, 7200))


@query
def out_of_order_rate(v):
    rows = quality.out_of_order(v.arrivals)
    return rows.groupBy("part").agg(
        F.count("*").alias("events"), F.count_if("is_out_of_order").alias("out_of_order"),
        r6(F.count_if("is_out_of_order") / F.count("*")).alias("out_of_order_rate"),
    )


@query
def malformed_by_topic_reason(v):
    return health.malformed_by_reason(ingest.malformed(parsed(v)))


@query
def malformed_rate(v):
    return health.malformed_rate(parsed(v))


@query
def ops_gauges(v):
    return health.gauges(parsed(v), v.order_lifecycle, v.dp_status, AS_OF_S)


# -- hot keys: one key holds a third of all rows, under a policy that cuts it into slices ------

CUT = SkewPolicy(max_rows=500, samples=50)


def third(column: str, number: str, value) -> F.Column:
    """``column``, but ``value`` on a third of the rows."""
    return F.when(F.col(number) % 3 == 0, F.lit(value)).otherwise(F.col(column))


@query
def hot_partner_utilization(v):
    return supply.utilization(v.dp_status.withColumn("dp_id", third("dp_id", "event_id", -1)), CUT)


@query
def hot_partner_gaps(v):
    return trips.gaps(v.gps.withColumn("dp_id", third("dp_id", "event_id", -1)), 3600, 3.0, CUT)


@query
def hot_partition_lateness(v):
    return quality.lateness_profile(v.arrivals.withColumn("part", third("part", "off", 6)), "event_type", (0, 600, 3600, 7200), CUT)


@query
def hot_restaurant_backlog(v):
    return kitchen.backlog_running(v.order_lifecycle.withColumn("restaurant_id", third("restaurant_id", "order_id", 7)), CUT)


@query
def hot_zone_latency(v):
    """Percentiles by selection, with the values of a zone cut into slices."""
    return orders.eta_variance(v.order_lifecycle.withColumn("zone_id", third("zone_id", "order_id", "Z01")), policy=SkewPolicy(max_rows=100, samples=50))


@query
def crowded_topk(v):
    """Nearest partners where a third of them stand within some metres of each other, and every
    fifth restaurant lies on the other side of the globe."""
    close = F.col("dp_id") % 3 == 0
    partners = v.partners.withColumns({
        "lat": F.when(close, F.lit(17.4) + F.col("dp_id") * 1e-7).otherwise(F.col("lat")),
        "lon": F.when(close, F.lit(78.5) - F.col("dp_id") * 1e-7).otherwise(F.col("lon"))})
    far = F.col("restaurant_id") % 5 == 0
    spots = v.restaurants.withColumns({
        "lat": F.when(far, -F.col("lat")).otherwise(F.col("lat")), "lon": F.when(far, F.col("lon") - 180).otherwise(F.col("lon"))})
    return dispatch.top_partners(v.order_lifecycle, spots, partners, k=8).drop("score")
