"""DuckDB statements with the same results as the registered queries.

They state each result the plain way (ordinary windows, self joins, whole-key sorts),
independent of how the Spark plans reach it.
"""

from __future__ import annotations

import re

from checks.views import with_views

AS_OF = "1705321800"  # 2024-01-15 12:30 UTC

KEYS = """CASE topic WHEN 'order-lifecycle-events' THEN 'order_lifecycle' WHEN 'payment-events' THEN 'payment'
  WHEN 'gps-pings' THEN 'gps_pings' WHEN 'dp-status-events' THEN 'dp_status' ELSE 'restaurant_status' END"""
REASON = """CASE WHEN off % 20 = 0 THEN 'unparsable_json' WHEN off % 20 = 1 THEN 'missing_required_fields' END"""
RECORDS = f"records AS (SELECT *, {KEYS} AS source_topic_key, {REASON} AS error_reason FROM fx_envelope)"


def km(a1, o1, a2, o2):
    return (
        f"(12742.0 * asin(least(1.0, sqrt(power(sin(radians({a2} - {a1}) / 2), 2) + cos(radians({a1})) * cos(radians({a2}))"
        f" * power(sin(radians({o2} - {o1}) / 2), 2)))))"
    )


def prev_km(w):
    """Distance from the previous row; the CASE keeps the first row NULL."""
    return f"CASE WHEN lag(lat) OVER {w} IS NOT NULL THEN {km(f'lag(lat) OVER {w}', f'lag(lon) OVER {w}', 'lat', 'lon')} END"


ORD = """CASE state WHEN 'PLACED' THEN 1 WHEN 'ACCEPTED' THEN 2 WHEN 'PREPARING' THEN 3 WHEN 'READY' THEN 4 WHEN 'ASSIGNED' THEN 5
  WHEN 'PICKED_UP' THEN 6 WHEN 'DELIVERED' THEN 7 WHEN 'REJECTED' THEN 8 ELSE 9 END"""
TIMES = """times AS (SELECT order_id, any_value(zone_id) AS zone_id, any_value(restaurant_id) AS restaurant_id,
  min(event_s) FILTER (WHERE state = 'PLACED') AS placed_s, min(event_s) FILTER (WHERE state = 'ACCEPTED') AS accepted_s,
  min(event_s) FILTER (WHERE state = 'REJECTED') AS rejected_s, min(event_s) FILTER (WHERE state = 'READY') AS ready_s,
  min(event_s) FILTER (WHERE state = 'PREPARING') AS preparing_s,
  min(event_s) FILTER (WHERE state = 'ASSIGNED') AS assigned_s, min(event_s) FILTER (WHERE state = 'PICKED_UP') AS picked_up_s,
  min(event_s) FILTER (WHERE state = 'DELIVERED') AS delivered_s, min(event_s) FILTER (WHERE state = 'CANCELLED') AS cancelled_s,
  min(event_s) FILTER (WHERE cancelled_by = 'SYSTEM' AND cancellation_reason = 'restaurant_no_response') AS no_response_s,
  min(promised_s) AS promised_s, max(dp_id) AS dp_id, max(order_value_inr) AS order_value
  FROM fx_order_lifecycle GROUP BY order_id)"""
SPANS = """spans AS (SELECT *, lead(event_s) OVER w AS until_s, lead(status) OVER w AS next_status FROM fx_dp_status
  WINDOW w AS (PARTITION BY dp_id ORDER BY event_s, event_id))"""
TRIPS = """trips AS (SELECT *, coalesce(last_value(CASE WHEN NOT is_batched THEN dispatch_id END IGNORE NULLS)
    OVER (PARTITION BY assigned_dp_id ORDER BY event_s, dispatch_id ROWS UNBOUNDED PRECEDING), dispatch_id) AS trip_id
  FROM fx_dispatch WHERE decision = 'ASSIGNED')"""
DROPS = """drops AS (SELECT order_id, arg_max(lat, event_s) AS drop_lat, arg_max(lon, event_s) AS drop_lon FROM fx_trip_gps
  WHERE trip_leg = 'TO_CUSTOMER' GROUP BY order_id)"""
PAYMENTS = """payments AS (SELECT payment_id, any_value(order_id) AS order_id, any_value(gateway) AS gateway, any_value(attempt_number) AS attempt,
  any_value(retry_of_payment_id) AS retry_of, min(event_s) FILTER (WHERE status = 'INITIATED') AS initiated_s,
  max(CASE status WHEN 'SUCCESS' THEN 2 WHEN 'FAILED' THEN 1 END) AS result FROM fx_payment GROUP BY payment_id)"""

TELEPORT = f"""jumps AS (SELECT *, coalesce(step_km * 3600 / nullif(step_s, 0) > 3.0, false) AS flagged,
   debug_anomaly_type IS NOT NULL AND debug_anomaly_type = 'teleport' AS labelled
  FROM (SELECT *, {prev_km('w')} AS step_km, event_s - lag(event_s) OVER w AS step_s FROM fx_gps
        WINDOW w AS (PARTITION BY dp_id ORDER BY event_s, event_id)) q)"""
STILL = f"""stops AS (SELECT *, coalesce(step_km < 0.01 AND before_km < 0.01, false) AS flagged,
   debug_anomaly_type IS NOT NULL AND debug_anomaly_type = 'stationary_drift' AS labelled
  FROM (SELECT *, lag(step_km) OVER (PARTITION BY dp_id, order_id, trip_leg ORDER BY event_s, event_id) AS before_km
    FROM (SELECT *, {prev_km('w')} AS step_km FROM fx_trip_gps
          WINDOW w AS (PARTITION BY dp_id, order_id, trip_leg ORDER BY event_s, event_id)) q) q2)"""


def quality(source, keys, name):
    return f"""SELECT '{name}' AS detector, count(*) FILTER (WHERE flagged AND near_label) AS true_flags,
  count(*) FILTER (WHERE flagged AND NOT near_label) AS false_flags, count(*) FILTER (WHERE labelled AND near_flag) AS found,
  count(*) FILTER (WHERE labelled AND NOT near_flag) AS missed,
  round(count(*) FILTER (WHERE flagged AND near_label) / nullif(count(*) FILTER (WHERE flagged), 0), 6) AS "precision",
  round(count(*) FILTER (WHERE labelled AND near_flag) / nullif(count(*) FILTER (WHERE labelled), 0), 6) AS recall
 FROM (SELECT flagged, labelled, max(labelled::INT) OVER w = 1 AS near_label, max(flagged::INT) OVER w = 1 AS near_flag FROM {source}
  WINDOW w AS (PARTITION BY {keys} ORDER BY event_s, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)) q"""


SQL = {
    # -- ingestion
    "bronze_good": f"""WITH {RECORDS} SELECT CAST(broker_s AS VARCHAR) AS event_time, CAST(1 + off % 2 AS BIGINT) AS schema_version,
  CAST(off AS VARCHAR) AS event_id, CAST(key_id AS VARCHAR) AS dp_id, regexp_extract(value, '"status": "([a-z]+)"', 1) AS status, value AS raw_value,
  topic AS kafka_topic, part AS kafka_partition, off AS kafka_offset, broker_s AS kafka_s,
  strftime(to_timestamp(broker_s) AT TIME ZONE 'UTC', '%Y-%m-%d') AS ingest_date FROM records WHERE error_reason IS NULL""",
    "bronze_malformed": f"""WITH {RECORDS} SELECT source_topic_key, topic AS kafka_topic, part AS kafka_partition, off AS kafka_offset,
  broker_s AS kafka_s, key AS raw_key, value AS raw_value, error_reason FROM records WHERE error_reason IS NOT NULL""",
    "bronze_split_counts": f"""WITH {RECORDS} SELECT coalesce(error_reason, 'good') AS class, count(*) AS records FROM records GROUP BY 1""",
    "topic_routing_counts": f"""WITH {RECORDS} SELECT topic AS kafka_topic, source_topic_key, count(*) AS records FROM records GROUP BY 1, 2""",
    "malformed_replay": f"""WITH {RECORDS} SELECT source_topic_key, CASE error_reason WHEN 'unparsable_json' THEN error_reason ELSE 'good' END AS class,
  count(*) AS records, count(*) FILTER (WHERE error_reason <> 'unparsable_json') AS with_dp FROM records WHERE error_reason IS NOT NULL GROUP BY 1, 2""",
    "silver_event_time": f"""WITH {RECORDS}, good AS (SELECT *, dayofmonth(to_timestamp(broker_s) AT TIME ZONE 'UTC') % 7 = 0 AS broken FROM records
  WHERE error_reason IS NULL) SELECT topic AS kafka_topic, CASE WHEN broken THEN 'bad_event_time' ELSE 'ok' END AS class, count(*) AS events,
  min(CASE WHEN NOT broken THEN broker_s END) AS first_s, max(CASE WHEN NOT broken THEN broker_s END) AS last_s FROM good GROUP BY 1, 2""",
    "schema_version_profile": f"""WITH {RECORDS} SELECT CAST(1 + off % 2 AS BIGINT) AS schema_version, topic AS kafka_topic, count(*) AS events,
  count(*) AS with_status FROM records WHERE error_reason IS NULL GROUP BY 1, 2""",
    "malformed_by_topic_reason": f"""WITH {RECORDS} SELECT source_topic_key, error_reason, count(*) AS rows FROM records
  WHERE error_reason IS NOT NULL GROUP BY 1, 2""",
    "malformed_rate": f"""WITH {RECORDS} SELECT source_topic_key, count(*) AS records, count(error_reason) AS malformed,
  round(count(error_reason) / count(*), 6) AS malformed_rate FROM records GROUP BY 1""",
    "ops_gauges": f"""WITH {RECORDS},
 now_orders AS (SELECT state FROM fx_order_lifecycle WHERE event_s <= {AS_OF}
   QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_s DESC, {ORD} DESC) = 1),
 now_dps AS (SELECT status FROM fx_dp_status WHERE event_s <= {AS_OF} QUALIFY row_number() OVER (PARTITION BY dp_id ORDER BY event_s DESC, event_id DESC) = 1)
 SELECT 'published' AS gauge, count(*) AS value FROM records WHERE error_reason IS NULL
 UNION ALL SELECT 'errors', count(*) FROM records WHERE error_reason IS NOT NULL
 UNION ALL SELECT 'active_orders', count(*) FROM now_orders WHERE state NOT IN ('REJECTED', 'DELIVERED', 'CANCELLED')
 UNION ALL SELECT 'online_partners', count(*) FROM now_dps WHERE status <> 'OFFLINE'""",
    # -- geography and scalar functions
    "geo_distance": f"SELECT event_id, round({km('17.385', '78.4867', 'lat', 'lon')}, 6) AS km FROM fx_gps",
    "geo_bearing": """SELECT event_id, round(fmod(degrees(atan2(sin(radians(lon - 78.4867)) * cos(radians(lat)),
   cos(radians(17.385)) * sin(radians(lat)) - sin(radians(17.385)) * cos(radians(lat)) * cos(radians(lon - 78.4867)))) + 360.0, 360.0), 5) AS degrees FROM fx_gps""",
    "geo_cell_counts": """SELECT CAST(floor(lat / 0.01::DOUBLE) AS BIGINT) AS cell_row, CAST(floor(lon / 0.01::DOUBLE) AS BIGINT) AS cell_col,
   count(*) AS pings FROM fx_gps GROUP BY 1, 2""",
    "route_densify": f"""WITH legs AS (SELECT order_id, trip_leg, arg_min(lat, event_s) AS lat1, arg_min(lon, event_s) AS lon1, arg_max(lat, event_s) AS lat2,
   arg_max(lon, event_s) AS lon2 FROM fx_trip_gps GROUP BY 1, 2),
 sized AS (SELECT *, greatest(3, CAST(floor(greatest(0.05, {km('lat1', 'lon1', 'lat2', 'lon2')}) / 20.0 * 3600 / 45) AS INT)) AS n FROM legs)
 SELECT order_id, trip_leg, i, round(lat1 + (lat2 - lat1) * (i / n), 6) AS lat, round(lon1 + (lon2 - lon1) * (i / n), 6) AS lon
 FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM sized) q""",
    "peak_window_demand": """WITH placed AS (SELECT zone_id, event_s, floor(event_s % 86400 / 3600) + floor(event_s % 3600 / 60) / 60.0 + event_s % 60 / 3600.0 AS h
   FROM fx_order_lifecycle WHERE state = 'PLACED'),
 labelled AS (SELECT zone_id, event_s, coalesce((SELECT label FROM fx_peak_windows w WHERE p.h::DOUBLE BETWEEN w.start_h::DOUBLE AND w.end_h::DOUBLE ORDER BY ord LIMIT 1), 'off_peak') AS label FROM placed p),
 days AS (SELECT zone_id, max(event_s // 86400) - min(event_s // 86400) + 1 AS days FROM placed GROUP BY 1),
 minutes AS (SELECT label, (end_h - start_h)::DOUBLE * 60 AS minutes, multiplier::DOUBLE AS multiplier FROM fx_peak_windows
   UNION ALL SELECT 'off_peak', 1440 - (SELECT sum(end_h - start_h)::DOUBLE * 60 FROM fx_peak_windows), 1.0)
 SELECT zone_id, label, any_value(multiplier) AS multiplier, count(*) AS orders, round(count(*) / (any_value(minutes) * any_value(days)), 6) AS orders_per_min,
   round(count(*) / (any_value(minutes) * any_value(days)) / 4.0, 6) AS vs_base
 FROM labelled JOIN days USING (zone_id) JOIN minutes USING (label) GROUP BY 1, 2""",
    "dispatch_topk": f"""WITH near AS (SELECT o.order_id, p.dp_id, p.rating, round({km('r.lat', 'r.lon', 'p.lat', 'p.lon')}, 6) AS distance_km
   FROM fx_order_lifecycle o JOIN fx_restaurants r USING (restaurant_id) JOIN fx_partners p ON p.zone_id = o.zone_id WHERE o.state = 'READY')
 SELECT order_id, dp_id, distance_km, row_number() OVER w AS rank, round(greatest(0, 10.0 - distance_km) + rating, 2) AS score FROM near
 WINDOW w AS (PARTITION BY order_id ORDER BY distance_km, dp_id) QUALIFY rank <= 8""",
    "planned_distance": f"""WITH {DROPS}, owner AS (SELECT DISTINCT order_id, restaurant_id FROM fx_order_lifecycle),
 k AS (SELECT d.order_id, d.is_batched, nullif(round(CASE WHEN p.lat IS NULL OR drop_lat IS NULL OR (r.lat IS NULL AND NOT d.is_batched) THEN NULL WHEN d.is_batched THEN {km('p.lat', 'p.lon', 'drop_lat', 'drop_lon')}
   ELSE {km('p.lat', 'p.lon', 'r.lat', 'r.lon')} + {km('r.lat', 'r.lon', 'drop_lat', 'drop_lon')} END, 3), 0) AS planned_km
 FROM fx_dispatch d LEFT JOIN owner USING (order_id) LEFT JOIN drops USING (order_id) LEFT JOIN fx_restaurants r USING (restaurant_id) LEFT JOIN fx_partners p ON p.dp_id = d.assigned_dp_id
 WHERE d.decision = 'ASSIGNED')
 SELECT *, CASE WHEN planned_km IS NULL THEN 'missing' ELSE 'known' END AS positions FROM k""",
    "eta_estimate": f"""WITH m AS (SELECT o.order_id, o.event_s, r.avg_prep_minutes * (1.0::DOUBLE + 0.08::DOUBLE * greatest(0, r.current_backlog - 1)) AS prep,
   CASE WHEN r.lat IS NOT NULL AND z.lat IS NOT NULL THEN {km('r.lat', 'r.lon', 'z.lat', 'z.lon')} END AS km FROM fx_order_lifecycle o LEFT JOIN fx_restaurants r USING (restaurant_id) LEFT JOIN fx_zones z ON z.zone_id = o.zone_id WHERE o.state = 'PLACED')
 SELECT order_id, round(prep, 6) AS prep_minutes, round(prep + km / 0.35::DOUBLE + 5.0, 6) AS eta_minutes,
  CAST(event_s + floor(round(prep + km / 0.35::DOUBLE + 5.0, 6) * 60) AS BIGINT) AS eta_s FROM m""",
    "restaurant_weight_rank": """WITH w AS (SELECT restaurant_id, zone_id, round(greatest(0.05::DOUBLE, rating - 0.5 * current_backlog), 6) AS weight FROM fx_restaurants WHERE is_online)
 SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY weight DESC, restaurant_id) AS rank FROM w""",
    "restaurant_backlog": """SELECT restaurant_id, count(*) FILTER (WHERE status IN ('BUSY', 'NORMAL')) AS heartbeats,
  count(*) FILTER (WHERE current_backlog >= capacity_orders) AS full_reports, max(current_backlog) AS max_backlog,
  count(*) FILTER (WHERE (status = 'BUSY' AND current_backlog < capacity_orders) OR (status = 'NORMAL' AND current_backlog >= capacity_orders)) AS wrong_flags
 FROM fx_restaurant_status GROUP BY 1""",
    "batch_members": f"""WITH {TRIPS}, mates AS (SELECT *, lag(order_id) OVER (PARTITION BY assigned_dp_id, trip_id ORDER BY event_s, dispatch_id) AS companion_id FROM trips)
 SELECT order_id, CAST(1 AS BIGINT) AS companions, companion_id FROM mates WHERE is_batched AND companion_id IS NOT NULL""",
    # -- the ten metrics
    "m01_utilization": f"""WITH {SPANS} SELECT dp_id, CAST(sum(CASE WHEN status NOT IN ('IDLE', 'OFFLINE') THEN until_s - event_s ELSE 0 END) AS BIGINT) AS busy_s,
  CAST(sum(CASE WHEN status <> 'OFFLINE' THEN until_s - event_s ELSE 0 END) AS BIGINT) AS online_s,
  round(sum(CASE WHEN status NOT IN ('IDLE', 'OFFLINE') THEN until_s - event_s ELSE 0 END) / nullif(sum(CASE WHEN status <> 'OFFLINE' THEN until_s - event_s ELSE 0 END), 0), 6) AS utilization
 FROM spans WHERE until_s IS NOT NULL GROUP BY 1""",
    "m01_utilization_hourly": f"""WITH {SPANS}, cut AS (SELECT zone_id, status, h * 3600 AS bucket_s, least(until_s, h * 3600 + 3600) - greatest(event_s, h * 3600) AS s
   FROM (SELECT *, unnest(range(event_s // 3600, until_s // 3600 + 1)) AS h FROM spans WHERE until_s > event_s) q),
 summed AS (SELECT zone_id, bucket_s, sum(CASE WHEN status NOT IN ('IDLE', 'OFFLINE') THEN s ELSE 0 END) AS busy_s,
   sum(CASE WHEN status <> 'OFFLINE' THEN s ELSE 0 END) AS online_s FROM cut GROUP BY 1, 2),
 grid AS (SELECT zone_id, unnest(range(min(bucket_s), max(bucket_s) + 1, 3600)) AS bucket_s FROM summed GROUP BY 1)
 SELECT zone_id, bucket_s, CAST(coalesce(busy_s, 0) AS BIGINT) AS busy_s, CAST(coalesce(online_s, 0) AS BIGINT) AS online_s, round(busy_s / nullif(online_s, 0), 6) AS utilization
 FROM grid LEFT JOIN summed USING (zone_id, bucket_s)""",
    "m02_zone_ratio": f"""WITH {SPANS}, placed AS (SELECT zone_id, event_s - event_s % 3600 AS window_s, count(*) AS n FROM fx_order_lifecycle WHERE state = 'PLACED' GROUP BY 1, 2),
 idle AS (SELECT zone_id, event_s, until_s, CAST(ceil(event_s / 3600) AS BIGINT) * 3600 - 3600 AS a, CAST(ceil(until_s / 3600) AS BIGINT) * 3600 - 3600 AS b FROM spans WHERE status = 'IDLE'),
 bounds AS (SELECT zone_id, min(w) AS a, max(w) AS b FROM (SELECT zone_id, window_s AS w FROM placed UNION ALL SELECT zone_id, a FROM idle
   UNION ALL SELECT zone_id, b FROM idle WHERE b IS NOT NULL) q GROUP BY 1),
 grid AS (SELECT zone_id, unnest(range(a, b + 1, 3600)) AS window_s FROM bounds),
 pool AS (SELECT g.zone_id, g.window_s, count(i.event_s) AS idle_partners FROM grid g LEFT JOIN idle i ON i.zone_id = g.zone_id
   AND i.event_s <= g.window_s + 3600 AND (i.until_s IS NULL OR i.until_s > g.window_s + 3600) GROUP BY 1, 2)
 SELECT zone_id, window_s, idle_partners, coalesce(n, 0) AS orders_placed, round(idle_partners / nullif(coalesce(n, 0), 0), 6) AS ratio
 FROM pool LEFT JOIN placed USING (zone_id, window_s)""",
    "m03_backlog_latest": """SELECT restaurant_id, zone_id, event_s, current_backlog, capacity_orders, round(current_backlog / capacity_orders, 6) AS load
 FROM fx_restaurant_status QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY event_s DESC, event_id DESC) = 1""",
    "m03_backlog_windowed": """SELECT restaurant_id, event_s - event_s % 21600 AS window_s, count(*) AS reports, round(avg(current_backlog / capacity_orders), 6) AS avg_load,
  round(max(current_backlog / capacity_orders), 6) AS max_load, round(avg(CASE WHEN current_backlog >= capacity_orders THEN 1.0 ELSE 0.0 END), 6) AS busy_share
 FROM fx_restaurant_status GROUP BY 1, 2""",
    "m04_acceptance": f"""WITH {TIMES}, l AS (SELECT *, least(accepted_s, rejected_s) - placed_s AS latency FROM times)
 SELECT zone_id, count(accepted_s) AS accepted, count(rejected_s) AS rejected, count(no_response_s) AS no_response,
  round(count(accepted_s) / nullif(count(accepted_s) + count(rejected_s) + count(no_response_s), 0), 6) AS acceptance_rate, round(avg(latency), 6) AS avg_latency_s,
  round(count(*) FILTER (WHERE latency > 75) / count(latency), 6) AS over_sla_share, round(quantile_cont(latency, 0.5), 6) AS p50_latency_s,
  round(quantile_cont(latency, 0.95), 6) AS p95_latency_s FROM l GROUP BY 1""",
    "m05_eta_variance": f"""WITH {TIMES}, e AS (SELECT *, delivered_s - promised_s AS err FROM times WHERE delivered_s IS NOT NULL)
 SELECT zone_id, count(*) AS delivered, round(avg(err), 4) AS mean_error_s, round(stddev_samp(err), 4) AS stddev_error_s, round(quantile_cont(err, 0.5), 6) AS p50_error_s,
  round(quantile_cont(err, 0.95), 6) AS p95_error_s, round(count(*) FILTER (WHERE err <= 0) / count(*), 6) AS on_time_share FROM e GROUP BY 1""",
    "m06_cancellation": f"""WITH s AS (SELECT *, lag(state) OVER (PARTITION BY order_id ORDER BY event_s, {ORD}) AS stage FROM fx_order_lifecycle)
 SELECT cancelled_by, cancellation_reason, stage, count(*) AS cancelled, round(count(*) / (SELECT count(*) FROM fx_order_lifecycle WHERE state = 'PLACED'), 6) AS cancellation_rate
 FROM s WHERE state = 'CANCELLED' GROUP BY 1, 2, 3""",
    "m06_cancellation_zone": """SELECT zone_id, count(*) FILTER (WHERE state = 'PLACED') AS placed, count(*) FILTER (WHERE state = 'CANCELLED') AS cancelled,
  round(count(*) FILTER (WHERE state = 'CANCELLED') / nullif(count(*) FILTER (WHERE state = 'PLACED'), 0), 6) AS cancellation_rate FROM fx_order_lifecycle GROUP BY 1""",
    "m06_cancellation_rollup": """SELECT zone_id, cancelled_by, count(*) AS cancelled, CAST(grouping(zone_id, cancelled_by) AS BIGINT) AS level FROM fx_order_lifecycle
 WHERE state = 'CANCELLED' GROUP BY ROLLUP (zone_id, cancelled_by)""",
    "m07_wait_time": f"""WITH {SPANS}, owner AS (SELECT DISTINCT order_id, restaurant_id FROM fx_order_lifecycle)
 SELECT restaurant_id, count(*) AS trips, round(avg(until_s - event_s), 6) AS avg_wait_s, max(until_s - event_s) AS max_wait_s
 FROM spans JOIN owner USING (order_id) WHERE status = 'WAITING_AT_RESTAURANT' AND next_status = 'PICKED_UP' GROUP BY 1""",
    "m07_wait_gps": """WITH arrived AS (SELECT o.order_id, o.restaurant_id, o.event_s, max(g.event_s) AS arrival_s FROM fx_order_lifecycle o JOIN fx_trip_gps g
   ON g.order_id = o.order_id AND g.trip_leg = 'TO_RESTAURANT' AND g.event_s <= o.event_s WHERE o.state = 'PICKED_UP' GROUP BY 1, 2, 3)
 SELECT restaurant_id, count(*) AS trips, round(avg(event_s - arrival_s), 6) AS avg_wait_s, max(event_s - arrival_s) AS max_wait_s FROM arrived GROUP BY 1""",
    "m08_batch_share": """SELECT zone_id, count(*) AS assigned, count(*) FILTER (WHERE is_batched) AS batched, round(count(*) FILTER (WHERE is_batched) / count(*), 6) AS batched_share
 FROM fx_dispatch WHERE decision = 'ASSIGNED' GROUP BY 1""",
    "m08_orders_per_trip": f"""WITH {TRIPS} SELECT orders, count(*) AS trips FROM (SELECT assigned_dp_id, trip_id, count(*) AS orders FROM trips GROUP BY 1, 2) q GROUP BY 1""",
    "m08_detour_ratio": f"""WITH steps AS (SELECT order_id, {prev_km('w')} AS km FROM fx_trip_gps WINDOW w AS (PARTITION BY dp_id, order_id ORDER BY event_s, event_id)),
 driven AS (SELECT order_id, coalesce(sum(km), 0) AS actual FROM steps GROUP BY 1),
 r AS (SELECT is_batched, actual, planned_route_distance_km AS planned, actual / nullif(planned_route_distance_km, 0) AS ratio FROM driven JOIN fx_dispatch USING (order_id) WHERE decision = 'ASSIGNED')
 SELECT is_batched, count(*) AS orders, count(ratio) AS with_plan, round(avg(ratio), 6) AS avg_detour_ratio, round(sum(actual) / sum(planned), 6) AS total_detour_ratio FROM r GROUP BY 1""",
    "m09_gps_anomalies": f"""WITH {TELEPORT}, {STILL} SELECT event_id, dp_id, event_s, 'teleport' AS anomaly FROM jumps WHERE flagged
 UNION ALL SELECT event_id, dp_id, event_s, 'stationary' FROM stops WHERE flagged""",
    "m09_detector_quality": f"""WITH {TELEPORT}, {STILL} {quality('jumps', 'dp_id', 'teleport')} UNION ALL {quality('stops', 'dp_id, order_id, trip_leg', 'stationary')}""",
    "m10_failure_rate": """SELECT gateway, event_s - event_s % 3600 AS window_s, count(*) FILTER (WHERE status <> 'INITIATED') AS results, count(*) FILTER (WHERE status = 'FAILED') AS failed,
  count(*) FILTER (WHERE status = 'INITIATED' AND attempt_number > 1) AS retries,
  round(count(*) FILTER (WHERE status = 'FAILED') / count(*) FILTER (WHERE status <> 'INITIATED'), 6) AS failure_rate
 FROM fx_payment GROUP BY 1, 2 HAVING count(*) FILTER (WHERE status <> 'INITIATED') > 0""",
    "m10_retry_storms": """WITH w AS (SELECT gateway, event_s - event_s % 1800 AS window_s, count(*) FILTER (WHERE status <> 'INITIATED') AS results, count(*) FILTER (WHERE status = 'FAILED') AS failed,
  count(*) FILTER (WHERE status = 'INITIATED' AND attempt_number > 1) AS retries FROM fx_payment GROUP BY 1, 2)
 SELECT *, round(failed / results, 6) AS failure_rate FROM w WHERE results > 0 AND failed / results > 0.3 AND retries > 2""",
    "m10_permanent_failures": f"""WITH RECURSIVE {PAYMENTS}, chain AS (SELECT payment_id, payment_id AS root, result, attempt FROM payments p WHERE p.retry_of IS NULL OR NOT EXISTS (SELECT 1 FROM payments q WHERE q.payment_id = p.retry_of AND q.attempt < p.attempt)
   UNION ALL SELECT p.payment_id, c.root, p.result, p.attempt FROM payments p JOIN chain c ON p.retry_of = c.payment_id AND c.attempt < p.attempt),
 ended AS (SELECT root, count(*) AS n, max(result) AS best FROM chain GROUP BY 1)
 SELECT gateway, count(*) AS chains, count(*) FILTER (WHERE best = 1) AS failed_for_good, round(avg(n - 1), 6) AS retries_per_order
 FROM ended JOIN payments ON payment_id = root GROUP BY 1""",
    # -- windows, joins, top-k and state
    "orders_current": f"""SELECT order_id, zone_id, restaurant_id, state, event_s FROM fx_order_lifecycle
 QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_s DESC, {ORD} DESC) = 1""",
    "orders_active": f"""SELECT * FROM (SELECT order_id, zone_id, restaurant_id, state, event_s FROM fx_order_lifecycle WHERE event_s <= {AS_OF}
 QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_s DESC, {ORD} DESC) = 1) q WHERE state NOT IN ('REJECTED', 'DELIVERED', 'CANCELLED')""",
    "illegal_transitions_order": f"""WITH m AS (SELECT order_id, event_s, lag(state) OVER (PARTITION BY order_id ORDER BY event_s, {ORD}) AS from_state, state AS to_state FROM fx_order_lifecycle)
 SELECT m.* FROM m WHERE from_state IS NOT NULL AND to_state <> 'CANCELLED' AND NOT EXISTS (SELECT 1 FROM fx_legal_transitions t WHERE t.machine = 'order' AND t.from_state = m.from_state AND t.to_state = m.to_state)""",
    "illegal_transitions_dp": """WITH m AS (SELECT event_id, dp_id, event_s, lag(status) OVER (PARTITION BY dp_id ORDER BY event_s, event_id) AS from_state, status AS to_state FROM fx_dp_status)
 SELECT m.* FROM m WHERE from_state IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_legal_transitions t WHERE t.machine <> 'order' AND t.from_state = m.from_state AND t.to_state = m.to_state)""",
    "order_funnel": """SELECT zone_id, count(DISTINCT order_id) AS orders, """
    + ", ".join(
        f"count(DISTINCT CASE WHEN state = '{s}' THEN order_id END) AS {s.lower()}"
        for s in "PLACED ACCEPTED PREPARING READY ASSIGNED PICKED_UP DELIVERED REJECTED CANCELLED".split()
    )
    + " FROM fx_order_lifecycle GROUP BY 1",
    "stage_durations": f"""WITH {TIMES}, d AS (SELECT 'PLACED->ACCEPTED' AS stage, accepted_s - placed_s AS s FROM times UNION ALL SELECT 'ACCEPTED->READY', ready_s - accepted_s FROM times
  UNION ALL SELECT 'READY->ASSIGNED', assigned_s - ready_s FROM times UNION ALL SELECT 'ASSIGNED->PICKED_UP', picked_up_s - assigned_s FROM times
  UNION ALL SELECT 'PICKED_UP->DELIVERED', delivered_s - picked_up_s FROM times)
 SELECT stage, count(*) AS orders, round(avg(s), 6) AS mean_s, round(quantile_cont(s, 0.5), 6) AS p50_s, round(quantile_cont(s, 0.95), 6) AS p95_s FROM d WHERE s IS NOT NULL GROUP BY 1""",
    "backlog_running": f"""WITH {TIMES}, c AS (SELECT restaurant_id, order_id, accepted_s AS event_s, 1 AS delta FROM times WHERE accepted_s IS NOT NULL
   UNION ALL SELECT restaurant_id, order_id, least(ready_s, CASE WHEN cancelled_s > accepted_s THEN cancelled_s END), -1 FROM times
     WHERE accepted_s IS NOT NULL AND (ready_s IS NOT NULL OR cancelled_s > accepted_s)),
 s AS (SELECT *, CAST(sum(delta) OVER (PARTITION BY restaurant_id ORDER BY event_s, order_id, delta ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM c)
 SELECT restaurant_id, event_s, order_id, delta, total - least(0, min(total) OVER (PARTITION BY restaurant_id ORDER BY event_s, order_id, delta ROWS UNBOUNDED PRECEDING)) AS backlog FROM s""",
    "idle_pool_by_zone": f"""SELECT zone_id, count(*) FILTER (WHERE status = 'IDLE') AS idle, count(*) FILTER (WHERE status <> 'OFFLINE') AS online FROM
 (SELECT zone_id, status FROM fx_dp_status WHERE event_s <= {AS_OF} QUALIFY row_number() OVER (PARTITION BY dp_id ORDER BY event_s DESC, event_id DESC) = 1) q GROUP BY 1""",
    "batch_candidates": f"""WITH {TIMES}, {SPANS},
 carried AS (SELECT order_id, restaurant_id, dp_id, assigned_s AS a, coalesce(least(delivered_s, cancelled_s), 4611686018427387904) AS b FROM times WHERE assigned_s IS NOT NULL AND dp_id IS NOT NULL),
 waits AS (SELECT dp_id, event_s AS a, coalesce(until_s, 4611686018427387904) AS b FROM spans WHERE status = 'WAITING_AT_RESTAURANT' AND (until_s IS NULL OR until_s > event_s)),
 ready AS (SELECT order_id, restaurant_id, ready_s FROM times WHERE ready_s IS NOT NULL),
 hits AS (SELECT r.order_id, r.restaurant_id, r.ready_s, c.order_id AS with_order_id, c.dp_id, w.b AS wait_end, c.b AS order_end FROM ready r
   JOIN carried c ON c.restaurant_id = r.restaurant_id AND c.order_id <> r.order_id AND c.a <= r.ready_s AND c.b > r.ready_s
   JOIN waits w ON w.dp_id = c.dp_id AND w.a <= r.ready_s AND w.b > r.ready_s),
 alone AS (SELECT h.*, least(wait_end, order_end, coalesce((SELECT min(x.a) FROM carried x WHERE x.dp_id = h.dp_id AND x.a > h.ready_s), 4611686018427387904),
     coalesce((SELECT min(s.event_s) FROM fx_dp_status s WHERE s.dp_id = h.dp_id AND s.event_s > h.ready_s), 4611686018427387904)) AS until_s FROM hits h
   WHERE (SELECT count(*) FROM carried x WHERE x.dp_id = h.dp_id AND x.a <= h.ready_s AND x.b > h.ready_s) = 1)
 SELECT order_id, restaurant_id, ready_s, with_order_id, dp_id FROM alone QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY until_s DESC, with_order_id DESC, dp_id DESC) = 1""",
    "drop_sequence": f"""WITH {TRIPS}, {DROPS}, owner AS (SELECT DISTINCT order_id, restaurant_id FROM fx_order_lifecycle),
 d AS (SELECT assigned_dp_id AS dp_id, trip_id, order_id, CASE WHEN r.lat IS NOT NULL AND drop_lat IS NOT NULL THEN round({km('r.lat', 'r.lon', 'drop_lat', 'drop_lon')}, 6) END AS drop_km FROM trips LEFT JOIN owner USING (order_id) LEFT JOIN drops USING (order_id)
   LEFT JOIN fx_restaurants r USING (restaurant_id))
 SELECT *, row_number() OVER (PARTITION BY dp_id, trip_id ORDER BY drop_km NULLS LAST, order_id) AS position FROM d""",
    "retry_chains": f"""WITH RECURSIVE {PAYMENTS}, chain AS (SELECT payment_id, order_id, payment_id AS root, 1 AS depth, result, attempt FROM payments p WHERE p.retry_of IS NULL OR NOT EXISTS (SELECT 1 FROM payments q WHERE q.payment_id = p.retry_of AND q.attempt < p.attempt)
   UNION ALL SELECT p.payment_id, p.order_id, c.root, c.depth + 1, p.result, p.attempt FROM payments p JOIN chain c ON p.retry_of = c.payment_id AND c.attempt < p.attempt)
 SELECT payment_id, order_id, root AS root_payment_id, CAST(depth AS BIGINT) AS depth, count(*) OVER (PARTITION BY root) AS chain_length,
  CASE max(result) OVER (PARTITION BY root) WHEN 2 THEN 'SUCCESS' WHEN 1 THEN 'FAILED' ELSE 'OPEN' END AS final_status FROM chain""",
    "gateway_outages": """WITH i AS (SELECT event_s, payment_id, is_gateway_outage, row_number() OVER (ORDER BY event_s, payment_id)
   - row_number() OVER (PARTITION BY is_gateway_outage ORDER BY event_s, payment_id) AS run FROM fx_payment WHERE status = 'INITIATED')
 SELECT min(event_s) AS start_s, max(event_s) AS end_s, count(*) AS payments FROM i WHERE is_gateway_outage GROUP BY run""",
    "gateway_outages_by_gateway": """WITH i AS (SELECT gateway, event_s, payment_id, is_gateway_outage, row_number() OVER (PARTITION BY gateway ORDER BY event_s, payment_id)
   - row_number() OVER (PARTITION BY gateway, is_gateway_outage ORDER BY event_s, payment_id) AS run FROM fx_payment WHERE status = 'INITIATED')
 SELECT gateway, min(event_s) AS start_s, max(event_s) AS end_s, count(*) AS payments FROM i WHERE is_gateway_outage GROUP BY gateway, run""",
    "zone_supply_deficit": f"""WITH now AS (SELECT dp_id, status FROM fx_dp_status WHERE event_s <= {AS_OF} QUALIFY row_number() OVER (PARTITION BY dp_id ORDER BY event_s DESC, event_id DESC) = 1),
 z AS (SELECT p.zone_id, count(*) AS partners, count(*) FILTER (WHERE status <> 'OFFLINE') AS online, count(*) FILTER (WHERE status = 'IDLE') AS idle FROM fx_partners p LEFT JOIN now USING (dp_id) GROUP BY 1),
 t AS (SELECT *, CAST(round_even(partners * 0.8::DOUBLE, 0) AS BIGINT) AS target FROM z)
 SELECT *, greatest(target - online, 0) AS deficit, greatest(online - target, 0) AS surplus, least(greatest(target - online, 0), partners - online) AS to_call,
  least(greatest(online - target, 0), idle) AS to_release FROM t""",
    "restaurant_uptime": """WITH s AS (SELECT restaurant_id, status, lead(event_s) OVER (PARTITION BY restaurant_id ORDER BY event_s, event_id) - event_s AS took FROM fx_restaurant_status WHERE status IN ('ONLINE', 'OFFLINE'))
 SELECT restaurant_id, CAST(sum(CASE WHEN status = 'ONLINE' THEN took ELSE 0 END) AS BIGINT) AS online_s, CAST(sum(took) AS BIGINT) AS observed_s,
  round(sum(CASE WHEN status = 'ONLINE' THEN took ELSE 0 END) / nullif(sum(took), 0), 6) AS uptime FROM s WHERE took IS NOT NULL GROUP BY 1""",
    "gps_gaps": """SELECT * FROM (SELECT dp_id, event_s, event_id, event_s - lag(event_s) OVER (PARTITION BY dp_id ORDER BY event_s, event_id) AS gap_s FROM fx_gps) q WHERE gap_s > 259200""",
    "leg_profile": f"""WITH s AS (SELECT *, {prev_km('w')} AS step FROM fx_trip_gps WINDOW w AS (PARTITION BY dp_id, order_id, trip_leg ORDER BY event_s, event_id)),
 l AS (SELECT dp_id, order_id, trip_leg, count(*) AS pings, coalesce(sum(step), 0) AS raw_km, max(event_s) - min(event_s) AS took_s FROM s GROUP BY 1, 2, 3)
 SELECT * EXCLUDE (raw_km), round(raw_km, 6) AS km, round(raw_km * 3600 / nullif(took_s, 0), 4) AS mean_kmph, coalesce(raw_km * 3600 / nullif(took_s, 0) < 14.0, false) AS is_slow FROM l""",
    "gps_orphans": f"""WITH {TIMES}, c AS (SELECT g.order_id, g.trip_leg, g.event_s, CASE WHEN t.order_id IS NULL THEN 'unknown_order'
    WHEN t.assigned_s IS NULL OR g.event_s < t.assigned_s OR g.event_s > coalesce(least(t.delivered_s, t.cancelled_s), g.event_s) THEN 'not_in_flight' END AS reason
   FROM fx_trip_gps g LEFT JOIN times t ON t.order_id = g.order_id)
 SELECT order_id, reason, trip_leg, count(*) AS pings, min(event_s) AS first_s FROM c WHERE reason IS NOT NULL GROUP BY 1, 2, 3""",
    "payment_orphans": f"""WITH {PAYMENTS} SELECT 'retry_of_unknown_payment' AS problem, count(*) AS payments FROM payments p WHERE retry_of IS NOT NULL AND NOT EXISTS (SELECT 1 FROM payments q WHERE q.payment_id = p.retry_of)
 UNION ALL SELECT 'unknown_order', count(*) FROM payments p WHERE NOT EXISTS (SELECT 1 FROM fx_order_lifecycle o WHERE o.state = 'PLACED' AND o.order_id = p.order_id)""",
    "zone_scorecard": f"""WITH {TIMES}, o AS (SELECT zone_id, count(placed_s) AS placed, count(accepted_s) AS accepted, count(delivered_s) AS delivered, count(cancelled_s) AS cancelled,
   round(sum(order_value), 2) AS order_value, count(*) FILTER (WHERE delivered_s <= promised_s) AS on_time FROM times GROUP BY 1),
 d AS (SELECT zone_id, count(*) FILTER (WHERE decision = 'NO_DP_AVAILABLE') AS no_partner, count(*) FILTER (WHERE is_batched) AS batched FROM fx_dispatch GROUP BY 1),
 p AS (SELECT zone_id, count(*) FILTER (WHERE status = 'FAILED') AS failed_payments FROM fx_payment JOIN times USING (order_id) GROUP BY 1)
 SELECT zone_id, name, placed, accepted, delivered, cancelled, order_value, on_time, no_partner, batched, failed_payments, round(accepted / nullif(placed, 0), 6) AS acceptance_share,
  round(cancelled / nullif(placed, 0), 6) AS cancelled_share, round(on_time / nullif(delivered, 0), 6) AS on_time_share
 FROM fx_zones LEFT JOIN o USING (zone_id) LEFT JOIN d USING (zone_id) LEFT JOIN p USING (zone_id)""",
    "top_zones": """SELECT zone_id, count(*) AS orders, round(count(*) / (SELECT count(*) FROM fx_order_lifecycle WHERE state = 'PLACED'), 6) AS share FROM fx_order_lifecycle
 WHERE state = 'PLACED' GROUP BY 1 ORDER BY orders DESC, zone_id LIMIT 3""",
    # -- data quality
    "dedup_events": "SELECT event_id, part, off, event_s, event_type FROM fx_arrivals QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY off) = 1",
    "duplicate_rate": """SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS distinct_events, count(*) - count(DISTINCT event_id) AS duplicates,
  round((count(*) - count(DISTINCT event_id)) / count(*), 6) AS duplicate_rate FROM fx_arrivals GROUP BY 1""",
    "lateness_profile": """WITH l AS (SELECT event_type, max(event_s) OVER (PARTITION BY part ORDER BY off ROWS UNBOUNDED PRECEDING) - event_s AS late_s FROM fx_arrivals)
 SELECT event_type, CASE WHEN late_s <= 0 THEN 'within_0s' WHEN late_s <= 600 THEN 'within_600s' WHEN late_s <= 3600 THEN 'within_3600s' WHEN late_s <= 7200 THEN 'within_7200s' ELSE 'over_7200s' END AS lateness,
  count(*) AS events, max(late_s) AS max_late_s FROM l GROUP BY 1, 2""",
    "out_of_order_rate": """WITH o AS (SELECT part, coalesce(lag(event_s) OVER (PARTITION BY part ORDER BY off) > event_s, false) AS late FROM fx_arrivals)
 SELECT part, count(*) AS events, count(*) FILTER (WHERE late) AS out_of_order, round(count(*) FILTER (WHERE late) / count(*), 6) AS out_of_order_rate FROM o GROUP BY 1""",
}
LANDED = f"WITH {RECORDS} SELECT source_topic_key, coalesce(error_reason, 'good') AS class, count(*) AS records{{}} FROM records GROUP BY 1, 2"
SQL |= {
    # -- tables
    "table_health_report": f"""WITH {RECORDS}, keys AS (SELECT unnest(['order_lifecycle', 'dp_status', 'gps_pings', 'restaurant_status', 'payment', 'dispatch_decision']) AS topic_key)
 SELECT topic_key, count(off) AS rows, max(CAST(broker_s AS VARCHAR)) AS newest_event FROM keys LEFT JOIN records ON source_topic_key = topic_key AND error_reason IS NULL GROUP BY 1""",
    "table_freshness": f"""WITH {RECORDS} SELECT source_topic_key, max(broker_s) AS newest_ingest_s, 1706745600 - max(broker_s) AS freshness_s FROM records WHERE error_reason IS NULL GROUP BY 1""",
    "sink_replay_idempotent": LANDED.format(""),
    "schema_evolution_union": f"""WITH {RECORDS} SELECT CAST(1 + off % 2 AS BIGINT) AS schema_version, count(*) AS events, count(*) FILTER (WHERE off % 2 = 1) AS with_status
 FROM records WHERE error_reason IS NULL GROUP BY 1""",
    "partition_pruned_read": f"""WITH {RECORDS} SELECT strftime(to_timestamp(broker_s) AT TIME ZONE 'UTC', '%Y-%m-%d') AS ingest_date, count(*) AS events FROM records
 WHERE error_reason IS NULL AND broker_s >= 1704672000 AND broker_s < 1705276800 GROUP BY 1""",
    "clustered_layout_lookup": f"""SELECT dp_id, event_id, event_s, round({km('17.385', '78.4867', 'lat', 'lon')}, 6) AS km FROM fx_gps
 QUALIFY row_number() OVER (PARTITION BY dp_id ORDER BY event_s DESC, event_id DESC) = 1""",
    "event_json_emit": """SELECT CAST(dp_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"dp_id":' || dp_id || ',"zone_id":"' || zone_id || '","event_s":' || event_s
  || ',"status":"' || status || '","order_id":' || coalesce(CAST(order_id AS VARCHAR), 'null') || '}' AS value FROM fx_dp_status""",
    # -- ingestion streams
    "stream_scan_counts": "SELECT event_type, count(*) AS events FROM events GROUP BY 1",
    "stream_multi_batch_ingest": LANDED.format(", true AS several_batches"),
    "stream_multi_sink_counts": f"WITH {RECORDS} SELECT source_topic_key, count(*) - count(error_reason) AS typed, count(error_reason) AS quarantined FROM records GROUP BY 1",
    "stream_resume_no_loss": LANDED.format(""),
    "ingest_observed_metrics": f"WITH {RECORDS} SELECT count(*) - count(error_reason) AS good, count(error_reason) AS malformed FROM records",
    "stream_isolated_failure": """SELECT 'healthy' AS stream, 'finished' AS outcome, CAST(0 AS BIGINT) AS restarts, count(*) AS rows FROM events
 UNION ALL SELECT 'broken', 'failed', 1, 0 UNION ALL SELECT 'unstartable', 'failed', 1, 0""",
    # -- event-time streams
    "stream_tumbling_orders": """SELECT zone_id, event_s - event_s % 3600 AS window_s, event_s - event_s % 3600 + 3600 AS window_end_s, count(*) AS orders FROM fx_order_lifecycle
 WHERE state = 'PLACED' GROUP BY 1, 2, 3""",
    "stream_sliding_failures": """SELECT gateway, w AS window_s, w + 7200 AS window_end_s, count(*) AS results, count(*) FILTER (WHERE status = 'FAILED') AS failed
 FROM (SELECT *, unnest([event_s - event_s % 3600, event_s - event_s % 3600 - 3600]) AS w FROM fx_payment WHERE status <> 'INITIATED') q GROUP BY 1, 2, 3""",
    "stream_sessions": """WITH b AS (SELECT dp_id, event_s, CASE WHEN event_s - lag(event_s) OVER (PARTITION BY dp_id ORDER BY event_s) <= 43200 THEN 0 ELSE 1 END AS fresh FROM fx_dp_status),
 n AS (SELECT *, sum(fresh) OVER (PARTITION BY dp_id ORDER BY event_s ROWS UNBOUNDED PRECEDING) AS nth FROM b)
 SELECT dp_id, min(event_s) AS window_s, max(event_s) + 43200 AS window_end_s, count(*) AS events FROM n GROUP BY dp_id, nth""",
    "stream_late_drop": """WITH b AS (SELECT min(off) AS lo, (max(off) - min(off)) // 4 + 1 AS width FROM fx_arrivals),
 a AS (SELECT event_type, event_s, event_s - event_s % 3600 + 3600 AS closes_s, (off - lo) // width AS arrival FROM fx_arrivals, b),
 mark AS (SELECT arrival + 1 AS arrival, max(max(event_s)) OVER (ORDER BY arrival) - 1800 AS mark_s FROM a GROUP BY arrival),
 c AS (SELECT event_type, mark_s IS NULL OR closes_s > mark_s AS open FROM a LEFT JOIN mark USING (arrival))
 SELECT event_type, count(*) FILTER (WHERE open) AS counted, count(*) FILTER (WHERE NOT open) AS dropped, (SELECT count(*) FROM c WHERE NOT open) > 0 AS drops_reported FROM c GROUP BY 1""",
    "stream_dedup": "SELECT event_type, count(DISTINCT event_id) AS events, count(DISTINCT event_id) AS distinct_events FROM fx_arrivals GROUP BY 1",
    "stream_accept_latency": """SELECT p.order_id, p.zone_id, p.event_s AS placed_s, a.event_s - p.event_s AS latency_s FROM fx_order_lifecycle p JOIN fx_order_lifecycle a USING (order_id)
 WHERE p.state = 'PLACED' AND a.state = 'ACCEPTED' AND a.event_s BETWEEN p.event_s AND p.event_s + 600""",
    "stream_pickup_wait": """SELECT a.dp_id, a.order_id, a.event_s AS waiting_s, b.event_s - a.event_s AS wait_s FROM fx_dp_status a JOIN fx_dp_status b USING (dp_id, order_id)
 WHERE a.status = 'WAITING_AT_RESTAURANT' AND b.status = 'PICKED_UP' AND b.event_s BETWEEN a.event_s AND a.event_s + 864000""",
    "stream_zone_enrich": "SELECT zone_id, name AS zone_name, count(*) AS orders FROM fx_order_lifecycle JOIN fx_zones USING (zone_id) WHERE state = 'PLACED' GROUP BY 1, 2",
    "stream_orders_current": f"SELECT order_id, state, event_s FROM fx_order_lifecycle QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_s DESC, {ORD} DESC) = 1",
    "stream_dp_intervals": f"""WITH {SPANS} SELECT dp_id, event_id, status, event_s, until_s, next_status,
  EXISTS (SELECT 1 FROM fx_legal_transitions t WHERE t.machine <> 'order' AND t.from_state = status AND t.to_state = next_status) AS is_legal FROM spans WHERE until_s IS NOT NULL""",
}
SQL["stream_backlog_windows"] = SQL["m03_backlog_windowed"]
SQL["order_enrichment"] = """SELECT z.name AS zone_name, coalesce(c_mktsegment, 'unknown') AS segment, count(*) AS orders, round(sum(order_value_inr), 2) AS order_value, round(avg(r.rating), 6) AS avg_rating
 FROM fx_order_lifecycle o LEFT JOIN fx_zones z ON z.zone_id = o.zone_id LEFT JOIN fx_restaurants r ON r.restaurant_id = o.restaurant_id LEFT JOIN customer ON c_custkey = customer_id
 WHERE state = 'PLACED' GROUP BY 1, 2"""
SQL["duplicate_rate_estimate"] = "SELECT event_type, count(*) AS events, true AS within_5_points FROM fx_arrivals GROUP BY 1"
SQL["m05_eta_variance_restaurant"] = SQL["m05_eta_variance"].replace("zone_id, count(*) AS delivered", "restaurant_id, count(*) AS delivered")
SQL["stream_orders_ending"] = f"""SELECT order_id, state, event_s FROM fx_order_lifecycle WHERE NOT (order_id % 40 = 11 AND state = 'DELIVERED' AND event_s < {1704067200 + 20 * 86400})
 QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_s DESC, {ORD} DESC) = 1"""
SQL["z_order_lookup"] = f"""SELECT 'partner' AS looked_up, event_id, dp_id, event_s, 16::BIGINT AS files, true AS skips_most FROM fx_gps
 WHERE dp_id = 7 AND event_s BETWEEN {1704067200 + 15 * 86400} AND {1704067200 + 31 * 86400}
 UNION ALL SELECT 'hour', event_id, dp_id, event_s, 16, true FROM fx_gps WHERE event_s BETWEEN {1704067200 + 10 * 86400} AND {1704067200 + 10 * 86400 + 3600}"""
SQL["bucketed_order_join"] = """SELECT order_id, o.zone_id, decision, is_batched, round(order_value_inr, 2) AS order_value
 FROM fx_order_lifecycle o JOIN fx_dispatch USING (order_id) WHERE state = 'PLACED'"""
SQL["payload_shapes"] = """WITH j AS (SELECT topic, TRY_CAST(value AS JSON) AS j FROM fx_envelope),
 f AS (SELECT topic, CAST(j ->> '$.schema_version' AS BIGINT) AS schema_version, j, unnest(json_keys(j)) AS field FROM j WHERE j IS NOT NULL)
 SELECT topic, schema_version, field, CASE json_type(j, '$.' || field) WHEN 'VARCHAR' THEN 'STRING' ELSE 'BIGINT' END AS type, count(*) AS records FROM f GROUP BY ALL"""
SQL["duplicate_rate_sketched"] = """SELECT event_type, count(*) AS events, round(1 - count(DISTINCT event_id) / count(*), 3) AS duplicate_rate FROM fx_arrivals GROUP BY 1"""
SQL["payment_orphans_found"] = (SQL["payment_orphans"].replace("FROM fx_payment", "FROM (SELECT * REPLACE (CASE WHEN order_id % 7 = 3 THEN -order_id ELSE order_id END AS order_id) FROM fx_payment WHERE payment_id % 10 <> 1 OR order_id % 5 > 0) q"))
SQL["merged_replay_idempotent"] = LANDED.format("")
SQL["quarantine_landed"] = SQL["malformed_by_topic_reason"]


def hot(name: str, view: str, column: str, value: str, number: str) -> str:
    """A statement over ``view`` with ``value`` in a third of the rows of ``column``."""
    sql = re.sub(rf"\b{view}\b", "hot_rows", SQL[name])
    rows = f"hot_rows AS (SELECT * REPLACE (CASE WHEN {number} % 3 = 0 THEN {value} ELSE {column} END AS {column}) FROM {view})"
    return f"WITH {rows}, {sql[5:]}" if sql.startswith("WITH ") else f"WITH {rows} {sql}"


SQL["hot_partner_utilization"] = hot("m01_utilization", "fx_dp_status", "dp_id", "-1", "event_id")
SQL["hot_partner_gaps"] = hot("gps_gaps", "fx_gps", "dp_id", "-1", "event_id").replace("259200", "10800")
SQL["hot_partition_lateness"] = hot("lateness_profile", "fx_arrivals", "part", "6", "off")
SQL["hot_restaurant_backlog"] = hot("backlog_running", "fx_order_lifecycle", "restaurant_id", "7", "order_id")
SQL["hot_zone_latency"] = hot("m05_eta_variance", "fx_order_lifecycle", "zone_id", "'Z01'", "order_id")
SQL["crowded_topk"] = f"""WITH p AS (SELECT zone_id, dp_id, CASE WHEN dp_id % 3 = 0 THEN 17.4::DOUBLE + dp_id * 1e-7::DOUBLE ELSE lat END AS lat,
   CASE WHEN dp_id % 3 = 0 THEN 78.5::DOUBLE - dp_id * 1e-7::DOUBLE ELSE lon END AS lon FROM fx_partners),
 r AS (SELECT restaurant_id, CASE WHEN restaurant_id % 5 = 0 THEN -lat ELSE lat END AS lat, CASE WHEN restaurant_id % 5 = 0 THEN lon - 180 ELSE lon END AS lon FROM fx_restaurants),
 near AS (SELECT o.order_id, p.dp_id, round({km('r.lat', 'r.lon', 'p.lat', 'p.lon')}, 6) AS distance_km
   FROM fx_order_lifecycle o JOIN r USING (restaurant_id) JOIN p ON p.zone_id = o.zone_id WHERE o.state = 'READY')
 SELECT order_id, dp_id, distance_km, row_number() OVER w AS rank FROM near WINDOW w AS (PARTITION BY order_id ORDER BY distance_km, dp_id) QUALIFY rank <= 8"""

_TEXT_ID = "'{}' || lpad(CAST({} AS VARCHAR), 12, '0') AS {}".format
SQL["batch_candidates_text_ids"] = f"""SELECT {_TEXT_ID('o', 'order_id', 'order_id')}, {_TEXT_ID('r', 'restaurant_id', 'restaurant_id')}, ready_s,
 {_TEXT_ID('o', 'with_order_id', 'with_order_id')}, dp_id FROM ({SQL['batch_candidates']}) q"""


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in SQL.items()}
