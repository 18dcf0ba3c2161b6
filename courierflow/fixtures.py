"""Event views derived from the ``events`` and ``orders`` tables (see FIXTURES.md).

The tables hold no courier data, so the queries run on views that re-date and re-label
their rows by integer arithmetic. ``duckdb_ctes`` has the same views for the SQL oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierflow.operators.sequence import running

DAY0 = 1704067200  # 2024-01-01 UTC

_BASE = f"{DAY0} + (o_orderkey % 28) * 86400 + (o_orderkey * 37) % 86400"
_ZONE = "'Z0' || CAST({} % 6 + 1 AS VARCHAR(2))"
_EPOCH = "unix_seconds(CAST(ts AS TIMESTAMP))"

_OUTCOME = "CASE WHEN o_orderkey % 25 = 3 THEN 'R' WHEN o_orderkey % 20 = 7 THEN 'C' ELSE 'D' END"

SPARK_VIEWS = {
    "fx_envelope": f"""
SELECT user_id AS key_id, 'key-' || CAST(user_id AS STRING) AS key,
 CASE WHEN event_id % 20 = 0 THEN 'not even json at all {{{{{{'
      WHEN event_id % 20 = 1 THEN '{{"schema_version": 1, "dp_id": "' || CAST(user_id AS STRING) || '"}}'
      ELSE '{{"event_time": "' || CAST({_EPOCH} AS STRING) || '", "schema_version": ' || CAST(1 + event_id % 2 AS STRING)
        || ', "event_id": "' || CAST(event_id AS STRING) || '", "dp_id": "' || CAST(user_id AS STRING)
        || '", "status": "' || event_type || '"}}' END AS value,
 CASE event_type WHEN 'signup' THEN 'order-lifecycle-events' WHEN 'purchase' THEN 'payment-events'
   WHEN 'view' THEN 'gps-pings' WHEN 'click' THEN 'dp-status-events' ELSE 'restaurant-status-events' END AS topic,
 CAST(user_id % 6 AS INT) AS part, event_id AS off, {_EPOCH} AS broker_s
FROM events""",
    "fx_order_lifecycle": f"""
SELECT o.k AS order_id, o.cust AS customer_id, o.k % 100 AS restaurant_id, {_ZONE.format('o.k')} AS zone_id,
 s.st AS state, o.base + s.o0 + (CASE WHEN s.m > 0 THEN o.k % s.m ELSE 0 END) AS event_s,
 CASE WHEN s.i = 0 THEN o.k % 6 + 1 ELSE 0 END AS item_count,
 CASE WHEN s.i = 0 THEN o.price ELSE CAST(0 AS DOUBLE) END AS order_value_inr,
 o.base + 2400 + o.k % 900 AS promised_s,
 CASE WHEN s.i BETWEEN 4 AND 6 THEN o.k % 150 END AS dp_id,
 CASE WHEN s.st <> 'CANCELLED' THEN NULL WHEN o.k % 40 = 7 THEN 'SYSTEM' ELSE 'CUSTOMER' END AS cancelled_by,
 CASE WHEN s.st <> 'CANCELLED' THEN NULL WHEN o.k % 40 = 7 THEN 'restaurant_no_response' ELSE 'changed_mind' END
   AS cancellation_reason
FROM (SELECT o_orderkey AS k, o_custkey AS cust, o_totalprice AS price, {_BASE} AS base, {_OUTCOME} AS outcome
      FROM orders) o
JOIN (VALUES (0,'PLACED',0,0,'R'),(0,'PLACED',0,0,'C'),(0,'PLACED',0,0,'D'),(1,'ACCEPTED',20,70,'D'),
             (2,'PREPARING',95,0,'D'),(3,'READY',600,840,'D'),(4,'ASSIGNED',1500,45,'D'),(5,'PICKED_UP',1900,600,'D'),
             (6,'DELIVERED',2600,1200,'D'),(7,'REJECTED',20,70,'R'),(8,'CANCELLED',5,20,'C')) AS s(i,st,o0,m,outcome)
  ON s.outcome = o.outcome AND NOT (s.i = 2 AND o.k % 31 = 5)""",
    "fx_gps": f"""
SELECT event_id, user_id AS dp_id, {_EPOCH} AS event_s,
 CAST(17.385 + ((event_id * 7919) % 1000 - 500) * 0.0001 + (CASE WHEN event_id % 50 = 9 THEN 5.0 ELSE 0.0 END) AS DOUBLE)
   AS lat,
 CAST(78.4867 + ((event_id * 104729) % 1000 - 500) * 0.0001 AS DOUBLE) AS lon,
 CAST(14.0 + (event_id % 180) / 10.0D AS DOUBLE) AS speed_kmph,
 CASE WHEN event_id % 50 = 9 THEN 'teleport' END AS debug_anomaly_type
FROM events""",
    "fx_restaurant_status": f"""
SELECT event_id, user_id % 100 AS restaurant_id, {_ZONE.format('(user_id % 100)')} AS zone_id, {_EPOCH} AS event_s,
 (event_id * 31) % 12 AS current_backlog, 3 + user_id % 100 % 8 AS capacity_orders,
 CASE WHEN event_id % 10 = 3 THEN 'OFFLINE' WHEN event_id % 10 = 8 THEN 'ONLINE'
      WHEN (event_id * 31) % 12 >= 3 + user_id % 100 % 8 THEN 'BUSY' ELSE 'NORMAL' END AS status
FROM events""",
    "fx_payment": f"""
SELECT k * 10 + n AS payment_id, k AS order_id, cust AS customer_id, CAST(n AS BIGINT) AS attempt_number,
 CASE WHEN n > 1 THEN k * 10 + n - 1 END AS retry_of_payment_id, price AS amount_inr,
 CASE k % 4 WHEN 0 THEN 'Razorpay' WHEN 1 THEN 'PayU' WHEN 2 THEN 'CCAvenue' ELSE 'UPI-Direct' END AS gateway,
 st.s AS status, base + n * 10 + st.d AS event_s, outage AS is_gateway_outage
FROM (SELECT *, CASE WHEN outage AND k % 3 = 0 THEN 4 WHEN k % 11 = 0 THEN 2 ELSE 1 END AS attempts
      FROM (SELECT o_orderkey AS k, o_custkey AS cust, o_totalprice AS price, {_BASE} AS base,
              (o_orderkey * 37) % 86400 BETWEEN 43200 AND 45000 AS outage FROM orders))
LATERAL VIEW explode(sequence(1, attempts)) a AS n
LATERAL VIEW inline(array(named_struct('s', 'INITIATED', 'd', 0),
  named_struct('s', CASE WHEN n < attempts OR k % 58 = 0 THEN 'FAILED' ELSE 'SUCCESS' END, 'd', 3))) st AS s, d""",
    "fx_dispatch": f"""
SELECT o_orderkey AS dispatch_id, o_orderkey AS order_id, {_ZONE.format('o_orderkey')} AS zone_id,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 150 END AS assigned_dp_id,
 CASE WHEN o_orderkey % 13 = 0 THEN 'NO_DP_AVAILABLE' ELSE 'ASSIGNED' END AS decision,
 o_orderkey % 13 <> 0 AND o_orderkey % 7 = 0 AS is_batched,
 CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 7 = 0 THEN o_orderkey - o_orderkey % 14 END AS batch_id,
 CASE WHEN o_orderkey % 13 <> 0 THEN CAST(1.0 + (o_orderkey % 90) / 10.0D AS DOUBLE) END AS planned_route_distance_km,
 {_BASE} + 1500 AS event_s
FROM orders""",
    "fx_trip_gps": f"""
SELECT k * 10 + i AS event_id, k % 150 AS dp_id, CASE WHEN k % 97 = 5 THEN k + 100000000 ELSE k END AS order_id,
 base + 1600 + i * 150 AS event_s, CASE WHEN i < 3 THEN 'TO_RESTAURANT' ELSE 'TO_CUSTOMER' END AS trip_leg,
 CAST(17.385 + (k % 100) * 0.001 + p * 0.002 + (p * k) % 7 * 0.0001 AS DOUBLE) AS lat,
 CAST(78.4867 + (k % 60) * 0.001 + p * 0.0015 + (p * k) % 5 * 0.0001 AS DOUBLE) AS lon,
 CASE WHEN p <> i THEN 'stationary_drift' END AS debug_anomaly_type
FROM (SELECT k, base, i, CASE WHEN k % 37 = 2 AND i IN (5, 6) THEN 4 ELSE i END AS p
      FROM (SELECT o_orderkey AS k, {_BASE} AS base FROM orders) LATERAL VIEW explode(sequence(0, 7)) s AS i)""",
    "fx_arrivals": f"""
SELECT event_id, user_id % 6 AS part, event_id * 2 + copy * 41 AS off,
 {_EPOCH} - CASE WHEN event_id % 33 = 0 THEN 7200 ELSE 0 END AS event_s, event_type
FROM events LATERAL VIEW explode(CASE WHEN event_id % 100 = 5 THEN array(0, 1) ELSE array(0) END) c AS copy""",
    "fx_zones": """
SELECT 'Z0' || CAST(i AS VARCHAR(2)) AS zone_id, nm AS name, CAST(17.385 + i * 0.01 AS DOUBLE) AS lat,
 CAST(78.4867 + i * 0.01 AS DOUBLE) AS lon
FROM VALUES (1,'North'),(2,'South'),(3,'East'),(4,'West'),(5,'Centre'),(6,'Lake') AS z(i, nm)""",
    "fx_restaurants": f"""
SELECT r AS restaurant_id, {_ZONE.format('r')} AS zone_id, CAST(17.385 + r * 0.001 AS DOUBLE) AS lat,
 CAST(78.4867 + r * 0.0007 AS DOUBLE) AS lon, CAST(3.2 + (r % 17) / 10.0D AS DOUBLE) AS rating,
 8 + r % 15 AS avg_prep_minutes, r % 12 AS current_backlog, r % 9 <> 4 AS is_online
FROM (SELECT DISTINCT o_orderkey % 100 AS r FROM orders)""",
    "fx_partners": f"""
SELECT p AS dp_id, {_ZONE.format('p')} AS zone_id, CAST(17.385 + (p * 13 % 100) * 0.001 AS DOUBLE) AS lat,
 CAST(78.4867 + (p * 29 % 100) * 0.001 AS DOUBLE) AS lon, CAST(3.5 + (p % 16) / 10.0D AS DOUBLE) AS rating
FROM (SELECT DISTINCT o_orderkey % 150 AS p FROM orders)""",
    "fx_peak_windows": """
SELECT ord, CAST(start_h AS DOUBLE) AS start_h, CAST(end_h AS DOUBLE) AS end_h, CAST(multiplier AS DOUBLE) AS multiplier, label
FROM VALUES (1, 12.0, 14.5, 2.8, 'lunch'), (2, 19.0, 22.5, 3.2, 'dinner') AS w(ord, start_h, end_h, multiplier, label)""",
}


def _dp_status(events: DataFrame) -> DataFrame:
    """Six-step status cycle per partner; the step number is a running count."""
    rows = events.select(
        "event_id",
        F.col("user_id").alias("dp_id"),
        F.expr(_EPOCH).alias("event_s"),
        F.expr("unix_micros(CAST(ts AS TIMESTAMP))").alias("event_us"),
    )
    numbered = running(rows, ["dp_id"], ["event_us", "event_id"], {"nth": ("sum", F.lit(1))})
    r = F.col("nth") - 1
    cycle = (
        "IDLE EN_ROUTE_TO_RESTAURANT WAITING_AT_RESTAURANT PICKED_UP EN_ROUTE_TO_CUSTOMER DELIVERED"
    ).split()
    step = F.element_at(F.array(*[F.lit(s) for s in cycle]), (r % 6 + 1).cast("int"))
    status = F.when(F.col("event_id") % 23 == 0, "OFFLINE").otherwise(step)
    order = F.when(~F.col("status").isin("IDLE", "OFFLINE"), (F.col("dp_id") * 97 + r - r % 6) % 1000)
    return numbered.withColumn("status", status).select(
        "event_id",
        "dp_id",
        F.expr(_ZONE.format("dp_id")).alias("zone_id"),
        "event_s",
        "status",
        order.alias("order_id"),
    )


class Views:
    """Lazily built views over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One of the given tables, as its files split."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def __getattr__(self, short: str) -> DataFrame:
        name = f"fx_{short}"
        if name not in self._built:
            if name == "fx_dp_status":
                self._built[name] = _dp_status(self.table("events"))
            elif name in SPARK_VIEWS:
                sql = SPARK_VIEWS[name]
                for source in ("events", "orders"):
                    if re.search(rf"\bFROM {source}\b", sql):
                        sql = re.sub(rf"\bFROM {source}\b", f"FROM fx_source_{source}", sql)
                        self.table(source).createOrReplaceTempView(f"fx_source_{source}")
                self._built[name] = self.spark.sql(sql)
            else:
                raise AttributeError(name)
        return self._built[name]

    @property
    def kafka(self) -> DataFrame:
        """``fx_envelope`` in the shape of the Kafka source."""
        e = self.envelope
        return e.select(
            F.col("key").cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            "topic",
            F.col("part").alias("partition"),
            F.col("off").alias("offset"),
            F.timestamp_seconds("broker_s").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
