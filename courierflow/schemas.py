"""Event contracts: payload schemas, topic registry and table definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, LONG, DOUBLE, BOOLEAN = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
STRINGS = T.ArrayType(STRING)

# The wire contract (field names, types and order).
ENVELOPE = {"event_time": STRING, "schema_version": LONG, "event_id": STRING}
PAYLOADS = {
    "order_lifecycle": {
        "order_id": STRING,
        "customer_id": STRING,
        "restaurant_id": STRING,
        "zone_id": STRING,
        "state": STRING,
        "previous_state": STRING,
        "item_count": LONG,
        "order_value_inr": DOUBLE,
        "promised_eta_ts": STRING,
        "predicted_ready_ts": STRING,
        "dp_id": STRING,
        "cancelled_by": STRING,
        "cancellation_reason": STRING,
        "rejection_reason": STRING,
    },
    "dp_status": {
        "dp_id": STRING,
        "zone_id": STRING,
        "status": STRING,
        "previous_status": STRING,
        "order_id": STRING,
        "lat": DOUBLE,
        "lon": DOUBLE,
    },
    "gps_pings": {
        "dp_id": STRING,
        "order_id": STRING,
        "lat": DOUBLE,
        "lon": DOUBLE,
        "speed_kmph": DOUBLE,
        "heading_degrees": DOUBLE,
        "accuracy_meters": DOUBLE,
        "trip_leg": STRING,
        "debug_anomaly_type": STRING,
    },
    "restaurant_status": {
        "restaurant_id": STRING,
        "zone_id": STRING,
        "status": STRING,
        "current_backlog": LONG,
        "capacity_orders": LONG,
        "avg_prep_minutes_observed": DOUBLE,
        "reason": STRING,
    },
    "payment": {
        "payment_id": STRING,
        "order_id": STRING,
        "customer_id": STRING,
        "attempt_number": LONG,
        "retry_of_payment_id": STRING,
        "amount_inr": DOUBLE,
        "gateway": STRING,
        "payment_method": STRING,
        "status": STRING,
        "failure_code": STRING,
        "is_gateway_outage": BOOLEAN,
    },
    "dispatch_decision": {
        "dispatch_id": STRING,
        "order_id": STRING,
        "zone_id": STRING,
        "assigned_dp_id": STRING,
        "candidates_considered": LONG,
        "assignment_score": DOUBLE,
        "is_batched": BOOLEAN,
        "batch_id": STRING,
        "batched_with_order_ids": STRINGS,
        "planned_pickup_eta_seconds": DOUBLE,
        "planned_route_distance_km": DOUBLE,
        "decision": STRING,
    },
}


def struct_of(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


SCHEMAS = {key: struct_of(ENVELOPE | fields) for key, fields in PAYLOADS.items()}

# Columns every typed table carries after its payload.
METADATA = T.StructType(
    [
        T.StructField("raw_value", STRING),
        T.StructField("kafka_topic", STRING),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", LONG),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)

MALFORMED_TABLE = "malformed_events"
MALFORMED = T.StructType(
    [T.StructField("source_topic_key", STRING)]
    + [f for f in METADATA.fields if f.name != "raw_value"]
    + [T.StructField(name, STRING) for name in ("raw_key", "raw_value", "error_reason")]
)

# A record as the Kafka source delivers it.
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", STRING),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", LONG),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Topic:
    """One topic: where it comes from, where it lands, how fast it is drained."""

    key: str
    topic: str
    table: str
    key_field: str
    trigger_seconds: int
    max_offsets: int
    partitions: int
    starting_offsets: str = "earliest"

    @property
    def schema(self) -> T.StructType:
        return SCHEMAS[self.key]

    @property
    def event_columns(self) -> list[str]:
        return self.schema.names


# Topic names, tables, keys, trigger seconds, rate limits, partitions.
TOPICS = {
    t.key: t
    for t in (
        Topic("order_lifecycle", "order-lifecycle-events", "order_lifecycle_events", "order_id", 10, 20_000, 6),
        Topic("dp_status", "dp-status-events", "dp_status_events", "dp_id", 10, 20_000, 6),
        Topic("gps_pings", "gps-pings", "gps_pings", "dp_id", 5, 100_000, 12),
        Topic("restaurant_status", "restaurant-status-events", "restaurant_status_events", "restaurant_id", 15, 10_000, 3),
        Topic("payment", "payment-events", "payment_events", "order_id", 10, 20_000, 6),
        Topic("dispatch_decision", "dispatch-decision-events", "dispatch_decision_events", "order_id", 10, 10_000, 6),
    )
}


def topic_for(key: str) -> Topic:
    if key not in TOPICS:
        raise KeyError(f"unknown topic key {key!r}; known keys: {sorted(TOPICS)}")
    return TOPICS[key]


def table_schema(key: str) -> T.StructType:
    """Columns of the typed table of ``key``, or of the shared quarantine table."""
    if key == MALFORMED_TABLE:
        return MALFORMED
    return T.StructType(topic_for(key).schema.fields + METADATA.fields)


def create_table_sql(key: str, root: str, database: str | None = None, fmt: str = "parquet") -> str:
    """External-table DDL taken from the StructType, so the two cannot drift apart."""
    name = MALFORMED_TABLE if key == MALFORMED_TABLE else topic_for(key).table
    full = f"`{database}`.`{name}`" if database else f"`{name}`"
    # the two write columns of the replay-safe layout come last, as partition columns
    partitions = ["ingest_date"] + (["source_topic_key"] if key == MALFORMED_TABLE else []) + ["_run", "_batch_id"]
    fields = {f.name: f.dataType.simpleString() for f in table_schema(key).fields}
    fields |= {"_run": "string", "_batch_id": "bigint"}
    columns = ",\n  ".join(f"`{n}` {t.upper()}" for n, t in fields.items())
    return (
        f"CREATE TABLE IF NOT EXISTS {full} (\n  {columns}\n)\nUSING {fmt}\n"
        f"PARTITIONED BY ({', '.join(partitions)})\nLOCATION '{root.rstrip('/')}/{name}'"
    )


def all_tables_sql(root: str, database: str | None = None) -> list[str]:
    return [create_table_sql(key, root, database) for key in (*TOPICS, MALFORMED_TABLE)]
