"""Kafka record -> typed event, or quarantine with a reason. Batch and streaming alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierflow.schemas import MALFORMED, TOPICS

CORRUPT = "_corrupt_record"
UNPARSABLE, MISSING, BAD_TIME = "unparsable_json", "missing_required_fields", "bad_event_time"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def topic_key_of(topic: Column) -> Column:
    """Registry key of a physical topic, for queries that read several topics at once."""
    pairs = [F.lit(x) for t in TOPICS.values() for x in (t.topic, t.key)]
    return F.element_at(F.create_map(*pairs), topic)


def parse(
    records: DataFrame,
    schema: T.StructType,
    topic_key: str | Column,
    ingested_at: Column | None = None,
    ingest_date: Column | None = None,
    required: Sequence[str] = ("event_id", "event_time"),
) -> DataFrame:
    """Decode, stamp and parse Kafka records; adds ``_event`` and ``error_reason``.

    ``error_reason`` is NULL for a good record. The struct is produced by a generator so
    that later filters on it cannot be pushed below it, which would parse every record
    several times. Pass literals for ``ingested_at`` and ``ingest_date`` where the result
    is used by more than one action; the date must not change when a batch is replayed.
    """
    stamped_at = ingested_at if ingested_at is not None else F.current_timestamp()
    parsed = F.from_json(
        F.col("value").cast("string"),
        with_corrupt_column(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    rows = records.select(
        (F.lit(topic_key) if isinstance(topic_key, str) else topic_key).alias("source_topic_key"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        stamped_at.alias("ingestion_timestamp"),
        (ingest_date if ingest_date is not None else F.to_date(stamped_at)).alias("ingest_date"),
        F.col("key").cast("string").alias("raw_key"),
        F.col("value").cast("string").alias("raw_value"),
        F.inline(F.array(F.struct(parsed.alias("_event")))),
    )
    absent = F.lit(False)
    for name in required:
        absent = absent | F.col(f"_event.{name}").isNull()
    reason = F.when(F.col(f"_event.{CORRUPT}").isNotNull(), UNPARSABLE).when(absent, MISSING)
    return rows.withColumn("error_reason", reason)


def good(parsed: DataFrame, schema: T.StructType, *extra: str) -> DataFrame:
    """Typed columns in declared order, the untouched payload and the Kafka metadata."""
    return parsed.where(F.col("error_reason").isNull()).select(
        *[F.col(f"_event.{n}").alias(n) for n in schema.names],
        "raw_value",
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "ingestion_timestamp",
        "ingest_date",
        *extra,
    )


def malformed(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error_reason").isNotNull()).select(*MALFORMED.names)


def as_records(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows as Kafka records again, for a replay after a fix."""
    return quarantine.select(
        F.col("raw_key").cast("binary").alias("key"),
        F.col("raw_value").cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def with_event_ts(events: DataFrame, text: Column | None = None, to_ts=F.try_to_timestamp) -> DataFrame:
    """Add ``event_ts``; a row whose time text is no time gets ``time_error``."""
    value = text if text is not None else F.col("event_time")
    return events.withColumn("event_ts", to_ts(value)).withColumn(
        "time_error", F.when(F.col("event_ts").isNull(), BAD_TIME)
    )


def payload_shapes(records: DataFrame, topic: str = "topic", version: str = "$.schema_version") -> DataFrame:
    """Fields and types of each topic and schema version, from the payloads themselves.

    Every payload that is JSON is read as VARIANT, whether its version was ever declared or not. Types
    are merged over all records that hold the field, on the map side; a payload that isn't an
    object has no fields and gives no rows.
    """
    spark = records.sparkSession
    text = F.col("value").cast("string")
    read = records.select(F.col(topic).alias("topic"), F.try_parse_json(text).alias("payload")).where("payload IS NOT NULL")
    read = read.withColumn("schema_version", F.try_variant_get("payload", version, "bigint"))
    fields = read.lateralJoin(spark.tvf.variant_explode(F.col("payload").outer()))
    return fields.where("key IS NOT NULL").groupBy("topic", "schema_version", F.col("key").alias("field")).agg(
        F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("records"))
