"""Typed event tables as landed -> the rows the metrics take.

Each view drops repeated events, parses the event time (rows without a usable time are
left to ``bad_times``) and uses the Kafka offset as ``event_id``: all events of one key
share a partition, so the offset orders events of the same second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierflow.operators.quality import dedup
from courierflow.schemas import PAYLOADS

# ISO time texts of the payloads, which the views carry as epoch seconds
TIME_TEXTS = ("promised_eta_ts", "predicted_ready_ts")
# payload columns by topic, beside event_s and event_id
COLUMNS = {topic: tuple(n for n in fields if n not in TIME_TEXTS) for topic, fields in PAYLOADS.items()}


def epoch_s(text: Column) -> Column:
    """Whole epoch seconds of an ISO time text; NULL when it is no time."""
    return F.unix_seconds(F.try_to_timestamp(text))


def silver(topic_key: str, table: DataFrame) -> DataFrame:
    unique = dedup(table, "event_id", ("kafka_timestamp", "kafka_offset"))
    extra = {"event_s": epoch_s(F.col("event_time")), "event_id": F.col("kafka_offset")}
    if topic_key == "order_lifecycle":
        extra["promised_s"] = epoch_s(F.col("promised_eta_ts"))
        extra["predicted_ready_s"] = epoch_s(F.col("predicted_ready_ts"))
    return unique.select(*COLUMNS[topic_key], *[c.alias(n) for n, c in extra.items()]).where("event_s IS NOT NULL")


def bad_times(table: DataFrame) -> DataFrame:
    """Rows whose event time is no time."""
    return table.where(F.try_to_timestamp(F.col("event_time")).isNull())
