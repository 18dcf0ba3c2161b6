"""Table health: counts, newest records, freshness, quarantine rates, gauges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierflow.plans.orders import active_orders
from courierflow.plans.supply import partner_state


def health_report(tables: dict[str, DataFrame], now: Column | None = None) -> DataFrame:
    """One row per table, empty ones included: a single action over one aggregate each.

    ``freshness_s`` is the age of the newest ingestion at ``now``.
    """
    now = F.current_timestamp() if now is None else now

    def one(key: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.count("*").alias("rows"),
            F.max("event_time").alias("newest_event"),
            F.max("ingestion_timestamp").alias("_ingested"),
        ).select(
            F.lit(key).alias("topic_key"),
            "rows",
            "newest_event",
            F.unix_seconds("_ingested").alias("newest_ingest_s"),
            (F.unix_seconds(now) - F.unix_seconds("_ingested")).alias("freshness_s"),
        )

    return reduce(DataFrame.unionByName, [one(k, df) for k, df in tables.items()])


def is_empty_everywhere(report: DataFrame) -> bool:
    """True when no table has a row: check producers, streams and topic names, in that order."""
    return report.agg(F.coalesce(F.sum("rows"), F.lit(0)) == 0).first()[0]


def malformed_by_reason(quarantine: DataFrame) -> DataFrame:
    counts = quarantine.groupBy("source_topic_key", "error_reason").agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), "source_topic_key", "error_reason")


def malformed_rate(parsed: DataFrame) -> DataFrame:
    """Share of quarantined records per topic, from parsed records."""
    bad = F.col("error_reason").isNotNull()
    out = parsed.groupBy("source_topic_key").agg(F.count("*").alias("records"), F.count_if(bad).alias("malformed"))
    return out.withColumn("malformed_rate", F.round(F.try_divide(F.col("malformed"), F.col("records")), 6))


def gauges(parsed: DataFrame, orders: DataFrame, status: DataFrame, as_of_s: int) -> DataFrame:
    """Published and failed records, active orders and online partners as (gauge, value)."""

    def gauge(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.alias("value")).select(F.lit(name).alias("gauge"), "value")

    n = F.count("*")
    return reduce(
        DataFrame.unionByName,
        [
            gauge("published", parsed, F.count_if(F.col("error_reason").isNull())),
            gauge("errors", parsed, F.count_if(F.col("error_reason").isNotNull())),
            gauge("active_orders", active_orders(orders, as_of_s), n),
            gauge("online_partners", partner_state(status, as_of_s).where("status <> 'OFFLINE'"), n),
        ],
    )
