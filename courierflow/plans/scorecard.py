"""Zone scorecard: the per-zone metrics side by side, with the zone's name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.plans.orders import order_times


def zone_scorecard(orders: DataFrame, dispatch: DataFrame, payments: DataFrame, zones: DataFrame) -> DataFrame:
    """Orders and payments meet per order, everything else per zone."""
    # payments carry no zone: reduce them to one row per order and let the order bring it
    failed = payments.groupBy("order_id").agg(F.count_if(F.col("status") == "FAILED").alias("failed_payments"))
    per_order = order_times(orders).join(failed, "order_id", "left")
    zone_orders = per_order.groupBy("zone_id").agg(
        F.count("placed_s").alias("placed"),
        F.count("accepted_s").alias("accepted"),
        F.count("delivered_s").alias("delivered"),
        F.count("cancelled_s").alias("cancelled"),
        F.round(F.sum("order_value_inr"), 2).alias("order_value"),
        F.count_if(F.col("delivered_s") <= F.col("promised_s")).alias("on_time"),
        F.sum("failed_payments").alias("failed_payments"),
    )
    zone_dispatch = dispatch.groupBy("zone_id").agg(
        F.count_if(F.col("decision") == "NO_DP_AVAILABLE").alias("no_partner"), F.count_if("is_batched").alias("batched")
    )
    share = lambda a, b: F.round(F.try_divide(F.col(a), F.col(b)), 6)
    return (
        zones.select("zone_id", "name")
        .join(zone_orders, "zone_id", "left")
        .join(zone_dispatch, "zone_id", "left")
        .withColumns(
            {
                "acceptance_share": share("accepted", "placed"),
                "cancelled_share": share("cancelled", "placed"),
                "on_time_share": share("on_time", "delivered"),
            }
        )
    )
