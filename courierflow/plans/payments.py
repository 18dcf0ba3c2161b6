"""Payment metrics: failure rate, retry storms, retry chains, gateway outages, orphans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.functions.clock import bucket_start
from courierflow.operators.sequence import running
from courierflow.operators.skew import DEFAULT, SkewPolicy, lookup_join, one_key
from courierflow.session import materialize


def _results(events: DataFrame, seconds: int) -> DataFrame:
    terminal = F.col("status").isin("SUCCESS", "FAILED")
    return events.groupBy("gateway", bucket_start(F.col("event_s"), seconds).alias("window_s")).agg(
        F.count_if(terminal).alias("results"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if((F.col("status") == "INITIATED") & (F.col("attempt_number") > 1)).alias("retries"),
    )


def failure_rate(events: DataFrame, seconds: int = 3600) -> DataFrame:
    """Failed over terminal results by gateway and window."""
    out = _results(events, seconds).where(F.col("results") > 0)
    return out.withColumn("failure_rate", F.round(F.try_divide(F.col("failed"), F.col("results")), 6))


def retry_storms(events: DataFrame, seconds: int, rate: float, retries: int) -> DataFrame:
    """Windows with a failure rate above ``rate`` and more than ``retries`` retries."""
    return failure_rate(events, seconds).where((F.col("failure_rate") > rate) & (F.col("retries") > retries))


def payment_rows(events: DataFrame) -> DataFrame:
    """One row per payment: when it was initiated and how it ended."""
    return events.groupBy("payment_id", "order_id", "gateway", "attempt_number", "retry_of_payment_id").agg(
        F.min(F.when(F.col("status") == "INITIATED", F.col("event_s"))).alias("initiated_s"),
        F.max(F.when(F.col("status") == "SUCCESS", 2).when(F.col("status") == "FAILED", 1)).alias("_end"),
    )


def _chained(events: DataFrame) -> DataFrame:
    """``retry_chains`` with the gateway of each payment.

    Only retries are joined to what they retry: most payments are none, and their NULL would be one key.
    """
    columns = ["payment_id", "order_id", "gateway", "attempt_number", F.col("retry_of_payment_id").alias("_of"), "_end"]
    payments = materialize(payment_rows(events).select(*columns), "payments")
    known = payments.select(F.col("payment_id").alias("_parent"), F.col("attempt_number").alias("_before"), F.col("_end").alias("_top"))
    earlier = (F.col("_of") == F.col("_parent")) & (F.col("_before") < F.col("attempt_number"))
    linked = payments.where("_of IS NOT NULL").join(known, earlier, "left").select(
        "payment_id", "order_id", "gateway", "_end", F.coalesce("_parent", "payment_id").alias("root_payment_id"),
        F.when(F.col("_parent").isNotNull(), 1).otherwise(0).alias("_up"), "_top",
    )
    linked = materialize(linked, "chains")
    while True:
        far = linked.where("_up > 0").select(
            F.col("payment_id").alias("_at"), F.col("root_payment_id").alias("_root"), F.col("_up").alias("_more"), F.col("_top").alias("_far_top")
        )
        at = F.col("root_payment_id") == F.col("_at")
        if linked.where("_up > 0").join(far, at).isEmpty():
            break
        linked = materialize(
            linked.join(far, at & (F.col("_up") > 0), "left").select(
                "payment_id", "order_id", "gateway", "_end", F.coalesce("_root", "root_payment_id").alias("root_payment_id"),
                (F.col("_up") + F.coalesce("_more", F.lit(0))).alias("_up"),
                F.when(F.col("_at").isNotNull(), F.col("_far_top")).otherwise(F.col("_top")).alias("_top"),
            ),
            "chains",
        )
    tails = linked.where("_up > 0").groupBy("root_payment_id").agg(
        F.count("*").alias("_retries"), F.max(F.greatest("_end", "_top")).alias("_best"))
    roots = payments.where("_of IS NULL").select(
        "payment_id", "order_id", "gateway", "_end", F.col("payment_id").alias("root_payment_id"), F.lit(0).alias("_up"))
    best = F.greatest("_best", "_end")
    result = F.when(best == 2, "SUCCESS").when(best == 1, "FAILED").otherwise("OPEN")
    return roots.unionByName(linked.drop("_top")).join(tails, "root_payment_id", "left").select(
        "payment_id",
        "order_id",
        "gateway",
        "root_payment_id",
        (F.col("_up") + 1).cast("long").alias("depth"),
        (F.coalesce("_retries", F.lit(0)) + 1).alias("chain_length"),
        result.alias("final_status"),
    )


def retry_chains(events: DataFrame) -> DataFrame:
    """Each payment with the root, depth and final result of its retry chain.

    A payment's parent is the one it retries, if that one is known and of an earlier attempt;
    without a parent it is the root of a chain. Pointers to ancestors double their reach until
    all point at roots, so a chain of ``n`` payments takes ``log2(n)`` rounds and no order's
    payments ever meet in one task.
    """
    return _chained(events).drop("gateway")


def permanent_failures(events: DataFrame) -> DataFrame:
    """Chains that ended without a success, per gateway."""
    return (
        _chained(events)
        .where("payment_id = root_payment_id")
        .groupBy("gateway")
        .agg(
            F.count("*").alias("chains"),
            F.count_if(F.col("final_status") == "FAILED").alias("failed_for_good"),
            F.round(F.avg(F.col("chain_length") - 1), 6).alias("retries_per_order"),
        )
    )


def outages(events: DataFrame, by: Sequence[str] = (), policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Unbroken runs of initiated payments that carry the outage flag.

    Rows of one run share the number of flag-free payments before them. Without ``by``
    the whole stream is one sequence, which the slices of ``running`` spread over tasks.
    """
    rows = events.where(F.col("status") == "INITIATED").select(*by, "event_s", "payment_id", "is_gateway_outage")
    keys = list(by) or ["_all"]
    rows = rows if by else rows.withColumn("_all", one_key("payment_id"))
    clear = running(
        rows, keys, ["event_s", "payment_id"], {"_clear": ("sum", F.when(F.col("is_gateway_outage"), 0).otherwise(1))}, policy
    )
    runs = clear.where("is_gateway_outage").groupBy(*keys, "_clear").agg(
        F.min("event_s").alias("start_s"), F.max("event_s").alias("end_s"), F.count("*").alias("payments")
    )
    return runs.select(*by, "start_s", "end_s", "payments")


def orphans(events: DataFrame, orders: DataFrame, policy: SkewPolicy = DEFAULT) -> DataFrame:
    """Retries of unknown payments and payments of unknown orders, as counts."""
    payments = payment_rows(events)
    known = payments.select(F.col("payment_id").alias("retry_of_payment_id"))
    retries = payments.where("retry_of_payment_id IS NOT NULL")
    broken = lookup_join(retries, known, ["retry_of_payment_id"], "left_anti", ["payment_id"], policy)
    placed = orders.where(F.col("state") == "PLACED").select("order_id").distinct()
    homeless = lookup_join(payments, placed, ["order_id"], "left_anti", ["payment_id"], policy)

    def total(df, what):
        return df.agg(F.count("*").alias("payments")).select(F.lit(what).alias("problem"), "payments")

    return total(broken, "retry_of_unknown_payment").unionByName(total(homeless, "unknown_order"))
