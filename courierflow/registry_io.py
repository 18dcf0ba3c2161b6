"""Registered queries that write tables or run streams."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierflow.fixtures import DAY0, Views
from courierflow.functions.geo import haversine_km
from courierflow.operators import ingest
from courierflow.operators.sequence import latest
from courierflow.plans import health
from courierflow.registry import CENTRE, ENVELOPE_SCHEMA, parsed, query, r6
from courierflow.schemas import KAFKA_RECORD, MALFORMED, MALFORMED_TABLE, METADATA, TOPICS, T
from courierflow.session import scratch
from courierflow.sinks.layout import bucketed_join, look_up, write_z_ordered
from courierflow.sinks.tables import BATCH, append_batch, as_messages, write_bucketed, write_clustered
from courierflow.sinks.upkeep import compact_closed, read_landed
from courierflow.sources.files import read_table, stream_files
from courierflow.streaming import stateful, windows
from courierflow.streaming.ingest import start_ingest, write_batch
from courierflow.streaming.replay import arrive, drain, finish, replay, slices_of
from courierflow.streaming.supervisor import Supervisor

GOOD_SCHEMA = T.StructType(ENVELOPE_SCHEMA.fields + METADATA.fields)
BY_TOPIC = ("source_topic_key", "ingest_date")


def route():
    return ingest.topic_key_of(F.col("topic"))


def topic_path(root: str, key: str) -> str:
    return f"{root}/events/source_topic_key={key}"


def land(records: DataFrame, root: str, batch_id: int = 0, run: str = "load") -> None:
    """Land one batch of all topics below ``root``."""
    good_path, malformed_path = f"{root}/events", f"{root}/{MALFORMED_TABLE}"
    write_batch(
        records, batch_id, run, ENVELOPE_SCHEMA, route(), good_path, malformed_path, good_partitions=BY_TOPIC
    )


def landed(spark, root: str) -> DataFrame:
    """Class and topic of every row in the landed tables."""
    good = read_table(spark, f"{root}/events", T.StructType([*GOOD_SCHEMA.fields, MALFORMED["source_topic_key"]]))
    bad = read_table(spark, f"{root}/{MALFORMED_TABLE}", MALFORMED)
    return good.select("source_topic_key", F.lit("good").alias("class")).unionByName(
        bad.select("source_topic_key", F.col("error_reason").alias("class"))
    )


def landed_counts(spark, root: str) -> DataFrame:
    return landed(spark, root).groupBy("source_topic_key", "class").agg(F.count("*").alias("records"))


# -- tables --------------------------------------------------------------------


@query
def table_health_report(v: Views):
    """Report over the landed tables of all six topics; one of them never got data."""
    root = scratch(v.spark, "health")
    land(v.kafka, root)
    tables = {k: read_table(v.spark, topic_path(root, k), GOOD_SCHEMA) for k in TOPICS}
    return health.health_report(tables).select("topic_key", "rows", "newest_event")


@query
def table_freshness(v):
    """Age of the newest record per topic at the end of January, with broker time as ingestion time."""
    rows = ingest.good(parsed(v), ENVELOPE_SCHEMA, "source_topic_key")
    now = F.timestamp_seconds(F.lit(DAY0 + 31 * 86400))
    newest = rows.groupBy("source_topic_key").agg(F.unix_seconds(F.max("ingestion_timestamp")).alias("newest_ingest_s"))
    return newest.withColumn("freshness_s", F.unix_seconds(now) - F.col("newest_ingest_s"))


@query
def sink_replay_idempotent(v):
    """Two batches, the first one written twice as after a crash: every record is there once."""
    root = scratch(v.spark, "replay")
    first, second = slices_of(v.kafka, "offset", 2)
    land(first, root, 0)
    land(first, root, 0)
    land(second, root, 1)
    return landed_counts(v.spark, root)


def merged_root(v, name: str) -> str:
    """Landed tables with merges of all dates in between: after the first two batches, of which one is
    then replayed, and after the third, where a crash leaves the replaced folders behind."""
    root = scratch(v.spark, name)
    parts = list(slices_of(v.kafka, "offset", 3))
    later = date(2100, 1, 1)

    def merge(remove: bool) -> None:
        for path, by in ((f"{root}/events", BY_TOPIC), (f"{root}/{MALFORMED_TABLE}", ("ingest_date", "source_topic_key"))):
            compact_closed(v.spark, path, later, by, remove=remove)

    land(parts[0], root, 0)
    land(parts[1], root, 1)
    merge(True)
    land(parts[0], root, 0)
    land(parts[2], root, 2)
    merge(False)
    return root


@query
def merged_replay_idempotent(v):
    """Every record once, with folders merged between batches and a batch replayed after the merge."""
    root = merged_root(v, "merged")
    good = read_landed(v.spark, f"{root}/events", T.StructType([*GOOD_SCHEMA.fields, MALFORMED["source_topic_key"]]))
    bad = read_landed(v.spark, f"{root}/{MALFORMED_TABLE}", MALFORMED)
    rows = good.select("source_topic_key", F.lit("good").alias("class")).unionByName(bad.select("source_topic_key", F.col("error_reason").alias("class")))
    return rows.groupBy("source_topic_key", "class").agg(F.count("*").alias("records"))


@query
def quarantine_landed(v):
    """Reasons per topic, from the quarantine table as it landed and was merged."""
    root = merged_root(v, "quarantine")
    return health.malformed_by_reason(read_landed(v.spark, f"{root}/{MALFORMED_TABLE}", MALFORMED))


@query
def schema_evolution_union(v):
    """Version 1 files lack the status column; a merged read fills it with NULL."""
    root = scratch(v.spark, "evolution")
    rows = ingest.good(parsed(v), ENVELOPE_SCHEMA).select("event_id", "schema_version", "dp_id", "status")
    rows.where("schema_version = 1").drop("status").write.mode("append").parquet(root)
    rows.where("schema_version IS DISTINCT FROM 1").write.mode("append").parquet(root)
    merged = v.spark.read.option("mergeSchema", "true").parquet(root)
    return merged.groupBy("schema_version").agg(F.count("*").alias("events"), F.count("status").alias("with_status"))


@query
def partition_pruned_read(v):
    """One week out of a table partitioned by date: only its folders are listed and read."""
    root = scratch(v.spark, "by-date")
    append_batch(ingest.good(parsed(v), ENVELOPE_SCHEMA), root, "load", 0)
    table = v.spark.read.parquet(root)
    week = F.col("ingest_date").between(F.lit(date(2024, 1, 8)), F.lit(date(2024, 1, 14)))
    day = F.col("ingest_date").cast("string").alias("ingest_date")
    return table.where(week).groupBy(day).agg(F.count("*").alias("events"))


@query
def clustered_layout_lookup(v):
    """Latest ping of every partner from files clustered by partner and time."""
    root = scratch(v.spark, "clustered")
    write_clustered(v.gps, root, ["dp_id", "event_s", "event_id"])
    last = latest(v.spark.read.parquet(root), ["dp_id"], ["event_s", "event_id"])
    lat, lon = map(F.lit, CENTRE)
    km = r6(haversine_km(lat, lon, F.col("lat"), F.col("lon")))
    return last.select("dp_id", "event_id", "event_s", km.alias("km"))


@query
def z_order_lookup(v):
    """Pings of one partner in the second half of January, and of all partners in one hour, from files in
    Z-order of partner and time; whether either look-up opened less than half of the files."""
    root = scratch(v.spark, "z-order")
    write_z_ordered(v.gps, root, ["dp_id", "event_s"], files=16, bloom=["event_id", "dp_id"])
    half, hour = DAY0 + 15 * 86400, DAY0 + 10 * 86400
    one, one_read, there = look_up(v.spark, root, {"dp_id": (7, 7), "event_s": (half, DAY0 + 31 * 86400)})
    some, some_read, _ = look_up(v.spark, root, {"event_s": (hour, hour + 3600)})
    told = lambda df, name, read: df.select(
        F.lit(name).alias("looked_up"), "event_id", "dp_id", "event_s", F.lit(there).cast("long").alias("files"), F.lit(2 * read < there).alias("skips_most"))
    return told(one, "partner", one_read).unionByName(told(some, "hour", some_read))


@query
def bucketed_order_join(v):
    """Order value of each dispatched order, from two tables bucketed by order: no shuffle joins them."""
    names = [f"bucketed_{kind}_{uuid.uuid4().hex[:12]}" for kind in ("orders", "dispatch")]
    placed = v.order_lifecycle.where("state = 'PLACED'").select("order_id", "zone_id", "order_value_inr")
    for name, rows in zip(names, (placed, v.dispatch.select("order_id", "decision", "is_batched"))):
        write_bucketed(rows, name, scratch(v.spark, name), ["order_id"], ["order_id"], buckets=8)
    joined = bucketed_join(v.spark, *names, ["order_id"])
    return joined.select("order_id", "zone_id", "decision", "is_batched", F.round("order_value_inr", 2).alias("order_value"))


@query
def event_json_emit(v):
    """Partner status events as keyed JSON messages."""
    return as_messages(v.dp_status, "dp_id", ["event_id", "dp_id", "zone_id", "event_s", "status", "order_id"])


# -- ingestion streams ---------------------------------------------------------


@query
def stream_scan_counts(v):
    """The events file as a stream, counted after it went through an append sink."""
    table = v.table("events")
    out, checkpoint = scratch(v.spark, "scan-out"), scratch(v.spark, "scan-checkpoint")
    stream = stream_files(v.spark, f"{v.sf_dir}/events*.parquet", table.schema).select("event_id", "event_type")
    drain(stream, out, checkpoint)
    return v.spark.read.schema(stream.schema).parquet(out).groupBy("event_type").agg(F.count("*").alias("events"))


def feed_of(v: Views, name: str, slices: int = 3) -> str:
    """The Kafka-shaped table as files in offset order, each slice spread like a topic's partitions."""
    feed = scratch(v.spark, f"{name}-feed")
    for part in slices_of(v.kafka, "offset", slices):
        part.repartition(v.spark.sparkContext.defaultParallelism).write.mode("append").parquet(feed)
    return feed


def ingest_feed(v: Views, feed: str, root: str, checkpoint: str, files_per_batch: int | None = None, **extra):
    records = stream_files(v.spark, feed, KAFKA_RECORD, files_per_batch)
    return start_ingest(
        records, root, checkpoint, ENVELOPE_SCHEMA, route(), "events", good_partitions=BY_TOPIC, **extra
    )


@query
def stream_multi_batch_ingest(v):
    """Rate-limited ingestion: the feed arrives in several batches, nothing is lost."""
    feed, root = feed_of(v, "limited"), scratch(v.spark, "limited")
    per_slice = v.spark.sparkContext.defaultParallelism  # the feed has this many files a slice
    finish(ingest_feed(v, feed, root, f"{root}/_checkpoint", files_per_batch=per_slice))
    batches = v.spark.read.parquet(f"{root}/events").agg(F.countDistinct(BATCH)).first()[0]
    return landed_counts(v.spark, root).withColumn("several_batches", F.lit(batches > 1))


@query
def stream_multi_sink_counts(v):
    """One stream, two sinks: typed and quarantined records per topic."""
    root = scratch(v.spark, "fan-out")
    finish(ingest_feed(v, feed_of(v, "fan-out", 1), root, f"{root}/_checkpoint"))
    rows = landed(v.spark, root)
    return rows.groupBy("source_topic_key").agg(
        F.count_if(F.col("class") == "good").alias("typed"), F.count_if(F.col("class") != "good").alias("quarantined")
    )


@query
def stream_resume_no_loss(v):
    """Stop after the first part, crash between write and commit, resume: each record once."""
    feed, root = scratch(v.spark, "resume-feed"), scratch(v.spark, "resume")
    checkpoint = f"{root}/_checkpoint"

    def crash(batch_id: int) -> None:
        raise RuntimeError("lost after the write, before the commit")

    for n, part in enumerate(slices_of(v.kafka, "offset", 3)):
        arrive(part, feed)
        if n == 1:
            broken = ingest_feed(v, feed, root, checkpoint, before_commit=crash)
            try:
                finish(broken)
            except Exception:  # the planned crash; the next start replays the batch
                pass
        finish(ingest_feed(v, feed, root, checkpoint))
    return landed_counts(v.spark, root)


@query
def ingest_observed_metrics(v):
    """Good and malformed counters that ride along with the write instead of extra jobs."""
    out, checkpoint = scratch(v.spark, "observed-out"), scratch(v.spark, "observed-checkpoint")
    records = stream_files(v.spark, feed_of(v, "observed"), KAFKA_RECORD)
    rows = ingest.parse(records, ENVELOPE_SCHEMA, route(), F.col("timestamp"))
    bad = F.col("error_reason").isNotNull()
    watched = rows.observe("ingest", F.count_if(~bad).alias("good"), F.count_if(bad).alias("malformed"))
    totals = drain(ingest.good(watched, ENVELOPE_SCHEMA), out, checkpoint).observed_totals.get("ingest", {})
    return v.spark.createDataFrame([(totals.get("good", 0), totals.get("malformed", 0))], "good long, malformed long")


@query
def stream_isolated_failure(v):
    """Three supervised streams over the events: one cannot start, one keeps failing, the other must finish."""
    root = scratch(v.spark, "supervised")
    table = v.table("events")
    stream = stream_files(v.spark, f"{v.sf_dir}/events*.parquet", table.schema).select("event_id")
    error = F.when(F.col("event_id") >= 0, F.raise_error(F.lit("poison")))
    poison = stream.select(error.cast("long").alias("event_id"))

    def starter(name: str, rows: DataFrame):
        def start():
            writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{root}/{name}-checkpoint")
            return writer.trigger(availableNow=True).start(f"{root}/{name}")

        return start

    def unstartable():
        raise RuntimeError("no such source")

    starters = {"unstartable": unstartable, "healthy": starter("healthy", stream), "broken": starter("broken", poison)}
    supervisor = Supervisor(starters, 0.2, max_restarts=1)
    supervisor.start()
    outcomes = supervisor.run()
    written = read_table(v.spark, f"{root}/healthy", stream.schema)
    counted = written.agg(F.count("*").alias("rows")).withColumn("stream", F.lit("healthy"))
    states = v.spark.createDataFrame(
        [(n, o.state, o.restarts) for n, o in outcomes.items()], "stream string, outcome string, restarts long"
    )
    return states.join(counted, "stream", "left").fillna(0, ["rows"])


# -- event-time streams --------------------------------------------------------


@query
def stream_tumbling_orders(v):
    plan = lambda s: windows.tumbling_orders(s, "1 hour", "1 hour")
    rows = v.order_lifecycle.where("state = 'PLACED'").select("order_id", "zone_id", "state", "event_s")
    return replay(rows, plan, "tumbling", "event_s", marker={"state": "PLACED", "zone_id": "end"})[0]


@query
def stream_sliding_failures(v):
    plan = lambda s: windows.sliding_failures(s, "2 hours", "1 hour", "1 hour")
    rows = v.payment.select("payment_id", "gateway", "status", "event_s")
    return replay(rows, plan, "sliding", "event_s", marker={"status": "SUCCESS", "gateway": "end"})[0]


@query
def stream_sessions(v):
    plan = lambda s: windows.sessions(s, "dp_id", "12 hours", "1 hour")
    rows = v.dp_status.select("dp_id", "event_s")
    return replay(rows, plan, "sessions", "event_s", marker={"dp_id": -1})[0]


@query
def stream_late_drop(v):
    """Events two hours late against a watermark of 30 minutes, in four arrivals: per event
    type, those whose window was still open when they arrived, and those dropped."""
    plan = lambda s: windows.counts(s, "event_type", "1 hour", "30 minutes")
    out, late = replay(v.arrivals, plan, "late", "off", slices=4, marker={"event_type": "end"})
    counted = out.groupBy("event_type").agg(F.sum("events").alias("counted"))
    sent = v.arrivals.groupBy("event_type").agg(F.count("*").alias("_sent"))
    counted_rows = F.coalesce("counted", F.lit(0))  # a type may be late altogether
    return sent.join(counted, "event_type", "left").select(
        "event_type", counted_rows.alias("counted"), (F.col("_sent") - counted_rows).alias("dropped"), F.lit(late > 0).alias("drops_reported")
    )


@query
def stream_dedup(v):
    plan = lambda s: windows.dedup(s, "3 hours")
    rows, _ = replay(v.arrivals, plan, "dedup", "off")
    return rows.groupBy("event_type").agg(
        F.count("*").alias("events"), F.countDistinct("event_id").alias("distinct_events")
    )


@query
def stream_accept_latency(v):
    plan = lambda s: windows.accept_latency(s, 600, "20 minutes")
    rows = v.order_lifecycle.where("state IN ('PLACED', 'ACCEPTED')").select("order_id", "zone_id", "state", "event_s")
    return replay(rows, plan, "accept", "event_s")[0]


@query
def stream_pickup_wait(v):
    plan = lambda s: windows.pickup_wait(s, 10 * 86400, "12 days")
    rows = v.dp_status.select("dp_id", "order_id", "status", "event_s")
    rows = rows.where("status IN ('WAITING_AT_RESTAURANT', 'PICKED_UP')")
    return replay(rows, plan, "pickup", "event_s")[0]


@query
def stream_backlog_windows(v):
    plan = lambda s: windows.backlog_windows(s, "6 hours", "1 hour")
    rows = v.restaurant_status.select("restaurant_id", "event_s", "current_backlog", "capacity_orders")
    out, _ = replay(rows, plan, "backlog", "event_s", marker={"restaurant_id": -1})
    return out.drop("window_end_s")


@query
def stream_zone_enrich(v):
    zones = v.zones.select("zone_id", F.col("name").alias("zone_name"))
    plan = lambda s: windows.enrich(s, zones, "zone_id")
    rows = v.order_lifecycle.where("state = 'PLACED'").select("order_id", "zone_id", "event_s")
    out, _ = replay(rows, plan, "enrich", "event_s")
    return out.groupBy("zone_id", "zone_name").agg(F.count("*").alias("orders"))


@query
def stream_orders_current(v):
    """Latest state per order from a streaming aggregate's change log."""
    rows = v.order_lifecycle.select("order_id", "state", "event_s")
    feed, root = scratch(v.spark, "current-feed"), scratch(v.spark, "current")
    for part in slices_of(rows, "event_s", 2):
        part.write.mode("append").parquet(feed)
        changes = stateful.latest_states(stream_files(v.spark, feed, rows.schema))
        finish(stateful.start_changes(changes, f"{root}/changes", f"{root}/_checkpoint"))
    changes = v.spark.read.parquet(f"{root}/changes")
    return latest(changes, ["order_id"], ["event_s", "rank"]).select("order_id", "state", "event_s")


# Finished orders whose last event comes in only when all others have: far behind the watermark.
STRAGGLER = f"order_id % 40 = 11 AND state = 'DELIVERED' AND event_s < {DAY0 + 20 * 86400}"


def ending_run(v, name: str) -> str:
    """Feed order events up to half an hour out of order, and the stragglers last, to ``ending_states``;
    returns the folder of its changes and its checkpoint."""
    rows = v.order_lifecycle.select("order_id", "state", "event_s", (F.col("event_s") + F.col("order_id") % 7 * 300).alias("arrived_s"))
    feed, root = scratch(v.spark, f"{name}-feed"), scratch(v.spark, name)
    for part in [*slices_of(rows.where(f"NOT ({STRAGGLER})"), "arrived_s", 2), rows.where(STRAGGLER)]:
        part.write.mode("append").parquet(feed)
        with stateful.rocksdb_state(v.spark):
            changes = stateful.ending_states(stream_files(v.spark, feed, rows.schema), "1 hour")
            finish(stateful.start_changes(changes, f"{root}/changes", f"{root}/_checkpoint"))
    return root


@query
def stream_orders_ending(v):
    """Latest state per order where finished orders leave the state and stragglers are dropped."""
    changes = v.spark.read.parquet(f"{ending_run(v, 'ending')}/changes")
    return latest(changes, ["order_id"], ["event_s", "rank"]).select("order_id", "state", "event_s")


@query
def stream_dp_intervals(v):
    """Closed status spans per partner from events up to an hour out of order, with illegal moves marked."""
    rows = v.dp_status.select("dp_id", "event_id", "status", "event_s").withColumn("arrived_s", F.col("event_s") + F.col("event_id") % 7 * 600)
    marker = {"dp_id": -1, "event_id": -1, "status": "OFFLINE"}
    spans, _ = replay(rows, lambda s: stateful.closed_spans(s, "2 hours"), "spans", "arrived_s", marker=marker)
    return spans.select("dp_id", "event_id", "status", "event_s", "until_s", "next_status", "is_legal")
