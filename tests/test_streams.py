"""Streams: same rows as the batch plans, replay and resume, isolation, late data."""

import time

import pytest
from pyspark.sql import functions as F

from courierflow import registry_io
from courierflow.operators.quality import dedup
from courierflow.plans import supply
from courierflow.registry_io import STRAGGLER, ending_run, feed_of, ingest_feed, landed_counts
from courierflow.schemas import KAFKA_RECORD
from courierflow.session import scratch
from courierflow.sources.files import stream_files
from courierflow.streaming import replay as replay_module
from courierflow.streaming import stateful, windows
from courierflow.streaming.ingest import BatchCounts, start_ingest
from courierflow.streaming.replay import drain, finish, replay, slices_of
from courierflow.streaming.supervisor import Supervisor


def test_ingest_counts_and_batches(spark, views):
    root, counts = scratch(spark, "t-ingest"), BatchCounts()
    feed = feed_of(views, "t-ingest", 2)
    finish(ingest_feed(views, feed, root, f"{root}/_checkpoint", files_per_batch=1, counts=counts))
    assert len(counts.batches) > 1
    assert sum(b[1] for b in counts.batches) == 900 and sum(b[2] for b in counts.batches) == 100
    # a second start on the same checkpoint finds nothing new
    finish(ingest_feed(views, feed, root, f"{root}/_checkpoint", counts=counts))
    assert landed_counts(spark, root).agg(F.sum("records")).first()[0] == 1000


def test_new_checkpoint_does_not_replace_old_batches(spark, views):
    root, feed = scratch(spark, "t-rerun"), scratch(spark, "t-rerun-feed")
    first, second = slices_of(views.kafka, "offset", 2)
    first.write.mode("append").parquet(feed)
    finish(ingest_feed(views, feed, root, f"{root}/_checkpoint-1"))
    other = scratch(spark, "t-rerun-feed")
    second.write.mode("append").parquet(other)
    finish(ingest_feed(views, other, root, f"{root}/_checkpoint-2"))
    assert landed_counts(spark, root).agg(F.sum("records")).first()[0] == 1000


def test_one_topic_of_a_real_schema(spark, views):
    """A per-topic query with the declared schema; ids of the payload survive as typed columns."""
    root = scratch(spark, "t-topic")
    from courierflow.schemas import TOPICS

    topic = TOPICS["dp_status"]
    stream = stream_files(spark, feed_of(views, "t-topic", 1), KAFKA_RECORD)
    finish(start_ingest(stream, root, f"{root}/_checkpoint", topic.schema, topic.key, topic.table, name="one_topic"))
    table = spark.read.parquet(f"{root}/{topic.table}")
    assert table.count() == 900 and table.where("status IS NULL OR dp_id IS NULL").count() == 0
    assert table.schema["lat"].dataType.simpleString() == "double"


def test_arrivals_of_one_task_are_many_files(spark, views, monkeypatch):
    """A range of an ordered table comes out of few tasks; the batch that reads it needs more."""
    monkeypatch.setattr(replay_module, "ARRIVAL_ROWS", 100)
    feed = scratch(spark, "cut-feed")
    for part in slices_of(views.kafka.coalesce(1), "offset", 2):
        replay_module.arrive(part, feed)
    rows = spark.read.parquet(feed).groupBy(F.input_file_name()).count().agg(F.max("count"), F.count("*"), F.sum("count")).first()
    assert rows[0] == 100 and rows[1] >= 10 and rows[2] == views.kafka.count()
    got = {(r.source_topic_key, r["class"]): r.records for r in registry_io.stream_resume_no_loss(views).collect()}
    assert got == {(r.source_topic_key, r["class"]): r.records for r in registry_io.stream_multi_batch_ingest(views).collect()}
    assert sum(got.values()) == views.kafka.count()


def test_late_rows_are_dropped_and_counted(spark, views):
    plan = lambda s: windows.counts(s, "event_type", "1 hour", "30 minutes")
    out, dropped = replay(views.arrivals, plan, "t-late", "off", slices=4, marker={"event_type": "end"})
    counted = out.agg(F.sum("events")).first()[0]
    assert 0 < counted <= 1010 and (counted < 1010) == (dropped > 0)


def test_stream_dedup_equals_batch(spark, views):
    out, _ = replay(views.arrivals, lambda s: windows.dedup(s, "3 hours"), "t-dedup", "off")
    assert out.select("event_id").distinct().count() == out.count() == dedup(views.arrivals).count()


def test_accept_latency_with_a_hot_order(spark):
    """Many orders share one id; slots keep the pairs right."""
    rows = [("hot", "Z", s, 1000 + 700 * i + d) for i in range(60) for s, d in (("PLACED", 0), ("ACCEPTED", 50 + i))]
    df = spark.createDataFrame(rows, "order_id string, zone_id string, state string, event_s long")
    out, _ = replay(df, lambda s: windows.accept_latency(s, 600, "1 hour"), "t-hot", "event_s")
    got = sorted((r.placed_s, r.latency_s) for r in out.collect())
    want = sorted(
        (p[3], a[3] - p[3]) for p in rows for a in rows if p[2] == "PLACED" and a[2] == "ACCEPTED" and 0 <= a[3] - p[3] <= 600
    )
    assert got == want


def test_spans_equal_the_batch_plan(spark, views):
    rows = views.dp_status.select("dp_id", "event_id", "status", "event_s")
    marker = {"dp_id": -1, "event_id": -1, "status": "OFFLINE"}
    got = replay(rows, lambda s: stateful.closed_spans(s, "1 hour"), "t-spans", "event_s", marker=marker)[0]
    want = supply.status_spans(views.dp_status).where("until_s IS NOT NULL")
    columns = ["dp_id", "event_id", "status", "event_s", "until_s", "next_status"]
    assert sorted(got.select(*columns).collect()) == sorted(want.select(*columns).collect())
    assert got.where("NOT is_legal").count() == supply.illegal_partner_moves(views.dp_status).count()


def test_supervisor_isolates_and_restarts(spark, views):
    root = scratch(spark, "t-supervisor")
    feed = feed_of(views, "t-supervisor", 1)
    tries = []

    def healthy():
        return ingest_feed(views, feed, f"{root}/a", f"{root}/a-checkpoint")

    def flaky():
        def fail_once(batch_id):
            tries.append(batch_id)
            if len(tries) == 1:
                raise RuntimeError("first try")

        return ingest_feed(views, feed, f"{root}/b", f"{root}/b-checkpoint", before_commit=fail_once)

    def broken():
        def always(batch_id):
            raise RuntimeError("never works")

        return ingest_feed(views, feed, f"{root}/c", f"{root}/c-checkpoint", before_commit=always)

    starts = []

    def unstartable():
        starts.append(1)
        raise RuntimeError("cannot even start")

    starters = {"unstartable": unstartable, "healthy": healthy, "flaky": flaky, "broken": broken}
    supervisor = Supervisor(starters, poll_seconds=0.2, max_restarts=1)
    supervisor.start()
    outcomes = supervisor.run(timeout=300)
    assert {n: (o.state, o.restarts) for n, o in outcomes.items()} == {
        "unstartable": ("failed", 1), "healthy": ("finished", 0), "flaky": ("finished", 1), "broken": ("failed", 1)}
    assert len(starts) == 2
    for name in "ab":  # the restarted query wrote its batch twice, its rows are there once
        assert landed_counts(spark, f"{root}/{name}").agg(F.sum("records")).first()[0] == 1000


def test_update_mode_change_log(spark, views):
    rows = views.order_lifecycle.select("order_id", "state", "event_s")
    feed, root = scratch(spark, "t-current-feed"), scratch(spark, "t-current")
    rows.write.parquet(feed)
    changes = stateful.latest_states(stream_files(spark, feed, rows.schema))
    finish(stateful.start_changes(changes, f"{root}/changes", f"{root}/_checkpoint"))
    finals = spark.read.parquet(f"{root}/changes").groupBy("state").count().collect()
    assert {r.state for r in finals} == {"DELIVERED", "REJECTED", "CANCELLED"} and sum(r["count"] for r in finals) == 1500


def test_monitor_follows_progress(spark, views):
    from courierflow.streaming.monitor import QueryMonitor

    monitor = QueryMonitor()
    spark.streams.addListener(monitor)
    try:
        root = scratch(spark, "t-monitor")
        finish(ingest_feed(views, feed_of(views, "t-monitor", 1), root, f"{root}/_checkpoint", name="watched"))
        for _ in range(100):  # reports arrive on their own thread
            if "watched" in monitor.gauges and monitor.gauges["watched"].rows == 1000:
                break
            time.sleep(0.1)
        gauge = monitor.gauges["watched"]
        assert gauge.rows == 1000 and gauge.batches >= 1 and gauge.error is None and 0 <= gauge.freshness_s() < 60
    finally:
        spark.streams.removeListener(monitor)


def test_topic_query_with_a_processing_time_trigger(spark, views):
    from dataclasses import replace

    from courierflow.schemas import TOPICS
    from courierflow.streaming.ingest import start_topic

    root = scratch(spark, "t-trigger")
    stream = stream_files(spark, feed_of(views, "t-trigger", 1), KAFKA_RECORD)
    query = start_topic(stream, root, f"{root}/_checkpoints", replace(TOPICS["payment"], trigger_seconds=1))
    query.processAllAvailable()
    query.stop()
    assert query.name == "ingest_payment" and spark.read.parquet(f"{root}/payment_events").count() == 900


def test_messages_as_a_stream(spark, views):
    from courierflow.sinks.tables import as_messages, emit_stream

    feed, out = scratch(spark, "t-emit-feed"), scratch(spark, "t-emit")
    views.dp_status.write.parquet(feed)
    messages = as_messages(stream_files(spark, feed, views.dp_status.schema), "dp_id")
    writer = emit_stream(messages, "file", scratch(spark, "t-emit-checkpoint"), out)
    finish(writer.trigger(availableNow=True).start())
    assert spark.read.json(out).count() == 1000
    with pytest.raises(ValueError, match="unknown output mode"):
        emit_stream(messages, "pigeon", "x")


def test_spans_take_late_events_and_drop_later_ones(spark):
    columns = "dp_id long, event_id long, status string, event_s long"
    feed, out = scratch(spark, "t-late-feed"), scratch(spark, "t-late-spans")
    arrivals = [
        [(1, 1, "IDLE", 100), (1, 2, "OFFLINE", 200), (2, 3, "IDLE", 50), (3, 9, "IDLE", 1000)],
        [(1, 4, "IDLE", 150), (1, 5, "IDLE", 300), (2, 6, "OFFLINE", 60), (3, 10, "OFFLINE", 5000)],
        [(1, 7, "OFFLINE", 120), (3, 11, "IDLE", 90_000)],
    ]
    for rows in arrivals:
        df = spark.createDataFrame(rows, columns)
        df.write.mode("append").parquet(feed)
        drain(stateful.closed_spans(stream_files(spark, feed, df.schema), "1000 seconds"), out, f"{out}-checkpoint")
    spans = {(r.event_id, r.until_s, r.is_legal) for r in spark.read.parquet(out).collect()}
    # 7 is behind the watermark of 4000 s
    assert spans == {(1, 150, False), (4, 200, True), (2, 300, True), (3, 60, True), (9, 5000, True)}


def test_finished_orders_leave_the_state(spark, views):
    """What is left in the state are orders that the watermark hasn't passed, or that never ended."""
    root = ending_run(views, "t-ending")
    held = spark.read.format("statestore").option("stateVarName", "newest").load(f"{root}/_checkpoint")
    events = views.order_lifecycle.where(f"NOT ({STRAGGLER})")
    newest = events.agg(F.max("event_s")).first()[0]
    ends = events.groupBy("order_id").agg(F.max("event_s").alias("end_s"), F.max(F.col("state").isin("REJECTED", "DELIVERED", "CANCELLED")).alias("over"))
    alive = ends.where(F.when(F.col("over"), F.col("end_s")).otherwise(F.col("end_s") + 7 * 86400) > newest - 3600).count()
    assert held.count() == alive < 0.3 * ends.count()


def test_order_state_is_called_by_bucket(spark):
    """Few buckets hold all orders, one without an id among them; ends and drops are as by order."""
    columns = "order_id long, state string, event_s long"
    feed, root = scratch(spark, "t-bucket-feed"), scratch(spark, "t-bucket")
    arrivals = [  # ids that floating point would round
        [(2**60 + i, "PLACED", 1000 + i) for i in range(300)] + [(None, "PLACED", 1000)],
        [(2**60 + i, "DELIVERED", 9000) for i in range(0, 300, 2)] + [(None, "ACCEPTED", 9000), (2**60 + 1, "ACCEPTED", 900)],
        [(500, "PLACED", 20_000)],
        [(2**60 + 3, "DELIVERED", 9500), (2**60 + 5, "READY", 19_000)],  # the first is behind the watermark of 16,400
    ]
    for rows in arrivals:
        df = spark.createDataFrame(rows, columns)
        df.write.mode("append").parquet(feed)
        with stateful.rocksdb_state(spark):
            changes = stateful.ending_states(stream_files(spark, feed, df.schema), "1 hour", buckets=4)
            finish(stateful.start_changes(changes, f"{root}/changes", f"{root}/_checkpoint"))
    log = spark.read.parquet(f"{root}/changes").collect()
    want = [(r[0], r[1], r[2]) for rows in arrivals for r in rows if r not in {(2**60 + 1, "ACCEPTED", 900), (2**60 + 3, "DELIVERED", 9500)}]
    assert sorted(((r.order_id or -1, r.state, r.event_s) for r in log)) == sorted((o or -1, s, t) for o, s, t in want)
    held = spark.read.format("statestore").option("stateVarName", "newest").load(f"{root}/_checkpoint")
    assert held.count() == 150 + 1 + 1 and held.select("key").distinct().count() <= 5


def test_spans_are_closed_by_bucket(spark):
    """As many calls as buckets, not as partners; events without a partner are one sequence."""
    columns = "dp_id long, event_id long, status string, event_s long"
    rows = [(None if i % 50 == 0 else 2**60 + i % 50, i, "IDLE" if i % 3 else "OFFLINE", 5000 + 7 * i % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, columns)
    marker = {"dp_id": -1, "event_id": -1, "status": "OFFLINE"}
    got, _ = replay(df, lambda s: stateful.closed_spans(s, "2000 seconds", buckets=4), "t-span-bucket", "event_id", marker=marker)
    want = set()
    for dp in {r[0] for r in rows}:
        mine = sorted((t, e, s) for d, e, s, t in rows if d == dp)
        want |= {(dp, a[1], a[2], a[0], b[0], b[2]) for a, b in zip(mine, mine[1:])}
    assert {(r.dp_id, r.event_id, r.status, r.event_s, r.until_s, r.next_status) for r in got.collect()} == want and got.count() == len(want)
