"""Connection options, tables, layout and replay-safe appends."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierflow import cli
from courierflow.plans import health
from courierflow.registry import ENVELOPE_SCHEMA
from courierflow.registry_io import land, landed_counts
from courierflow.schemas import MALFORMED, MALFORMED_TABLE, TOPICS, all_tables_sql, create_table_sql, table_schema
from courierflow.session import scratch
from courierflow.sinks.layout import bucketed_join, look_up, write_z_ordered
from courierflow.sinks.tables import append_batch, as_messages, compact, emit, write_bucketed, write_clustered
from courierflow.sinks.upkeep import compact_closed, read_landed
from courierflow.sources.files import read_table
from courierflow.sources.kafka import KafkaConnection, connection_options, read_options, write_options
from courierflow.streaming.ingest import BatchCounts, write_batch

SECURE = KafkaConnection("host:9092", "SASL_SSL", "PLAIN", 'us"er', "secret")


def test_plain_read_options():
    options = read_options(KafkaConnection(), TOPICS["gps_pings"])
    assert options == {
        "kafka.bootstrap.servers": "localhost:9092",
        "kafka.security.protocol": "PLAINTEXT",
        "subscribe": "gps-pings",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "100000",
        "failOnDataLoss": "false",
    }


def test_several_topics_share_a_stream():
    options = read_options(KafkaConnection(), TOPICS["payment"], TOPICS["dp_status"], min_partitions=24)
    assert options["subscribe"] == "payment-events,dp-status-events"
    assert options["maxOffsetsPerTrigger"] == "40000" and options["minPartitions"] == "24"


def test_sasl_options_quote_credentials():
    options = connection_options(SECURE)
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"].endswith(' required username="us\\"er" password="secret";')


def test_missing_credentials_are_all_named():
    with pytest.raises(ValueError) as error:
        connection_options(KafkaConnection(security_protocol="SASL_SSL", username="u"))
    assert "sasl_mechanism" in str(error.value) and "password" in str(error.value) and "username" not in str(error.value)


def test_write_options():
    options = write_options(SECURE, TOPICS["payment"])
    assert options["topic"] == "payment-events" and options["kafka.acks"] == "all"
    assert options["kafka.compression.type"] == "gzip" and options["kafka.linger.ms"] == "20"


def test_ddl_matches_what_ingestion_writes(spark, views):
    root = scratch(spark, "ddl")
    topic = TOPICS["dp_status"]
    write_batch(
        views.kafka, 0, "run", topic.schema, topic.key, f"{root}/{topic.table}", f"{root}/{MALFORMED_TABLE}"
    )
    for key in (topic.key, MALFORMED_TABLE):
        name = MALFORMED_TABLE if key == MALFORMED_TABLE else topic.table
        spark.sql(create_table_sql(key, root))
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        table = spark.table(name)
        assert set(table_schema(key).names) <= set(table.columns)
        assert table.count() == (100 if key == MALFORMED_TABLE else 900)
    assert len(all_tables_sql(root, "db")) == 7 and "`db`.`gps_pings`" in "".join(all_tables_sql(root, "db"))


def test_append_is_idempotent_per_batch_and_run(spark):
    path = scratch(spark, "append")
    rows = spark.range(10).withColumn("ingest_date", F.lit("2024-01-01").cast("date"))
    append_batch(rows, path, "a", 0)
    append_batch(rows, path, "a", 0)
    assert spark.read.parquet(path).count() == 10
    append_batch(rows, path, "a", 1)
    append_batch(rows, path, "b", 0)  # a new checkpoint starts at batch 0 again
    assert spark.read.parquet(path).count() == 30
    append_batch(rows.limit(0), path, "a", 2)
    assert spark.read.parquet(path).count() == 30


def test_batch_date_survives_a_replay(spark, views):
    """All rows of a batch carry the date of its newest broker time."""
    root = scratch(spark, "dates")
    counts = BatchCounts()
    for _ in range(2):
        write_batch(views.kafka, 4, "run", ENVELOPE_SCHEMA, "x", f"{root}/good", f"{root}/bad", counts)
    good, bad = spark.read.parquet(f"{root}/good"), spark.read.parquet(f"{root}/bad")
    newest = views.kafka.agg(F.to_date(F.max("timestamp"))).first()[0]
    assert {r[0] for r in good.select("ingest_date").distinct().collect()} == {newest}
    assert {r[0] for r in bad.select("ingest_date").distinct().collect()} == {newest}
    assert (good.count(), bad.count()) == (900, 100) and counts.batches == [(4, 900, 100)] and counts.totals == (900, 100)
    assert good.select("ingestion_timestamp").distinct().count() == 1


def test_table_without_data_reads_empty(spark):
    empty = read_table(spark, scratch(spark, "nothing"), table_schema("payment"))
    assert empty.count() == 0 and empty.columns == table_schema("payment").names
    report = health.health_report({"payment": empty})
    assert report.first().rows == 0 and health.is_empty_everywhere(report)


def test_health_report_and_freshness(spark, views):
    root = scratch(spark, "report")
    land(views.kafka, root)
    table = read_table(spark, f"{root}/events", spark.read.parquet(f"{root}/events").schema)
    row = health.health_report({"all": table}, F.current_timestamp()).first()
    assert row.rows == 900 and 0 <= row.freshness_s < 3600
    assert not health.is_empty_everywhere(health.health_report({"all": table}))
    assert {(r["class"], r.records) for r in landed_counts(spark, root).groupBy("class").agg(F.sum("records").alias("records")).collect()} == {
        ("good", 900), ("unparsable_json", 50), ("missing_required_fields", 50)}
    bad = read_table(spark, f"{root}/{MALFORMED_TABLE}", MALFORMED)
    counts = [r.rows for r in health.malformed_by_reason(bad).collect()]
    assert counts == sorted(counts, reverse=True) and sum(counts) == 100


def test_partition_filter_is_pruned(spark, views):
    path = scratch(spark, "pruned")
    rows = views.gps.withColumn("ingest_date", F.to_date(F.timestamp_seconds("event_s")))
    append_batch(rows, path, "r", 0)
    day = spark.read.parquet(path).where("ingest_date = DATE'2024-01-08'").select("event_id")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "ReadSchema: struct<event_id:bigint>" in plan


def test_clustered_files_have_narrow_key_ranges(spark, views):
    path = scratch(spark, "narrow")
    write_clustered(views.gps, path, ["dp_id", "event_s"], files=4)
    table = spark.read.parquet(path)
    ranges = table.groupBy(F.input_file_name()).agg(F.min("dp_id").alias("lo"), F.max("dp_id").alias("hi")).orderBy("lo").collect()
    assert len(ranges) > 1 and all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))
    lookup = table.where("dp_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(dp_id), EqualTo(dp_id,3)]" in lookup


def test_compaction_keeps_all_rows(spark, views):
    source, target = scratch(spark, "small"), scratch(spark, "large")
    rows = views.gps.withColumn("ingest_date", F.to_date(F.timestamp_seconds("event_s")))
    for n in range(2):
        append_batch(rows, source, "r", n)
    table = spark.read.parquet(source)
    compact(table, target)
    assert spark.read.parquet(target).count() == table.count() == 2 * rows.count()
    assert "_batch_id" not in spark.read.parquet(target).columns


def test_emit_modes(spark, views, capfd):
    path = scratch(spark, "lines")
    messages = as_messages(views.dp_status, "dp_id")
    emit(messages, "file", path)
    lines = spark.read.json(path)
    assert lines.count() == 1000 and "order_id" in lines.columns
    emit(messages, "console", options={"numRows": "100"})
    with pytest.raises(ValueError, match="numRows"):
        emit(messages, "console")
    with pytest.raises(ValueError, match="unknown output mode"):
        emit(messages, "pigeon")


def test_cli_ddl_and_health(spark, views, capsys):
    root = scratch(spark, "cli")
    assert cli.main(["ddl", "--root", root, "--dry-run"]) == 0
    assert capsys.readouterr().out.count("CREATE TABLE") == 7
    assert cli.main(["health", "--root", root]) == 1
    topic = TOPICS["payment"]
    write_batch(views.kafka, 0, "r", topic.schema, topic.key, f"{root}/{topic.table}", f"{root}/{MALFORMED_TABLE}")
    assert cli.main(["health", "--root", root]) == 0


def test_bucketed_tables_join_without_a_shuffle(spark, views):
    from courierflow.sinks.tables import write_bucketed

    for name, df in (("bucketed_orders", views.order_lifecycle), ("bucketed_payments", views.payment)):
        write_bucketed(df, name, scratch(spark, name), ["order_id"], ["order_id", "event_s"], 4)
    a = spark.table("bucketed_orders").where("state = 'PLACED'").select("order_id", "zone_id")
    joined = a.join(spark.table("bucketed_payments").hint("merge").select("order_id", "status"), "order_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == views.payment.count()


def test_transactional_appends(spark, views):
    from courierflow.sinks.tables import append_transaction, transaction_options

    assert transaction_options("run-1", 7) == {"txnAppId": "run-1", "txnVersion": "7", "mergeSchema": "true"}
    root = scratch(spark, "transaction")
    # any format takes the call; one without transactions just appends
    append_transaction(views.payment.withColumn("ingest_date", F.lit("2024-01-01")), root, "run-1", 0, "json")
    assert spark.read.json(root).count() == views.payment.count()


def test_cli_settings_replace_those_of_the_topic():
    from argparse import Namespace

    given = Namespace(trigger_seconds=60, max_offsets=None, starting_offsets="latest")
    topic = cli.settings(TOPICS["payment"], given)
    assert (topic.trigger_seconds, topic.max_offsets, topic.starting_offsets) == (60, TOPICS["payment"].max_offsets, "latest")


def test_z_order_skips_files_on_either_column(spark, views):
    """Ranges of partner, of time or of both open few files; the rows are those of a plain filter."""
    path = scratch(spark, "t-z-order")
    write_z_ordered(views.gps, path, ["dp_id", "event_s"], files=16, bloom=["event_id"])
    low, high = views.gps.agg(F.min("event_s"), F.max("event_s")).first()
    middle = (low + high) // 2
    some, few = (views.gps.select("dp_id").distinct().orderBy("dp_id").limit(n).agg(F.max("dp_id")).first()[0] for n in (1, 3))
    opened = []
    for ranges in ({"dp_id": (some, some)}, {"event_s": (middle, middle + 3600)}, {"dp_id": (some, few), "event_s": (middle, high)}, {"dp_id": (-9, -9)}):
        rows, read, there = look_up(spark, path, ranges)
        want = views.gps
        for c, (a, b) in ranges.items():
            want = want.where(F.col(c).between(a, b))
        assert sorted(rows.collect()) == sorted(want.collect()) and there == 16
        opened.append(read)
    assert max(opened[:3]) <= 8 and opened[3] == 0, opened


def test_bucketed_tables_join_without_a_shuffle(spark, views):
    names = [f"t_bucketed_{n}_{uuid.uuid4().hex[:8]}" for n in "ab"]
    for name, rows in zip(names, (views.dispatch.select("order_id", "decision"), views.payment.select("order_id", "payment_id"))):
        write_bucketed(rows, name, scratch(spark, name), ["order_id"], ["order_id"], buckets=4)
    joined = bucketed_join(spark, *names, ["order_id"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert joined.count() == views.dispatch.join(views.payment, "order_id").count()


def test_merging_closed_dates(spark):
    """Rows stay the same through merges, crashes before and after the mark, and replays; open dates stay as they are."""
    path = scratch(spark, "t-merge")
    frame = lambda rows, more="": spark.createDataFrame(rows, f"ingest_date date, x long{more}")
    first, last = date(2024, 1, 1), date(2024, 1, 9)
    schema = T.StructType.fromDDL("ingest_date date, x long, y string")
    read = lambda: sorted(((str(r.ingest_date), r.x, r.y) for r in read_landed(spark, path, schema).collect()), key=str)
    folders = lambda: {(str(r.ingest_date), r["_run"]) for r in spark.read.parquet(path).select("ingest_date", "_run").distinct().collect()}
    assert compact_closed(spark, path, last) == 0 and read() == []
    append_batch(frame([(first, 1), (last, 2)]), path, "a", 0)
    append_batch(frame([(first, 3)]), path, "a", 1)
    append_batch(frame([(first, 4, "new")], ", y string"), path, "b", 0)
    want = [("2024-01-01", 1, None), ("2024-01-01", 3, None), ("2024-01-01", 4, "new"), ("2024-01-09", 2, None)]
    # a crash after the merged rows were written, before they were marked
    spark.read.option("mergeSchema", "true").parquet(path).where(F.col("ingest_date") == first).withColumns(
        {"_run": F.lit("merged"), "_batch_id": F.lit(5)}).write.mode("append").partitionBy("ingest_date", "_run", "_batch_id").parquet(path)
    assert read() == want
    assert compact_closed(spark, path, last, generation=7) == 3 and read() == want
    assert folders() >= {("2024-01-01", "merged"), ("2024-01-09", "a")} and ("2024-01-01", "a") not in folders()
    append_batch(frame([(first, 3)]), path, "a", 1)  # replayed behind the merge
    assert read() == want
    assert compact_closed(spark, path, last) == 0 and read() == want and ("2024-01-01", "a") not in folders()
    append_batch(frame([(first, 8)]), path, "c", 0)  # late rows of a closed date
    assert compact_closed(spark, path, last, generation=9, remove=False) == 2
    assert sorted(map(str, read())) == sorted(map(str, [*want, ("2024-01-01", 8, None)]))


def test_compact_command(spark):
    root = scratch(spark, "t-compact")
    table = f"{root}/{TOPICS['dp_status'].table}"
    for n in range(2):
        append_batch(spark.createDataFrame([(date(2024, 1, 1), n)], "ingest_date date, x long"), table, "run", n)
    assert cli.main(["compact", "--root", root, "--before", "2024-02-01"]) == 0
    assert [r["_run"] for r in spark.read.parquet(table).select("_run").distinct().collect()] == ["merged"]
    assert read_landed(spark, table, T.StructType.fromDDL("ingest_date date, x long")).count() == 2
