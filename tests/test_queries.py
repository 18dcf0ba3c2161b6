"""Every registered query against its SQL on DuckDB, and the silver views end to end."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import oracles
from checks.compare import compare, oracle_connection
from conftest import SF
from courierflow import registry
from courierflow.operators import ingest
from courierflow.plans import dispatch, kitchen, orders, payments, supply, trips
from courierflow.plans.silver import COLUMNS, bad_times, silver
from courierflow.schemas import KAFKA_RECORD, PAYLOADS, SCHEMAS, TOPICS

QUERIES, ORACLES = registry.QUERIES, oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    _, rows, ok, why = compare(spark, duck, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, why
    assert rows > 0 or name in ("batch_candidates", "batch_candidates_text_ids", "gps_gaps")


def test_entry(spark):
    assert entry.entry(spark).count() == 6
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def event(topic, n, second, **fields):
    """One event of a topic; fields left out are NULL on the wire."""
    names = list(PAYLOADS[topic])
    body = {"event_time": f"2024-05-01T10:{second // 60:02d}:{second % 60:02d}.500Z", "schema_version": 1, "event_id": f"{topic}-{n}"}
    return json.dumps(body | {k: fields.get(k) for k in names})


def landed_table(spark, topic, texts):
    rows = [(b"k", t.encode(), TOPICS[topic].topic, 0, i, None, 0) for i, t in enumerate(texts)]
    records = spark.createDataFrame(rows, KAFKA_RECORD).withColumn("timestamp", F.timestamp_seconds(F.col("offset")))
    return ingest.good(ingest.parse(records, SCHEMAS[topic], topic), SCHEMAS[topic])


def test_silver_feeds_the_metrics(spark):
    steps = ["PLACED", "ACCEPTED", "PREPARING", "READY", "ASSIGNED", "PICKED_UP", "DELIVERED"]
    common = dict(order_id="o1", customer_id="c", restaurant_id="r1", zone_id="Z01", promised_eta_ts="2024-05-01T10:09:00.000Z")
    life = [event("order_lifecycle", i, 60 * i, state=s, **common) for i, s in enumerate(steps)]
    table = landed_table(spark, "order_lifecycle", [*life, life[0], event("order_lifecycle", 99, 5, state="PLACED").replace("2024-05", "soon")])
    assert table.count() == 9 and bad_times(table).count() == 1
    rows = silver("order_lifecycle", table)
    assert rows.count() == 7  # the repeat and the row without a time are gone
    current = orders.current_orders(rows).collect()
    assert [(r.order_id, r.state) for r in current] == [("o1", "DELIVERED")]
    eta = orders.eta_variance(rows).first()
    assert (eta.delivered, eta.mean_error_s, eta.on_time_share) == (1, -180.0, 1.0)
    assert orders.illegal_order_moves(rows).count() == 0

    moves = ["IDLE", "EN_ROUTE_TO_RESTAURANT", "WAITING_AT_RESTAURANT", "PICKED_UP", "EN_ROUTE_TO_CUSTOMER", "DELIVERED", "IDLE"]
    # the two moves at pick-up share a second: the offset orders them
    at = [0, 60, 120, 240, 240, 300, 310]
    status = silver("dp_status", landed_table(spark, "dp_status", [
        event("dp_status", i, t, dp_id="d1", zone_id="Z01", status=s, order_id="o1") for i, (s, t) in enumerate(zip(moves, at))]))
    assert supply.illegal_partner_moves(status).count() == 0
    use = supply.utilization(status).first()
    assert (use.busy_s, use.online_s) == (250, 310)
    assert trips.wait_time(status, rows).first().avg_wait_s == 120

    heart = silver("restaurant_status", landed_table(spark, "restaurant_status", [
        event("restaurant_status", 0, 0, restaurant_id="r1", zone_id="Z01", status="BUSY", current_backlog=4, capacity_orders=4)]))
    assert kitchen.backlog_latest(heart).first().load == 1.0
    pay = silver("payment", landed_table(spark, "payment", [
        event("payment", i, 10 * i, payment_id=p, order_id="o1", attempt_number=a, retry_of_payment_id=r, gateway="PayU", status=s)
        for i, (p, a, r, s) in enumerate([("p1", 1, None, "INITIATED"), ("p1", 1, None, "FAILED"), ("p2", 2, "p1", "INITIATED"), ("p2", 2, "p1", "SUCCESS")])]))
    chains = {r.payment_id: (r.root_payment_id, r.depth, r.final_status) for r in payments.retry_chains(pay).collect()}
    assert chains == {"p1": ("p1", 1, "SUCCESS"), "p2": ("p1", 2, "SUCCESS")}


def test_silver_columns_exist():
    for topic, names in COLUMNS.items():
        assert set(names) <= set(SCHEMAS[topic].names)


def test_retry_chains_follow_the_pointers(spark):
    """Two chains of one order side by side, a retry of an unknown payment, one that never began, a loop."""
    rows = [
        ("a1", 1, None, "FAILED"), ("b1", 1, None, "SUCCESS"), ("a2", 2, "a1", "FAILED"), ("a3", 3, "a2", "FAILED"), ("a4", 4, "a3", "FAILED"),
        ("c2", 2, "gone", "FAILED"), ("c3", 3, "c2", "SUCCESS"), ("d1", 1, "d2", "FAILED"), ("d2", 2, "d1", "FAILED"), ("e1", 1, "e1", "OPEN")]
    events = [(p, "o1", "PayU", n, r, s, 10 * i) for i, (p, n, r, s) in enumerate(rows)]
    frame = spark.createDataFrame(events, "payment_id string, order_id string, gateway string, attempt_number long, retry_of_payment_id string, status string, event_s long")
    got = {r.payment_id: (r.root_payment_id, r.depth, r.chain_length, r.final_status) for r in payments.retry_chains(frame).collect()}
    assert got == {
        "a1": ("a1", 1, 4, "FAILED"), "a2": ("a1", 2, 4, "FAILED"), "a3": ("a1", 3, 4, "FAILED"), "a4": ("a1", 4, 4, "FAILED"), "b1": ("b1", 1, 1, "SUCCESS"),
        "c2": ("c2", 1, 2, "SUCCESS"), "c3": ("c2", 2, 2, "SUCCESS"), "d1": ("d1", 1, 2, "FAILED"), "d2": ("d1", 2, 2, "FAILED"), "e1": ("e1", 1, 1, "OPEN")}


def test_first_payments_of_chains_are_no_key(spark, monkeypatch):
    """Payments that retry nothing meet the retries at the end only, by their own id: no join is dealt by their NULL."""
    written, rows = [], [(f"p{i}", i % 40, "PayU", 1 + i // 40, f"p{i - 40}" if i >= 40 else None, "FAILED", i) for i in range(130)]
    frame = spark.createDataFrame(rows, "payment_id string, order_id long, gateway string, attempt_number long, retry_of_payment_id string, status string, event_s long")
    keep = payments.materialize
    monkeypatch.setattr(payments, "materialize", lambda df, name: written.append((name, keep(df, name))) or written[-1][1])
    got = {r.payment_id: (r.root_payment_id, r.depth, r.chain_length) for r in payments.retry_chains(frame).collect()}
    assert got == {f"p{i}": (f"p{i % 40}", 1 + i // 40, 4 if i % 40 < 10 else 3) for i in range(130)}
    assert [(name, df.count()) for name, df in written][:2] == [("payments", 130), ("chains", 90)]


def test_text_ids_are_numbered_in_their_order(spark):
    ids = [f"o{i * 7919 % 1000:04d}" for i in range(300)] + ["o0000", None, "", "é"]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    got = {(r.id, r.n) for r in dispatch.numbered(rows, "id", "n").collect()}
    numbers = dict(got)
    assert len(got) == len(numbers) == len(set(numbers.values())) == len(set(ids)) and numbers.pop(None) == -1
    assert sorted(numbers, key=numbers.get) == sorted(numbers) and min(numbers.values()) >= 0
