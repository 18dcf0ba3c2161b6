"""Parsing, classification and the two-way split."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from courierflow.operators import ingest
from courierflow.schemas import ENVELOPE, KAFKA_RECORD, MALFORMED, METADATA, SCHEMAS, TOPICS, struct_of, topic_for

ORDER = SCHEMAS["order_lifecycle"]
SAMPLES = {"string": "text", "bigint": 7, "double": 2.5, "boolean": True, "array<string>": ["a", "b"]}
BROKEN = ["", "null", "{", "[1, 2]", "no JSON at all", '{"event_id": }', "\u00e9\u4e2d" * 40]


def body(topic, **changes):
    """A complete event of a topic as JSON; a change to ``...`` leaves the field out."""
    event = {f.name: SAMPLES[f.dataType.simpleString()] for f in SCHEMAS[topic].fields} | {"event_time": "2024-05-01T10:15:30.123Z"} | changes
    return json.dumps({k: v for k, v in event.items() if v is not ...})


GARBAGE = "no JSON at all"
VALID = json.loads(body("order_lifecycle", previous_state=None))


def without(*keys, **changes):
    return body("order_lifecycle", **dict.fromkeys(keys, ...), **changes)


def records(spark, values, topic="order-lifecycle-events"):
    """Values as they lie in three partitions of a topic, one a minute."""
    numbered = spark.createDataFrame(list(enumerate(values)), "n long, body string")
    return numbered.select(
        F.encode(F.format_string("k%d", "n"), "UTF-8").alias("key"), F.encode("body", "UTF-8").alias("value"), F.lit(topic).alias("topic"),
        (F.col("n") % 3).cast("int").alias("partition"), (F.col("n") + 1000).alias("offset"),
        F.timestamp_seconds(F.col("n") * 60 + 1_700_000_000).alias("timestamp"), F.lit(0).alias("timestampType"))


def split(spark, values, schema=ORDER, key="order_lifecycle", **extra):
    parsed = ingest.parse(records(spark, values), schema, key, **extra)
    return ingest.good(parsed, schema), ingest.malformed(parsed)


def classify(spark, value, schema=ORDER):
    good, bad = split(spark, [value], schema)
    reasons = [r.error_reason for r in bad.collect()]
    return reasons[0] if reasons else "good" if good.count() == 1 else None


@pytest.mark.parametrize("topic", list(TOPICS))
def test_every_field_of_a_topic_arrives_typed(spark, topic):
    texts = [body(topic, event_id=f"e{i}") for i in range(4)]
    good, bad = split(spark, texts, SCHEMAS[topic], topic)
    assert bad.isEmpty() and good.columns == [*SCHEMAS[topic].names, *METADATA.names]
    for row in good.collect():
        sent = json.loads(row.raw_value)
        assert {k: row[k] for k in sent} == sent and row.raw_value == texts[row.kafka_offset - 1000]


@pytest.mark.parametrize("schema_of", ["payment", "dispatch_decision"])
def test_broken_bytes_are_kept_as_they_came(spark, schema_of):
    rows = split(spark, BROKEN, SCHEMAS[schema_of], schema_of)[1].collect()
    assert {r.kafka_offset - 1000: r.raw_value for r in rows} == dict(enumerate(BROKEN))
    assert {r.source_topic_key for r in rows} == {schema_of} and all(r.raw_key == f"k{r.kafka_offset - 1000}" for r in rows)


def test_any_mix_is_split_by_record(spark):
    kinds = [random.Random(3).choice(["good", "broken", "missing"]) for _ in range(90)]
    make = {"good": lambda: without(), "broken": lambda: "{" * 5, "missing": lambda: without("event_id")}
    good, bad = split(spark, [make[k]() for k in kinds])
    reasons = Counter(r.error_reason for r in bad.collect())
    assert (good.count(), reasons["unparsable_json"], reasons["missing_required_fields"]) == tuple(kinds.count(k) for k in make)
    assert bad.columns == MALFORMED.names


GOOD, UNPARSABLE, MISSING = "good", "unparsable_json", "missing_required_fields"
CASES = [
    (json.dumps(VALID), GOOD),
    (without(extra="x"), GOOD),
    (without("order_id"), GOOD),
    (without(order_id=17), GOOD),
    (without(order_id={"a": 1}), GOOD),
    (json.dumps(VALID) + " trailing", GOOD),
    ('{"event_id": "a", "event_id": "b", "event_time": "t"}', GOOD),
    (without(event_id=""), GOOD),
    (without(order_value_inr=float("nan")), GOOD),
    ("not json", UNPARSABLE),
    (json.dumps(VALID)[:60], UNPARSABLE),
    ("17", UNPARSABLE),
    ('"text"', UNPARSABLE),
    ("null", UNPARSABLE),
    ("[1, 2]", UNPARSABLE),
    ("[]", UNPARSABLE),
    (without(item_count="three"), UNPARSABLE),
    (without(item_count=3.0), UNPARSABLE),
    (without(item_count=2**70), UNPARSABLE),
    (without(order_value_inr="much"), UNPARSABLE),
    (None, MISSING),
    ("", MISSING),
    ("   ", MISSING),
    ("{}", MISSING),
    (without("event_time"), MISSING),
    (without("event_id", EVENT_ID="e-1"), MISSING),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_classification(spark, text, expected):
    assert classify(spark, text) == expected


def test_wrong_type_in_array_field(spark):
    event = {"event_id": "e", "event_time": "t", "batched_with_order_ids": 5}
    assert classify(spark, json.dumps(event), SCHEMAS["dispatch_decision"]) == UNPARSABLE


def test_split_is_total_and_disjoint(spark):
    texts = [t for t, _ in CASES]
    good, bad = split(spark, texts)
    offsets = [r.kafka_offset for r in good.collect()] + [r.kafka_offset for r in bad.collect()]
    assert sorted(offsets) == list(range(1000, 1000 + len(texts)))


def test_each_record_is_parsed_once(spark):
    """A filter on the parsed struct must not be pushed below the parser."""
    good, _ = split(spark, [json.dumps(VALID)])
    assert good._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_stamp_is_one_value_per_batch(spark):
    good, bad = split(spark, [json.dumps(VALID), GARBAGE], ingested_at=F.timestamp_seconds(F.lit(1_700_000_000)))
    stamps = {r.ingestion_timestamp for r in good.collect()} | {r.ingestion_timestamp for r in bad.collect()}
    assert len(stamps) == 1
    assert str(good.collect()[0].ingest_date) == "2023-11-14"


def test_replay_after_a_fix(spark):
    _, bad = split(spark, [GARBAGE, without("event_id")])
    again = ingest.parse(ingest.as_records(bad), ORDER, "order_lifecycle", required=("order_id",))
    assert [r.order_id for r in ingest.good(again, ORDER).collect()] == ["text"]
    assert [r.error_reason for r in ingest.malformed(again).collect()] == ["unparsable_json"]


def test_bad_event_time_class(spark):
    good, _ = split(spark, [json.dumps(VALID), without(event_time="yesterday")])
    rows = {r.event_time: r for r in ingest.with_event_ts(good).collect()}
    assert rows["yesterday"].time_error == "bad_event_time" and rows["yesterday"].event_ts is None
    assert rows[VALID["event_time"]].time_error is None
    assert rows[VALID["event_time"]].event_ts.microsecond == 123_000


def test_contracts_share_the_envelope_and_name_their_key():
    for key, topic in TOPICS.items():
        assert topic is topic_for(key) and topic.key_field in SCHEMAS[key].names
        assert SCHEMAS[key].fields[:3] == struct_of(ENVELOPE).fields
    with pytest.raises(KeyError, match="weather"):
        topic_for("weather")
