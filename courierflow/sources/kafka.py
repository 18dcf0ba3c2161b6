"""Kafka connection options and the topic stream source."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from courierflow.schemas import Topic

# Fixed value: the login module of Kafka clients.
LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


@dataclass(frozen=True)
class KafkaConnection:
    bootstrap_servers: str = "localhost:9092"
    security_protocol: str = "PLAINTEXT"
    sasl_mechanism: str = ""
    username: str = ""
    password: str = ""

    def missing_credentials(self) -> list[str]:
        """Fields that a SASL protocol needs and that are empty."""
        if not self.security_protocol.upper().startswith("SASL"):
            return []
        return [f.name for f in fields(self) if f.name in ("sasl_mechanism", "username", "password") and not getattr(self, f.name)]

    def login(self) -> dict[str, str]:
        """Options of a plain-text login; none without a mechanism."""
        if not self.sasl_mechanism:
            return {}
        # json.dumps quotes and escapes as the login module reads it
        who = " ".join(f"{k}={json.dumps(v, ensure_ascii=False)}" for k, v in (("username", self.username), ("password", self.password)))
        return {"kafka.sasl.mechanism": self.sasl_mechanism, "kafka.sasl.jaas.config": f"{LOGIN_MODULE} required {who};"}


def connection_options(conn: KafkaConnection) -> dict[str, str]:
    """Bootstrap and security options of a connection whose credentials are complete."""
    if lacking := conn.missing_credentials():
        raise ValueError(f"{conn.security_protocol} connection to {conn.bootstrap_servers} lacks {' and '.join(lacking)}")
    secured = conn.login() if conn.security_protocol.upper().startswith("SASL") else {}
    return {"kafka.bootstrap.servers": conn.bootstrap_servers, "kafka.security.protocol": conn.security_protocol} | secured


def read_options(conn: KafkaConnection, *topics: Topic, min_partitions: int | None = None) -> dict[str, str]:
    """Options of a stream over one or more topics.

    Data that expired before it was read must not stop the stream. ``min_partitions``
    splits offset ranges further than the topic does, also within a hot partition.
    """
    starts = {t.starting_offsets for t in topics}
    if len(starts) != 1:
        raise ValueError("topics of one stream must share their starting offsets")
    options = connection_options(conn) | {
        "subscribe": ",".join(t.topic for t in topics),
        "startingOffsets": starts.pop(),
        "maxOffsetsPerTrigger": str(sum(t.max_offsets for t in topics)),
        "failOnDataLoss": "false",
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topics(spark: SparkSession, conn: KafkaConnection, *topics: Topic, **extra) -> DataFrame:
    return spark.readStream.format("kafka").options(**read_options(conn, *topics, **extra)).load()


def write_options(conn: KafkaConnection, topic: Topic) -> dict[str, str]:
    """Producer options: full acknowledgement, small batches, compressed."""
    return connection_options(conn) | {
        "topic": topic.topic,
        "kafka.acks": "all",
        "kafka.linger.ms": "20",
        "kafka.retries": "5",
        "kafka.compression.type": "gzip",
        "kafka.request.timeout.ms": "30000",
    }
