"""Continuous ingestion: one parse per micro-batch, fanned out to typed and quarantine tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from courierflow.operators import ingest
from courierflow.schemas import MALFORMED_TABLE, Topic
from courierflow.sinks.tables import append_batch, append_transaction

log = logging.getLogger("courierflow.ingest")


@dataclass
class BatchCounts:
    """Good and malformed records of all finished batches; a batch that is run again counts once.

    ``batches`` holds one row for each batch since the start, newest last.
    """

    batches: list[tuple[int, int, int]] = field(default_factory=list)

    def record(self, batch_id: int, good: int, bad: int) -> None:
        if self.batches and self.batches[-1][0] == batch_id:
            self.batches.pop()
        self.batches.append((batch_id, good, bad))

    @property
    def totals(self) -> tuple[int, int]:
        return sum(b[1] for b in self.batches), sum(b[2] for b in self.batches)


def write_batch(
    records: DataFrame,
    batch_id: int,
    run: str,
    schema: T.StructType,
    topic_key: str | Column,
    good_path: str,
    malformed_path: str,
    counts: BatchCounts | None = None,
    good_partitions: tuple[str, ...] = ("ingest_date",),
    files: int | None = None,
    table_format: str | None = None,
) -> None:
    """Parse a batch once, then write its good and its malformed side.

    One aggregate fills the cache and yields both counts and the batch date. The date is
    the newest broker time of the batch, which a replay reproduces; the wall clock would
    let a retry after midnight write a second copy under another date.
    """
    parsed = ingest.parse(records, schema, topic_key, F.current_timestamp(), F.lit(None).cast("date"))
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bad = F.col("error_reason").isNotNull()
        n_good, n_bad, newest, clock = parsed.agg(
            F.count_if(~bad), F.count_if(bad), F.to_date(F.max("kafka_timestamp")), F.max("ingestion_timestamp")
        ).first()
        dated = parsed.withColumns({"ingest_date": F.lit(newest), "ingestion_timestamp": F.lit(clock)})

        def append(rows: DataFrame, path: str, partitions: tuple[str, ...]) -> None:
            if table_format:
                append_transaction(rows.coalesce(files) if files else rows, path, run, batch_id, table_format, partitions)
            else:
                append_batch(rows, path, run, batch_id, partitions, files)

        if n_good:
            extra = [c for c in good_partitions if c != "ingest_date"]
            append(ingest.good(dated, schema, *extra), good_path, good_partitions)
        if n_bad:
            append(ingest.malformed(dated), malformed_path, ("ingest_date", "source_topic_key"))
            log.warning("batch=%s quarantined %d records", batch_id, n_bad)
        if counts is not None:
            counts.record(batch_id, n_good, n_bad)
        log.info("batch=%s good=%d malformed=%d", batch_id, n_good, n_bad)
    finally:
        parsed.unpersist()


def start_ingest(
    records: DataFrame,
    root: str,
    checkpoint: str,
    schema: T.StructType,
    topic_key: str | Column,
    table: str,
    name: str | None = None,
    trigger_seconds: int | None = None,
    counts: BatchCounts | None = None,
    good_partitions: tuple[str, ...] = ("ingest_date",),
    before_commit: Callable[[int], None] | None = None,
    files: int | None = None,
    table_format: str | None = None,
) -> StreamingQuery:
    """Start the ingestion query. Without ``trigger_seconds`` it drains what is there and
    stops. ``before_commit`` runs after the writes of a batch and before its commit.
    ``files`` bounds the files of a batch; ``table_format`` names a transactional format."""

    def process(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        good_path, malformed_path = f"{root}/{table}", f"{root}/{MALFORMED_TABLE}"
        write_batch(
            batch, batch_id, run, schema, topic_key, good_path, malformed_path, counts, good_partitions, files, table_format
        )
        if before_commit:
            before_commit(batch_id)

    trigger = {"processingTime": f"{trigger_seconds} seconds"} if trigger_seconds else {"availableNow": True}
    writer = records.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(**trigger)
    return (writer.queryName(name) if name else writer).start()


def start_topic(records: DataFrame, root: str, checkpoint_root: str, topic: Topic, **extra) -> StreamingQuery:
    """Ingest one topic into its own table, with its own checkpoint and trigger."""
    return start_ingest(
        records,
        root,
        f"{checkpoint_root}/{topic.table}",
        topic.schema,
        topic.key,
        topic.table,
        name=f"ingest_{topic.key}",
        trigger_seconds=topic.trigger_seconds,
        **extra,
    )
