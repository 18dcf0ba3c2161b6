"""Replay a table as a stream of files, run a streaming plan to its end, read the result."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courierflow.session import scratch
from courierflow.sources.files import stream_files
from courierflow.streaming.monitor import QueryGauge, QueryMonitor, watched

FAR_FUTURE_S = 4102444800  # 2100-01-01: closes every window of a replay
ARRIVAL_ROWS = 50_000  # rows of one arriving file


def slices_of(df: DataFrame, order: str, slices: int) -> Iterator[DataFrame]:
    """Successive ranges of the numeric ``order`` column; together they are all of ``df``."""
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    if lo is None:  # an empty table is one empty slice
        yield df
        return
    width = (hi - lo) // slices + 1
    for i in range(slices):
        yield df.where((F.col(order) >= lo + i * width) & (F.col(order) < lo + (i + 1) * width))


def arrive(part: DataFrame, feed: str) -> None:
    """Append an arrival to a feed. A range of a table that is in order comes out of a few tasks, so
    their files are cut: a batch is read by as many tasks as its rows need."""
    part.write.mode("append").option("maxRecordsPerFile", ARRIVAL_ROWS).parquet(feed)


def end_marker(df: DataFrame, time: str, **values) -> DataFrame:
    """One row far in the future, so that append mode closes all real windows."""
    columns = [
        (F.lit(values[f.name]) if f.name in values else F.lit(FAR_FUTURE_S) if f.name == time else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in df.schema.fields
    ]
    return df.sparkSession.range(1).select(*columns)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a draining query; raise its error."""
    query.awaitTermination()
    return query


def drain(stream: DataFrame, out: str, checkpoint: str) -> QueryGauge:
    """Process what is there into parquet files, then stop; returns what all batches reported."""
    spark, monitor = stream.sparkSession, QueryMonitor()
    spark.streams.addListener(monitor)
    try:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(out)
        )
        return watched(finish(query), monitor)
    finally:
        spark.streams.removeListener(monitor)


def replay(
    table: DataFrame,
    plan: Callable[[DataFrame], DataFrame],
    name: str,
    order: str,
    time: str = "event_s",
    slices: int = 2,
    marker: dict | None = None,
) -> tuple[DataFrame, int]:
    """Feed ``table`` through a streaming ``plan`` in slices; returns all output and the late rows.

    Each slice is written, then drained by a fresh start of the query on the same
    checkpoint, so a batch never mixes slices and every slice tests a resume. ``marker``
    adds an end marker with those values after the last slice.
    """
    spark = table.sparkSession
    feed, out, checkpoint = (scratch(spark, f"{name}-{part}") for part in ("feed", "out", "checkpoint"))
    arrivals = list(slices_of(table, order, slices))
    if marker is not None:
        arrivals.append(end_marker(table, time, **marker))
    late = 0
    for arrival in arrivals:
        arrive(arrival, feed)
        stream = plan(stream_files(spark, feed, table.schema))
        late += drain(stream, out, checkpoint).late_rows
    return spark.read.schema(stream.schema).parquet(out), late
