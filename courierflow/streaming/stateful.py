"""Keyed state over streams: latest state per key, and closed status spans."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from courierflow.sinks.tables import append_batch
from courierflow.states import ORDER_STATES, ORDER_TERMINAL, legal_moves_frame, state_ordinal

EVENT = ("dp_id", "event_s", "event_id", "status")
SPAN = ("dp_id", "event_id", "status", "event_s", "until_s", "next_status")
HELD = "held binary"  # events as an Arrow stream
RANKS = 16  # more than there are order states


def latest_states(events: DataFrame) -> DataFrame:
    """Current state per order as a streaming aggregate (update mode).

    The greatest (event time, life-cycle rank) wins, whatever the arrival order. Both fit one
    long, so this is a hash aggregate that combines rows before they reach the state of their key.
    """
    newest = F.max(F.col("event_s") * RANKS + state_ordinal(F.col("state"))).alias("newest")
    out = events.groupBy("order_id").agg(newest)
    rank = F.pmod("newest", F.lit(RANKS))
    state = F.element_at(F.array(*[F.lit(s) for s in ORDER_STATES]), rank.cast("int"))
    return out.select("order_id", state.alias("state"), F.floor(F.col("newest") / RANKS).alias("event_s"), rank.cast("long").alias("rank"))


_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a look-up before each write, for a count of keys that nobody reads
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which state with timers asks for."""
    before = {name: spark.conf.get(name, None) for name in _ROCKSDB}
    for name, value in _ROCKSDB.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


def bucket_of(key: Column, buckets: int) -> Column:
    """One of ``buckets`` groups of keys; NULL keys are a group of their own, -1."""
    return F.when(key.isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def bucketed(rows: DataFrame, key: str, buckets: int) -> GroupedData:
    """Rows grouped by the bucket of their key. NULL keys read 0: one among them would turn the ids
    that travel with it into floating point."""
    known = F.coalesce(key, F.lit(0).cast(rows.schema[key].dataType))
    return rows.withColumns({"bucket": bucket_of(F.col(key), buckets), key: known}).groupBy("bucket")


class _Newest(StatefulProcessor):
    """The newest state of the orders of one bucket, each as one number, until the order is over.

    An order ends at the time of a final state, or ``idle_s`` behind its newest event if it goes on.
    Once the watermark has passed that, no event of before can come in any more, and the order's
    entry goes. A timer wakes the bucket up at the first end.
    """

    def __init__(self, final: set[int], idle_s: int, held: T.StructType):
        self.final, self.idle_s, self.held = final, idle_s, held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getListState("newest", self.held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, changed = dict(self.newest.get()), {}
        before = len(known)
        for frame in rows:
            orders = [None] * len(frame) if key[0] < 0 else frame["order_id"].tolist()
            for order, code in zip(orders, frame["code"].tolist()):
                if code > known.get(order, -1):
                    known[order] = changed[order] = code
        self._keep(known, before, bool(changed), timerValues)
        if changed:
            yield pd.DataFrame(list(changed.items()), columns=["order_id", "code"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = dict(self.newest.get())
        self._keep(known, len(known), False, timerValues)
        return iter(())

    def _keep(self, known: dict, before: int, changed: bool, timerValues) -> None:
        """Write the orders that go on, and the timer of the first that ends."""
        mark_s = timerValues.getCurrentWatermarkInMs() / 1000
        ends = {o: c // RANKS + (0 if c % RANKS in self.final else self.idle_s) for o, c in known.items()}
        alive = [(order, code) for order, code in known.items() if ends[order] > mark_s]
        if not changed and len(alive) == before:
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if alive:
            self.newest.put(alive)
            self.handle.registerTimer(1000 * min(ends[order] for order, _ in alive))
        else:
            self.newest.clear()

    def close(self) -> None:
        pass


def ending_states(events: DataFrame, delay: str, idle_s: int = 7 * 86400, buckets: int = 8192) -> DataFrame:
    """Current state per order in update mode, with state that ends: see ``_Newest``.

    As ``latest_states`` otherwise, but events more than ``delay`` behind the newest are dropped, so
    that a finished order can leave the state for good. Each task first keeps one row an order of
    what it has read, so that an order with very many events doesn't meet in one task row by row.
    The state is called once for each of ``buckets`` groups of orders in a batch, not for each order,
    and rewrites the entries of the group: let a bucket hold some hundreds of orders that go on.
    Their number is fixed with the first start, like the state's partitions. Start it within
    ``rocksdb_state``.
    """
    code = F.col("event_s") * RANKS + state_ordinal(F.col("state"))
    coded = events.select("order_id", code.cast("long").alias("code")).where(F.col("code").isNotNull())

    def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.Table.from_batches([batch]).group_by("order_id").aggregate([("code", "max")])
            yield from kept.rename_columns(["order_id", "code"]).to_batches()

    kept = coded.mapInArrow(newest, coded.schema)
    timed = kept.withColumn("at", F.timestamp_seconds(F.floor(F.col("code") / RANKS))).withWatermark("at", delay)
    final = {1 + ORDER_STATES.index(s) for s in ORDER_TERMINAL}  # as ``state_ordinal`` counts
    out = bucketed(timed, "order_id", buckets).transformWithStateInPandas(_Newest(final, idle_s, coded.schema), coded.schema, "Update", "EventTime")
    rank = F.pmod("code", F.lit(RANKS))
    state = F.element_at(F.array(*[F.lit(s) for s in ORDER_STATES]), rank.cast("int"))
    return out.select("order_id", state.alias("state"), F.floor(F.col("code") / RANKS).alias("event_s"), rank.cast("long").alias("rank"))


def start_changes(changes: DataFrame, path: str, checkpoint: str, run: str = "changes") -> StreamingQuery:
    """Write an update-mode aggregate as a change log; the newest row of a key is its value.

    ``run`` names this checkpoint's batches in the table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, run, batch_id, ())

    writer = changes.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _close(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Close the spans of one bucket's partners whose events the watermark has passed.

    The state holds each partner's open event and those the watermark has not reached; a timer wakes
    the bucket up when it does."""
    parts = [pa.ipc.open_stream(state.get[0]).read_pandas()] if state.exists else []
    parts += [frame[[*EVENT]] for frame in frames if len(frame)]
    held = pd.concat(parts, ignore_index=True)
    held = held.sort_values([*EVENT], ignore_index=True)
    mark = state.getCurrentWatermarkMs()
    settled = held["event_s"] * 1000 < mark
    partner = held["dp_id"].to_numpy()
    closed = settled & settled.shift(-1, fill_value=False) & np.append(partner[1:] == partner[:-1], False)
    spans = held[closed].assign(until_s=held["event_s"].shift(-1, fill_value=0)[closed], next_status=held["status"].shift(-1)[closed])
    kept = pa.Table.from_pandas(held[~closed], preserve_index=False)
    packed = pa.BufferOutputStream()
    with pa.ipc.new_stream(packed, kept.schema) as out:
        out.write_table(kept)
    state.update((packed.getvalue().to_pybytes(),))
    waiting = held["event_s"][~settled]
    if len(waiting):
        state.setTimeoutTimestamp(max(int(waiting.min()) * 1000, mark) + 1)
    yield spans[[*SPAN]].assign(has_dp=key[0] >= 0)


def closed_spans(events: DataFrame, delay: str, machines: tuple[str, ...] = ("dp", "dp_observed"), buckets: int = 1024) -> DataFrame:
    """Closed status spans per partner, each with the legality of the move that closed it.

    Events may arrive in any order up to ``delay`` behind the newest; the watermark drops later
    ones. A span comes out once the watermark has passed both its ends. The state is called once
    for each of ``buckets`` groups of partners in a batch, and rewrites what the group holds; their
    number is fixed with the first start, like the state's partitions.
    """
    timed = events.select(*EVENT, F.timestamp_seconds("event_s").alias("at")).withWatermark("at", delay)
    types = {c: events.schema[c].dataType for c in EVENT} | {"until_s": T.LongType(), "next_status": T.StringType()}
    spans = T.StructType([T.StructField(c, types[c]) for c in SPAN]).add("has_dp", "boolean")
    out = bucketed(timed, "dp_id", buckets).applyInPandasWithState(_close, spans, HELD, "append", GroupStateTimeout.EventTimeTimeout)
    out = out.withColumn("dp_id", F.when(F.col("has_dp"), F.col("dp_id"))).drop("has_dp")
    legal = legal_moves_frame(events.sparkSession, *machines).select(
        F.col("from_state").alias("status"), F.col("to_state").alias("next_status"), F.lit(True).alias("_legal")
    )
    checked = out.join(F.broadcast(legal), ["status", "next_status"], "left")
    return checked.withColumn("is_legal", F.coalesce("_legal", F.lit(False))).drop("_legal")
