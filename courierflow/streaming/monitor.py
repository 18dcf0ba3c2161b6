"""Rows, lateness and freshness of running queries, from their progress reports."""

from __future__ import annotations

import logging
import threading
import time
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger("courierflow.monitor")


@dataclass
class QueryGauge:
    """What one query has done so far."""

    batches: int = 0
    rows: int = 0
    late_rows: int = 0
    rows_per_second: float = 0.0
    watermark: str | None = None
    last_progress: datetime | None = None
    error: str | None = None
    observed: dict[str, dict] = field(default_factory=dict)
    observed_totals: dict[str, dict] = field(default_factory=dict)
    ended: threading.Event = field(default_factory=threading.Event)

    def freshness_s(self, now: datetime | None = None) -> float | None:
        """Seconds since the query last reported."""
        return None if self.last_progress is None else ((now or datetime.now(UTC)) - self.last_progress).total_seconds()


def watched(query: StreamingQuery, monitor: QueryMonitor) -> QueryGauge:
    """The gauge of a query that has ended, with all its batches: reports come in order, the end last."""
    while True:
        with monitor._lock:
            gauge = monitor.gauges.get(query.name or str(query.id))
        if gauge and gauge.ended.wait(1):
            return gauge
        time.sleep(0.05)


class QueryMonitor(StreamingQueryListener):
    """Keeps a gauge per query name (or id). Register with ``spark.streams.addListener``.

    The reports come from the micro-batches themselves, so watching costs no Spark job.
    """

    def __init__(self) -> None:
        self.gauges: dict[str, QueryGauge] = {}
        self._names: dict[str, str] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._names[str(event.id)] = event.name or str(event.id)
            self.gauges.setdefault(self._names[str(event.id)], QueryGauge())

    def onQueryProgress(self, event) -> None:
        report = event.progress
        with self._lock:
            gauge = self.gauges.setdefault(report.name or str(report.id), QueryGauge())
            gauge.batches += 1
            gauge.rows += report.numInputRows
            gauge.rows_per_second = report.processedRowsPerSecond
            gauge.late_rows += sum(op.numRowsDroppedByWatermark for op in report.stateOperators)
            gauge.watermark = report.eventTime.get("watermark")
            gauge.last_progress = datetime.now(UTC)
            for name, row in report.observedMetrics.items():
                gauge.observed[name] = row.asDict()
                sums = gauge.observed_totals.setdefault(name, {})
                for key, value in gauge.observed[name].items():
                    if isinstance(value, int | float):
                        sums[key] = sums.get(key, 0) + value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            name = self._names.get(str(event.id), str(event.id))
            gauge = self.gauges.setdefault(name, QueryGauge())
            gauge.error = event.exception
            gauge.ended.set()
        if event.exception:
            log.error("stream %s ended: %s", name, event.exception)
