"""Run several streaming queries side by side; one failing must not end the others."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger("courierflow.supervisor")


@dataclass
class Outcome:
    state: str  # running, waiting (for its next start), finished or failed
    restarts: int = 0
    in_a_row: int = 0
    error: str | None = None
    next_start: float = 0.0


class Supervisor:
    """Start queries, look at each on its own, restart a failed one a bounded number of times in a row.

    It polls ``isActive``/``exception()`` per query: ``awaitAnyTermination`` raises as soon
    as any query has failed and would take the healthy ones down with it. A start that raises
    counts as a failure of that query alone. The wait before a restart doubles from
    ``poll_seconds`` on, and the count starts anew once a query has finished a batch.
    """

    def __init__(self, starters: dict[str, Callable[[], StreamingQuery]], poll_seconds: float = 30.0, max_restarts: int = 3):
        self.starters, self.poll_seconds, self.max_restarts = starters, poll_seconds, max_restarts
        self.queries: dict[str, StreamingQuery] = {}
        self.outcomes: dict[str, Outcome] = {}

    def start(self) -> None:
        for name in self.starters:
            self.outcomes[name] = Outcome("waiting")
            self._start(name)

    def _start(self, name: str) -> None:
        try:
            self.queries[name] = self.starters[name]()
            self.outcomes[name].state = "running"
        except Exception as error:  # whatever a starter raises is this query's own failure
            self._failed(name, error)

    def _failed(self, name: str, error: object) -> None:
        outcome = self.outcomes[name]
        outcome.error = str(error)
        if outcome.in_a_row >= self.max_restarts:
            outcome.state = "failed"
            log.error("stream %s failed for good: %s", name, error)
            return
        outcome.state, outcome.next_start = "waiting", time.monotonic() + self.poll_seconds * 2**outcome.in_a_row
        outcome.restarts += 1
        outcome.in_a_row += 1
        log.error("stream %s failed, restart %d to come: %s", name, outcome.restarts, error)

    def check(self) -> None:
        """Bring every outcome up to date; restart what failed and may be restarted."""
        for name, outcome in self.outcomes.items():
            if outcome.state == "waiting" and time.monotonic() >= outcome.next_start:
                self._start(name)
            elif outcome.state == "running":
                query = self.queries[name]
                if query.isActive:
                    outcome.in_a_row = 0 if query.lastProgress else outcome.in_a_row
                elif (error := query.exception()) is None:
                    outcome.state = "finished"
                else:
                    self._failed(name, error)

    def run(self, timeout: float | None = None) -> dict[str, Outcome]:
        """Watch until nothing runs or the user interrupts; past a timeout, stop and raise."""
        deadline = None if timeout is None else time.monotonic() + timeout
        try:
            while any(o.state in ("running", "waiting") for o in self.outcomes.values()):
                if deadline is not None and time.monotonic() > deadline:
                    raise TimeoutError(f"streams still at work after {timeout}s")
                time.sleep(self.poll_seconds)
                self.check()
        except KeyboardInterrupt:
            log.info("interrupted, stopping all streams")
        finally:
            self.stop()
        return self.outcomes

    def stop(self) -> None:
        for query in self.queries.values():
            if query.isActive:
                query.stop()
