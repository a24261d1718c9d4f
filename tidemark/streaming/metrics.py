"""Progress of streaming queries, kept per query for dashboards and heartbeats."""

from __future__ import annotations

import time
from collections import deque

from pyspark.sql.streaming import StreamingQueryListener


class ProgressListener(StreamingQueryListener):
    """Remembers the latest state of each query and its last progress reports."""

    def __init__(self, keep: int = 100):
        self.keep, self.state, self.history = keep, {}, {}

    def _set(self, query: str, status: str, **more) -> None:
        self.state[query] = {"status": status, "updated_at": time.time(), **more}

    def onQueryStarted(self, event) -> None:
        self._set(str(event.id), "online", name=event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"batch_id": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond, "duration_ms": p.durationMs.get("triggerExecution") if p.durationMs else None}
        self._set(str(p.id), "running", name=p.name, **row)
        self.history.setdefault(str(p.id), deque(maxlen=self.keep)).append(row)

    def onQueryIdle(self, event) -> None:
        self._set(str(event.id), "running")

    def onQueryTerminated(self, event) -> None:
        self._set(str(event.id), "error" if event.exception else "stopped", error=event.exception)

    def stale(self, seconds: float = 60.0) -> list[str]:
        """Queries that have said nothing for a while."""
        return [q for q, s in self.state.items() if time.time() - s["updated_at"] > seconds and s["status"] in ("online", "running")]
