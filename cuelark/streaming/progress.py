"""Progress of streaming queries as rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """Keeps the last rows: batch, input rows, rows a second, seconds since the query's start, and the chunks that are
    expected in all, where the caller has an estimate (the inventory's n_chunks)."""

    def __init__(self, keep: int = 1000, estimated_chunks: int | None = None):
        self.rows: list[dict] = []
        self.keep, self.estimated_chunks = keep, estimated_chunks
        self.started: dict[str, datetime] = {}

    def onQueryStarted(self, event) -> None:
        self.started[str(event.runId)] = datetime.fromisoformat(event.timestamp)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        since = self.started.get(str(p.runId))  # None if the listener came after the query
        elapsed = (datetime.fromisoformat(p.timestamp) - since).total_seconds() if since else None
        row = {"batch": p.batchId, "rows": p.numInputRows, "rows_a_second": p.processedRowsPerSecond, "at": p.timestamp, "elapsed": elapsed, "estimated_chunks": self.estimated_chunks}
        self.rows = [*self.rows, row][-self.keep :]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.started.pop(str(event.runId), None)
