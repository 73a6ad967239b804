"""Progress of streaming queries as a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = (
    "query string, run string, batch long, at string, input_rows long, watermark string, "
    "state_rows long, state_updated long, state_bytes long, dropped_late long, trigger_ms long"
)
HELD = 256  # progress rows held by the driver between two writes


class ProgressTable(StreamingQueryListener):
    """Writes a row per finished batch to a Parquet table: rows read, watermark,
    rows and bytes of state, late rows dropped, duration. Every batch is recorded,
    also those beyond a query's own recent progress. Add it with
    ``spark.streams.addListener``; ``close`` writes what is left."""

    def __init__(self, spark: SparkSession, path: str, held: int = HELD):
        self.spark, self.path, self.held = spark, path, held
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def _event(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        state = p.get("stateOperators") or []
        total = lambda name: sum(s.get(name, 0) for s in state)
        row = (
            p.get("name"), p["runId"], p["batchId"], p["timestamp"], p.get("numInputRows", 0), (p.get("eventTime") or {}).get("watermark"),
            total("numRowsTotal"), total("numRowsUpdated"), total("memoryUsedBytes"), total("numRowsDroppedByWatermark"),
            (p.get("durationMs") or {}).get("triggerExecution"),
        )
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.held
        if full:
            self.write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def write(self) -> None:
        """Append the rows held so far to the table."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def await_end(self, q: StreamingQuery, seconds: float = 60) -> None:
        """Wait until the events of a finished query have arrived: its end is told last."""
        if not self._event(str(q.runId)).wait(seconds):
            raise TimeoutError(f"no end of query {q.runId} within {seconds} s")

    def close(self) -> None:
        self.spark.streams.removeListener(self)
        self.write()

    def table(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)
