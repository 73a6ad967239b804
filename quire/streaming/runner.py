"""Starting, naming, awaiting and stopping queries.

``run_available_now`` processes everything available and stops: the trigger
used by tests, backfills and the registered queries. Long-running jobs call
``start`` with a processing-time trigger and ``await_for`` instead.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from quire.session import scratch_path


def checkpoint_for(spark: SparkSession, name: str) -> str:
    """A checkpoint folder of its own for every query, below the
    shared checkpoint folder."""
    return scratch_path(spark, f"stream-{name}")


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def run_available_now(writer: DataStreamWriter, timeout_s: float | None = None) -> StreamingQuery:
    """Run over all available input, then stop, however long it takes.
    Raises if the query failed, or did not finish within ``timeout_s`` if given."""
    q = writer.trigger(availableNow=True).start()
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"streaming query {q.name or q.id} did not finish in {timeout_s}s")
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return q


def start(writer: DataStreamWriter, processing_time: str = "60 seconds") -> StreamingQuery:
    """A long-running query polling every ``processing_time``."""
    return writer.trigger(processingTime=processing_time).start()


def await_for(q: StreamingQuery, seconds: float) -> bool:
    """Wait up to ``seconds``; stop the query when it is still running
    (the reference's "run for a while, then exit")."""
    done = q.awaitTermination(seconds)
    if not done:
        q.stop()
    return bool(done)
