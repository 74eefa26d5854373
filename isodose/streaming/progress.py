"""Progress of streams as a table: one row per trigger, kept beyond what a query remembers."""

from __future__ import annotations

import json
import uuid
from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from isodose.session import put_note

SCHEMA = (
    "query_id string, run_id string, name string, batch_id long, timestamp string, rows long, rows_per_second double, "
    "input_rows_per_second double, duration_ms long, watermark string, late_rows long, state_rows long, state_bytes long, "
    "start_offsets string, end_offsets string"
)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of all queries of a session to JSON files below ``path``.

    Rows are gathered and written ``every`` so many triggers of a query, and when it ends; a driver
    that dies loses at most those of its last, unwritten triggers.  Add it with
    ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self._spark, self._path, self._every = spark, path, every
        self._rows: dict[str, list[dict]] = {}
        self._ended: set[str] = set()
        self._lock = Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        row = {
            "query_id": str(p.id),
            "run_id": str(p.runId),
            "name": p.name,
            "batch_id": p.batchId,
            "timestamp": p.timestamp,
            "rows": p.numInputRows,
            "rows_per_second": p.processedRowsPerSecond,
            "input_rows_per_second": p.inputRowsPerSecond,
            "duration_ms": dict(p.durationMs).get("triggerExecution"),
            "watermark": dict(p.eventTime).get("watermark"),
            "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "state_bytes": sum(s.memoryUsedBytes for s in p.stateOperators),
            "start_offsets": json.dumps([s.startOffset for s in p.sources]),
            "end_offsets": json.dumps([s.endOffset for s in p.sources]),
        }
        with self._lock:
            held = self._rows.setdefault(row["run_id"], [])
            held.append(row)
            full = len(held) >= self._every
        if full:
            self._write(row["run_id"])

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._write(str(event.runId))
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait_ended(self, run_id: str, timeout: float = 60.0) -> bool:
        """Until all reports of a run have been written; they reach a listener after the run has ended."""
        with self._lock:
            return self._lock.wait_for(lambda: run_id in self._ended, timeout)

    def flush(self) -> None:
        """Write what is held of all queries."""
        for run in list(self._rows):
            self._write(run)

    def _write(self, run: str) -> None:
        with self._lock:
            rows = self._rows.pop(run, [])
        if rows:
            lines = "\n".join(json.dumps({k: v for k, v in r.items() if v is not None and v == v}) for r in rows)
            put_note(self._spark, f"{self._path}/{run}-{rows[0]['batch_id']:012d}-{uuid.uuid4().hex[:8]}.json", lines)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per trigger of every query that was watched."""
    return spark.read.schema(SCHEMA).json(f"{path}/*.json")
