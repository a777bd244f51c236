"""A watching job's own progress as metric samples."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from lakeops.operators.metrics import append_samples, samples

# Metric names
BATCH_ROWS = "pipeline_batch_rows"
BATCH_SECONDS = "pipeline_batch_seconds"
BATCH_BACKLOG = "pipeline_batch_backlog"
STATE_ROWS = "pipeline_state_rows"


class ProgressSamples(StreamingQueryListener):
    """Adds rows, seconds, backlog and state of every batch to a table of samples.

    Each batch is a run of its own in the table, so one that is reported again replaces
    what it stored. Register with ``spark.streams.addListener``; queries without a name are
    known by their id. Backlog is what the source says it has not read yet: files for
    files, offsets for a log; a source that does not say has none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        labels = {"query": p.name or str(p.id), "batch": str(p.batchId)}
        backlog = sum(float(v) for s in p.sources for k, v in (s.metrics or {}).items() if k in ("numFilesOutstanding", "avgOffsetsBehindLatest"))
        rows = [
            (BATCH_ROWS, labels, float(p.numInputRows)),
            (BATCH_SECONDS, labels, p.durationMs.get("triggerExecution", 0) / 1000.0),
            (BATCH_BACKLOG, labels, backlog),
            (STATE_ROWS, labels, float(sum(s.numRowsTotal for s in p.stateOperators))),
        ]
        at = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).strftime("%Y-%m-%d %H:%M:%S.%f")
        append_samples(samples(self.spark, at, rows), self.path, f"{p.id}-{p.runId}-{p.batchId}")
