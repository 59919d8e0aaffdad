"""Counters and timings of streaming queries."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "query string, batch_id bigint, num_records bigint, scheduling_ms bigint, processing_ms bigint, "
    "total_ms bigint, valid_num bigint, invalid_num bigint"
)


class ProgressLog(StreamingQueryListener):
    """Appends the report of every micro-batch to a table of JSON lines, so that none is forgotten.

    Reports are written in groups: when `group` of them have come in, when a query ends, and by
    `flush`. Register it with `spark.streams.addListener`.
    """

    def __init__(self, spark: SparkSession, path: str, group: int = 100) -> None:
        self._spark = spark
        self._path = path
        self._group = group
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        took = report["durationMs"]
        total, processing = took.get("triggerExecution", 0), took.get("addBatch", 0)
        counted = report.get("observedMetrics", {}).get("messages", {})
        row = (
            report.get("name"), report["batchId"], report["numInputRows"], total - processing,
            processing, total, counted.get("valid_num"), counted.get("invalid_num"),
        )
        with self._lock:
            self._rows.append(row)
            is_full = len(self._rows) >= self._group
        if is_full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Writes the reports that have come in."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            group = self._spark.createDataFrame(rows, PROGRESS)
            group.coalesce(1).write.mode("append").json(self._path)


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch that a `ProgressLog` has seen: its records, delays in ms and message
    counters, and `records_so_far`, `valid_so_far` and `invalid_so_far`, those of its query up to it."""
    so_far = Window.partitionBy("query").orderBy("batch_id")
    batches = spark.read.schema(PROGRESS).json(path)
    # A micro-batch that was run again counts once.
    latest = batches.groupBy("query", "batch_id").agg(
        *[F.max(c).alias(c) for c in batches.columns if c not in ("query", "batch_id")]
    )
    return latest.withColumns(
        {
            f"{name}_so_far": F.sum(column).over(so_far)
            for name, column in (
                ("records", "num_records"), ("valid", "valid_num"), ("invalid", "invalid_num")
            )
        }
    )
