"""Streaming health: trigger durations as rows, lag alerts and the latency gauge."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import fixed_values as fv
from ..operators.runs import held_gauge

PROGRESS_DDL = (
    "query STRING, batch_id BIGINT, at STRING, delay_ms DOUBLE, input_rows BIGINT, late_rows BIGINT"
)


class ProgressLog(StreamingQueryListener):
    """Keeps every trigger of the queries of a session in a Parquet table, whatever their number.

    Rows are appended when ``batch`` of them have come and when a query ends.
    """

    def __init__(self, spark: SparkSession, path: str, batch: int = 50):
        self.spark, self.path, self.batch = spark, path, batch
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        row = (
            report.name or str(report.id),
            report.batchId,
            report.timestamp,
            float(report.durationMs.get("triggerExecution", 0)),
            report.numInputRows,
            sum(operator.numRowsDroppedByWatermark for operator in report.stateOperators),
        )
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.batch
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self._change:
            self._ended.add(str(event.id))
            self._change.notify_all()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
            if rows:
                self.spark.createDataFrame(rows, PROGRESS_DDL).coalesce(1).write.mode("append").parquet(self.path)

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all triggers of a query that has ended are in the table."""
        with self._change:
            return self._change.wait_for(lambda: str(query.id) in self._ended, seconds)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table of a ``ProgressLog``: one row per trigger."""
    return spark.read.schema(PROGRESS_DDL).parquet(path).withColumn("at", F.try_to_timestamp("at"))


def lag_alerts(progress: DataFrame, limit_ms: float = fv.PROCESSING_LAG_MS, hold_s: int = 180) -> DataFrame:
    """Stretches of triggers slower than ``limit_ms`` that last ``hold_s`` seconds or more."""
    held = held_gauge(progress, limit_ms, hold_s, "query", ("at", "batch_id"), "delay_ms")
    return held.select(
        F.lit("StreamingProcessingLag").alias("rule"), F.lit("warning").alias("severity"), "query", "run_start", "run_end"
    )


def latency_gauge(progress: DataFrame) -> DataFrame:
    """Newest delay per query on a 0 to 10000 ms gauge with its warning mark."""
    newest = F.max_by("delay_ms", F.struct("at", "batch_id"))
    return (
        progress.groupBy("query")
        .agg(newest.alias("delay_ms"))
        .withColumns(
            {
                "gauge_pct": F.least(F.col("delay_ms") / fv.PROCESSING_LAG_MS, F.lit(1.0)) * 100,
                "above_mark": F.col("delay_ms") > fv.PROCESSING_LAG_WARN_MS,
            }
        )
    )
