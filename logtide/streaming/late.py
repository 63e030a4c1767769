"""Rows behind the watermark, kept apart: the engine only drops and counts them.

A windowed aggregate drops a row when its last window ended before the watermark that the batch
before ran with, which follows from the rows up to the batch before that one. The same test is
made here on the raw rows, so that they can be inspected or counted in later. Per batch one row
of counters is kept; it also carries the newest time, so a repeated batch decides alike.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..settings import MINUTE, Windowing
from .live import writer

# Batches between the newest row that counts and the batch that is judged by it.
BEHIND = 2


def last_window_end(ts: Column, windowing: Windowing) -> Column:
    """End of the last window a row belongs to, as a zoned timestamp."""
    micros, slide = F.unix_micros(ts.cast("timestamp")), (windowing.slide_s or windowing.length_s) * 1_000_000
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(slide)) + F.lit(windowing.length_s * 1_000_000))


def newest_up_to(spark: SparkSession, counters: str, batch_id: int) -> datetime | None:
    """Newest time in the batches up to ``batch_id``; None if there are none."""
    if batch_id < 0:
        return None
    return spark.read.parquet(f"{counters}/batch={batch_id}").first()["newest"]


def start_late_rows(
    logs: DataFrame,
    output: str,
    checkpoint: str,
    delay: timedelta = timedelta(minutes=10),
    windowing: Windowing = MINUTE,
    trigger: str | None = "5 seconds",
    ts: str = "timestamp",
) -> StreamingQuery:
    """Write late rows to ``output``/rows and (rows, late_rows, newest) to ``output``/counters, by batch.

    Rows without a time are never late; they belong to no window.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counters = f"{output}/counters"
        judge = newest_up_to(spark, counters, batch_id - BEHIND)
        before = newest_up_to(spark, counters, batch_id - 1)
        late = F.lit(False)
        if judge is not None:
            late = F.coalesce(last_window_end(F.col(ts), windowing) <= F.lit(judge - delay), F.lit(False))
        # The counters come along with the only pass over the batch.
        seen = Observation(f"late-{batch_id}")
        watched = batch.withColumn("_late", late).observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if("_late").alias("late_rows"),
            F.max(F.col(ts).cast("timestamp")).alias("newest"),
        )
        watched.where("_late").drop("_late").write.mode("overwrite").parquet(f"{output}/rows/batch={batch_id}")
        found = seen.get
        newest = max((t for t in (before, found["newest"]) if t is not None), default=None)
        row = [(found["rows"], found["late_rows"], newest)]
        spark.createDataFrame(row, "rows BIGINT, late_rows BIGINT, newest TIMESTAMP").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{counters}/batch={batch_id}")

    return writer(logs, checkpoint, "append", trigger).foreachBatch(step).start()


def late_counters(spark: SparkSession, output: str) -> DataFrame:
    """batch, rows, late_rows, newest (over all batches so far)."""
    return spark.read.schema("rows BIGINT, late_rows BIGINT, newest TIMESTAMP, batch BIGINT").parquet(f"{output}/counters")
