"""Live service metrics: the batch operators on a watermarked stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.anomalies import live_anomalies, live_view
from ..operators.errors import filter_errors
from ..operators.windows import service_metrics
from ..settings import Settings


def watermarked(logs: DataFrame, delay: str) -> DataFrame:
    """Event time as a zoned timestamp with a bound on lateness, so that state is dropped."""
    return logs.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)


def live_metrics(logs: DataFrame, settings: Settings = Settings(), chained: bool = False) -> DataFrame:
    """Error events per sliding window and service with anomaly flags and severity.

    ``chained``, for append mode: rows go into panes as long as the slide, and panes into
    windows, so a row is held once and not once for each window over it.
    """
    return (
        watermarked(logs, settings.watermark)
        .transform(filter_errors, settings.keywords)
        .transform(service_metrics, settings.live_window, chained=chained)
        .transform(live_anomalies, settings.thresholds)
    )


def writer(
    rows: DataFrame, checkpoint: str, mode: str = "append", trigger: str | None = "5 seconds", name: str | None = None
) -> DataStreamWriter:
    """Stream writer; ``trigger=None`` processes what is there and stops."""
    out = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        out = out.queryName(name)
    return out.trigger(processingTime=trigger) if trigger else out.trigger(availableNow=True)


def start_console(
    logs: DataFrame, checkpoint: str, mode: str = "append", settings: Settings = Settings(), trigger: str | None = ""
) -> StreamingQuery:
    """Show the live view on the console.

    In append mode a window appears once, when the watermark passes its end; update mode
    shows it as it grows.
    """
    view = live_metrics(logs, settings, chained=mode == "append").transform(live_view)
    every = settings.trigger if trigger == "" else trigger
    return writer(view, checkpoint, mode, every).format("console").option("truncate", False).start()
