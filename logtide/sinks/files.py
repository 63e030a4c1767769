"""File sinks, batch and streaming. All write from the executors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as fv
from ..functions.records import error_filter
from ..operators.summaries import latency_sketch
from ..schema import JSON_OPTIONS

# Buckets per doubling of the latency in the sketch of a folder: some hundred rows for most folders.
LANDED_RESOLUTION = 64
# Folder name patterns; they sort like the time itself.
UNITS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header."""
    rows.write.mode(mode).option("header", True).csv(path)


def write_jsonl(logs: DataFrame, path: str, append: bool = False) -> None:
    """One JSON object per line; null fields are written as null, timestamps in ISO-8601."""
    logs.write.mode("append" if append else "overwrite").options(**JSON_OPTIONS).json(path)


def landed(logs: DataFrame, unit: str = "hour", keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """Logs with the partition value ``timestamp_hour`` (or ``_day``) and a stored error flag."""
    return logs.withColumns(
        {
            f"timestamp_{unit}": F.date_format("timestamp", UNITS[unit]),
            "is_error": F.coalesce(error_filter(keywords), F.lit(False)),
        }
    )


def land_logs(
    logs: DataFrame,
    path: str,
    mode: str = "overwrite",
    unit: str = "hour",
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
) -> None:
    """Parquet by hour (or day) and service, and beside it two small tables: the first and newest time of
    each service, and the latencies of each folder as a sketch (``summaries.latency_sketch``).

    The rebalance hint brings the rows of a folder together, and adaptive execution
    splits a hot (hour, service) over several tasks and files and merges small ones. The small
    tables are made from ``logs`` in passes over two and four columns; appending adds rows to them. A
    landing is complete when all three are written.
    """
    by = (f"timestamp_{unit}", "service")
    landed(logs, unit, keywords).hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)
    spans = logs.where(F.col("timestamp").isNotNull()).groupBy("service")
    spans = spans.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("newest"))
    spans.coalesce(1).write.mode(mode).parquet(services_path(path))  # one row per service
    sketch = latency_sketch(landed(logs, unit, keywords), by, LANDED_RESOLUTION)
    sketch.hint("rebalance").write.mode(mode).parquet(sketch_path(path))


def services_path(path: str) -> str:
    """Where ``land_logs`` keeps the times of the services of the log at ``path``."""
    return f"{path.rstrip('/')}-services"


def sketch_path(path: str) -> str:
    """Where ``land_logs`` keeps the sketches of the latencies of the log at ``path``."""
    return f"{path.rstrip('/')}-latencies"


def land_stream(
    logs: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "1 minute",
    unit: str = "hour",
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
) -> StreamingQuery:
    """As ``land_logs`` for a stream; ``trigger=None`` lands what is there and stops."""
    out = (
        landed(logs, unit, keywords)
        .writeStream.format("parquet")
        .partitionBy(f"timestamp_{unit}", "service")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (out.trigger(processingTime=trigger) if trigger else out.trigger(availableNow=True)).start()
