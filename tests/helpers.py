"""Small hand-made inputs."""

from datetime import datetime, timedelta

LOG_DDL = (
    "event_id BIGINT, timestamp TIMESTAMP_NTZ, service STRING, host STRING, log_level STRING, message STRING, "
    "request_id STRING, response_time_ms DOUBLE, status_code BIGINT"
)
START = datetime(2026, 4, 30, 14, 10)


def log(i, at=0.0, service="auth-service", level="INFO", status=200, message="ok", latency=100.0, host="host-01"):
    """One record; ``at`` is in seconds after START, None for no timestamp."""
    when = None if at is None else START + timedelta(seconds=at)
    return (i, when, service, host, level, message, f"r{i}", latency, status)


def frame(spark, rows):
    return spark.createDataFrame(rows, LOG_DDL)


def as_dicts(df):
    return [row.asDict(recursive=True) for row in df.collect()]
