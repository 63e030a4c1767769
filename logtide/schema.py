"""The log record: field names, types and the shapes derived from them."""

from __future__ import annotations

# Declared once; every reader, parser and validator uses it. The raw timestamp is
# text and becomes an event-time column in ``functions.records.event_time``.
LOG_FIELDS: dict[str, str] = {
    "timestamp": "STRING",
    "service": "STRING",
    "host": "STRING",
    "log_level": "STRING",
    "message": "STRING",
    "request_id": "STRING",
    "response_time_ms": "DOUBLE",
    "status_code": "BIGINT",
}

LOG_DDL = ", ".join(f"{name} {kind}" for name, kind in LOG_FIELDS.items())

# All fields as text: the shape cleaned by ``operators.cleaning.clean_text_logs``.
TEXT_DDL = ", ".join(f"{name} STRING" for name in LOG_FIELDS)

# Columns of the exported service-window metrics, in file order.
EXPORT_COLUMNS = (
    "window_start",
    "window_end",
    "service",
    "event_count",
    "avg_response_time_ms",
    "max_response_time_ms",
    "min_response_time_ms",
    "server_error_count",
    "client_error_count",
    "error_rate",
    "processing_timestamp",
    "is_high_latency",
    "is_high_error_rate",
    "is_anomaly",
    "anomaly_type",
)

# JSON text of timestamps: ISO-8601 with microseconds, no zone, nulls kept.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
