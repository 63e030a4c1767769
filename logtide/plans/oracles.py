"""The registered queries as SQL for an independent engine (DuckDB dialect).

Written from the definitions and not from the Spark plans: sliding windows are spelled
out per row, grids are dense, runs are difference-of-row-number islands.
"""

from __future__ import annotations

LOGS = """logs AS (
  SELECT event_id, ts AS "timestamp",
    CASE user_id % 5 WHEN 0 THEN 'auth-service' WHEN 1 THEN 'api-gateway' WHEN 2 THEN 'payment-service'
      WHEN 3 THEN 'user-service' ELSE 'notification-service' END AS service,
    'host-0' || CAST((event_id + user_id) % 5 + 1 AS VARCHAR) AS host,
    CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'CRITICAL'
      WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'ERROR'
      WHEN event_type = 'error' THEN 'WARNING'
      WHEN event_type = 'view' THEN 'DEBUG' ELSE 'INFO' END AS log_level,
    CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'Exception: Internal server error'
      WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'Database connection timeout'
      WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'External service call failed'
      WHEN event_type = 'error' THEN 'Resource not found'
      WHEN event_type = 'purchase' AND event_id % 25 = 0 THEN 'Retry FAILED once, recovered'
      WHEN value >= 120 THEN 'High latency detected: ' || CAST(CAST(floor(value * 40) AS BIGINT) AS VARCHAR) || 'ms'
      ELSE 'Request processed successfully' END AS message,
    md5(CAST(event_id AS VARCHAR)) AS request_id,
    CAST(floor(value * 40) AS DOUBLE) AS response_time_ms,
    CAST(CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 500
      WHEN event_type = 'error' AND event_id % 2 = 0
        THEN CASE event_id % 8 WHEN 0 THEN 500 WHEN 2 THEN 502 WHEN 4 THEN 503 ELSE 504 END
      WHEN event_type = 'error'
        THEN CASE event_id % 5 WHEN 0 THEN 400 WHEN 1 THEN 401 WHEN 2 THEN 403 WHEN 3 THEN 404 ELSE 422 END
      WHEN event_type = 'signup' THEN 201 WHEN event_type = 'purchase' THEN 204 ELSE 200 END AS BIGINT) AS status_code
  FROM events)"""

DIRTY = """dirty AS (
  SELECT event_id,
    CASE WHEN event_id % 19 = 0 THEN 'not-a-time' ELSE CAST(ts AS VARCHAR) END AS ts_text,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE ts END AS ts,
    CASE WHEN event_id % 7 = 0 THEN CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END
      ELSE CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END END AS log_level,
    CASE WHEN event_id % 11 = 0 THEN 'n/a'
      WHEN event_id % 13 = 0 THEN '-' || CAST(CAST(floor(value * 40) AS BIGINT) AS VARCHAR)
      ELSE CAST(CAST(floor(value * 40) AS BIGINT) AS VARCHAR) END AS response_text,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 23 = 0 THEN '-1'
      WHEN event_id % 29 = 0 THEN '12.7' ELSE '200' END AS status_text,
    CASE WHEN event_id % 3 = 0 THEN '  ' || event_type || ' ' WHEN event_id % 31 = 0 THEN NULL
      ELSE event_type END AS message
  FROM events),
typed AS (
  SELECT event_id, ts AS "timestamp", log_level, message,
    TRY_CAST(response_text AS DOUBLE) AS response_time_ms,
    CASE WHEN regexp_full_match(status_text, '[+-]?[0-9]+') THEN TRY_CAST(status_text AS BIGINT) END AS status_code
  FROM dirty)"""

KEYWORDS = "regexp_matches(message, 'error|failure|failed|exception|critical', 'i')"
ERROR = f"(log_level IN ('ERROR', 'CRITICAL', 'FATAL') OR status_code >= 400 OR {KEYWORDS})"
LEVEL_OR_STATUS = "(log_level IN ('ERROR', 'CRITICAL', 'FATAL') OR status_code >= 400)"
ERRORS = f"errors AS (SELECT * FROM logs WHERE {ERROR})"

SERVER = "COUNT(*) FILTER (WHERE status_code >= 500)"
CLIENT = "COUNT(*) FILTER (WHERE status_code >= 400)"
OVERLAP = f"ROUND(({SERVER} + {CLIENT}) / COUNT(*), 4)"
DISJOINT = f"ROUND(({SERVER} + COUNT(*) FILTER (WHERE status_code BETWEEN 400 AND 499)) / COUNT(*), 4)"


def over_logs(body: str, *tables: str) -> str:
    return "WITH " + ",\n".join((LOGS, ERRORS, *tables)) + "\n" + body


def over_dirty(body: str) -> str:
    return f"WITH {DIRTY}\n{body}"


GAPS = """logs AS (
  SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN "timestamp" END AS "timestamp",
    CASE WHEN event_id % 23 <> 0 THEN service END AS service, CASE WHEN event_id % 29 <> 0 THEN host END AS host,
    CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 7 = 0 THEN lower(log_level) ELSE log_level END AS log_level,
    CASE WHEN event_id % 31 <> 0 THEN message END AS message, request_id,
    CASE WHEN event_id % 11 <> 0 AND extract(hour FROM "timestamp") % 6 <> 0 THEN response_time_ms END AS response_time_ms,
    CASE WHEN event_id % 17 <> 0 THEN status_code END AS status_code
  FROM whole)"""


def over_gaps(body: str, *tables: str) -> str:
    return "WITH " + ",\n".join((LOGS.replace("logs AS", "whole AS", 1), GAPS, ERRORS, *tables)) + "\n" + body


# A record's own tests: levels in any case, a missing code is 200, a missing latency or text is none.
OWN_ERROR = f"""(COALESCE(status_code, 200) >= 400 OR upper(COALESCE(log_level, '')) IN ('ERROR', 'CRITICAL', 'FATAL')
  OR COALESCE({KEYWORDS}, FALSE))"""
OWN_REASONS = f"""concat_ws(',', CASE WHEN COALESCE(response_time_ms, 0) > 5000 THEN 'HIGH_RESPONSE_TIME' END,
  CASE WHEN {OWN_ERROR} THEN 'ERROR_EVENT' END, CASE WHEN COALESCE(status_code, 200) >= 500 THEN 'SERVER_ERROR' END)"""
OWN_SEVERITY = f"CASE WHEN COALESCE(status_code, 200) >= 500 THEN 'CRITICAL' WHEN {OWN_ERROR} THEN 'HIGH' ELSE 'NORMAL' END"


def windows(source: str, length_s: int, slide_s: int | None = None) -> str:
    """Rows of ``source`` once per window they belong to, with window_start and window_end."""
    slide = slide_s or length_s
    return f"""windowed AS (
  SELECT s.*, time_bucket(INTERVAL '{slide} seconds', "timestamp") - n * INTERVAL '{slide} seconds' AS window_start,
    time_bucket(INTERVAL '{slide} seconds', "timestamp") - n * INTERVAL '{slide} seconds'
      + INTERVAL '{length_s} seconds' AS window_end
  FROM {source} s CROSS JOIN generate_series(0, {length_s // slide - 1}) g(n))"""


def service_metrics(name: str, rate: str = OVERLAP) -> str:
    return f"""{name} AS (
  SELECT window_start, window_end, service, COUNT(*) AS event_count,
    AVG(response_time_ms) AS avg_response_time_ms, MAX(response_time_ms) AS max_response_time_ms,
    MIN(response_time_ms) AS min_response_time_ms, {SERVER} AS server_error_count,
    {CLIENT} AS client_error_count, {rate} AS error_rate
  FROM windowed GROUP BY ALL)"""


def flagged(source: str, rt: float = 5000, er: float = 0.1) -> str:
    return f"""flagged AS (
  SELECT *, avg_response_time_ms > {rt} AS is_high_latency, error_rate > {er} AS is_high_error_rate,
    avg_response_time_ms > {rt} OR error_rate > {er} AS is_anomaly,
    CASE WHEN avg_response_time_ms > {rt} AND error_rate > {er} THEN 'LATENCY_AND_ERRORS'
      WHEN avg_response_time_ms > {rt} THEN 'HIGH_LATENCY'
      WHEN error_rate > {er} THEN 'HIGH_ERROR_RATE' ELSE 'NORMAL' END AS anomaly_type
  FROM {source})"""


def severe(source: str, rt: float = 5000, er: float = 0.15) -> str:
    return f"""severe AS (
  SELECT *, CASE WHEN error_rate > 0.3 THEN 'CRITICAL' WHEN error_rate > {er} THEN 'HIGH'
      WHEN avg_response_time_ms > {rt} THEN 'MEDIUM' ELSE 'LOW' END AS anomaly_severity,
    avg_response_time_ms > {rt} OR error_rate > {er} AS live_anomaly
  FROM {source})"""


MINUTE_METRICS = (windows("errors", 60), service_metrics("metrics"))
HOUR_METRICS = (windows("errors", 3600), service_metrics("metrics"))
LIVE_METRICS = (windows("errors", 60, 10), service_metrics("metrics"), severe("metrics"))
DISJOINT_HOURS = (windows("logs", 3600), service_metrics("metrics", DISJOINT))
LIVE_VIEW = """SELECT window_start, window_end, service, event_count,
  ROUND(avg_response_time_ms, 2) AS avg_response_ms, ROUND(error_rate, 4) AS error_rate,
  anomaly_severity, live_anomaly AS is_anomaly FROM severe"""
SERVER_RATES = f"""rates AS (
  SELECT window_start, window_end, service, COUNT(*) AS event_count, AVG(response_time_ms) AS avg_response_time,
    {SERVER} AS server_errors, ROUND({SERVER} / COUNT(*), 4) AS error_rate
  FROM windowed GROUP BY ALL)"""
STRICT = """strict AS (
  SELECT *, avg_response_time > 5000 AS high_latency, error_rate > 0.15 AS high_error_rate,
    avg_response_time > 5000 OR error_rate > 0.15 AS is_anomaly
  FROM rates WHERE avg_response_time > 5000 OR error_rate > 0.15)"""
SERVER_ANOMALIES = (windows("errors", 3600, 600), SERVER_RATES, STRICT)

REASONS = f"""concat_ws(',', CASE WHEN response_time_ms > 5000 THEN 'HIGH_RESPONSE_TIME' END,
  CASE WHEN {ERROR} THEN 'ERROR_EVENT' END, CASE WHEN status_code >= 500 THEN 'SERVER_ERROR' END)"""
SEVERITY = f"CASE WHEN status_code >= 500 THEN 'CRITICAL' WHEN {ERROR} THEN 'HIGH' ELSE 'NORMAL' END"

PROFILE = f"""profile AS (
  SELECT e.service, event_count, avg_response_time, max_response_time, server_errors, client_errors, total_events,
    (server_errors + client_errors) / total_events AS error_rate
  FROM (SELECT service, COUNT(*) AS event_count, AVG(response_time_ms) AS avg_response_time,
      MAX(response_time_ms) AS max_response_time, {SERVER} AS server_errors, {CLIENT} AS client_errors
    FROM errors GROUP BY service) e
  JOIN (SELECT service, COUNT(*) AS total_events FROM logs GROUP BY service) t USING (service))"""


def tally(level: str, total: str, column: str, source: str, *, counts: bool = False) -> str:
    extra = ", CAST(SUM(n) AS BIGINT) AS service_count, COUNT(*) AS distinct_services" if counts else ""
    return f"""SELECT window_start, window_end, {level}, CAST(SUM(n) AS BIGINT) AS {total},
  string_agg(service || ':' || n, ',' ORDER BY service) AS {column}{extra}
FROM (SELECT window_start, window_end, {level}, service, COUNT(*) AS n FROM {source} GROUP BY ALL)
GROUP BY window_start, window_end, {level}"""


# Dense grid of hours: step t covers (t - 1 h, t]; lookback 5 h, hold 2 h, baseline 60 h.
GRID = f"""steps AS (
  SELECT service, time_bucket(INTERVAL '1 hour', "timestamp" - INTERVAL '1 microsecond') + INTERVAL '1 hour' AS t,
    COUNT(*) AS events, COUNT(*) FILTER (WHERE {ERROR}) AS errors,
    COUNT(*) FILTER (WHERE log_level = 'CRITICAL') AS criticals, SUM(response_time_ms) AS latency
  FROM logs GROUP BY ALL),
grid AS (
  SELECT s.service, g.t, COALESCE(p.events, 0) AS events, COALESCE(p.errors, 0) AS errors,
    COALESCE(p.criticals, 0) AS criticals, COALESCE(p.latency, 0) AS latency
  FROM (SELECT DISTINCT service FROM steps) s
  CROSS JOIN (SELECT unnest(generate_series((SELECT MIN(t) FROM steps), (SELECT MAX(t) FROM steps),
    INTERVAL '1 hour')) AS t) g
  LEFT JOIN steps p ON p.service = s.service AND p.t = g.t),
trails AS (
  SELECT service, t, SUM(events) OVER near AS ev, SUM(errors) OVER near AS er, SUM(criticals) OVER near AS cr,
    SUM(latency) OVER near AS la, SUM(errors) OVER far AS base
  FROM grid
  WINDOW near AS (PARTITION BY service ORDER BY t ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
    far AS (PARTITION BY service ORDER BY t ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)),
-- The mean of the 5-hour counts that exist, one every five hours back from t: of those that
-- end after the series began.
means AS (
  SELECT g.service, g.t, SUM(s.er) AS total, COUNT(*) AS samples
  FROM trails g JOIN (SELECT service, MIN(t) AS began FROM steps GROUP BY service) b ON b.service = g.service
  CROSS JOIN generate_series(0, 11) k(k)
  JOIN trails s ON s.service = g.service AND s.t = g.t - k.k * INTERVAL '5 hours' AND s.t >= b.began
  GROUP BY ALL)"""

MEASURES = {
    "error_ratio": "CASE WHEN ev > 0 THEN er / ev END",
    "critical_ratio": "CASE WHEN ev > 0 THEN cr / ev END",
    "avg_latency": "CASE WHEN ev > 0 THEN la / ev END",
    "error_spike": "CASE WHEN total > 0 THEN er * samples / total END",
}
RULES = (
    ("HighErrorRate", "warning", "error_ratio", 0.15),
    ("CriticalErrorRate", "critical", "critical_ratio", 0.05),
    ("HighResponseTime", "warning", "avg_latency", 5000),
    ("ConsecutiveErrorSpike", "critical", "error_spike", 2),
    ("ServiceDegraded", "critical", "error_ratio", 0.25),
)


def fired(rule: str, severity: str, measure: str, threshold: float) -> str:
    return f"""SELECT '{rule}' AS rule, '{severity}' AS severity, service, t AS evaluated_at, value,
    CAST({threshold} AS DOUBLE) AS threshold
  FROM (SELECT service, t, value, SUM(CASE WHEN value > {threshold} THEN 1 ELSE 0 END) OVER (
      PARTITION BY service ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS held
    FROM (SELECT service, t, CAST({MEASURES[measure]} AS DOUBLE) AS value FROM trails LEFT JOIN means USING (service, t)))
  WHERE held = 3"""


ALL_FIRED = " UNION ALL ".join(fired(*rule) for rule in RULES)


def islands(source: str, bad: str, by: str, order: str) -> str:
    """Maximal runs of rows where ``bad`` holds, as (``by``, island) groups."""
    return f"""marked AS (SELECT *, {bad} AS bad FROM {source}),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order})
    - row_number() OVER (PARTITION BY {by}, bad ORDER BY {order}) AS island
  FROM marked)"""


RUNS = """SELECT service, MIN("timestamp") AS run_start, MAX("timestamp") AS run_end,
  arg_min(event_id, ("timestamp", event_id)) AS first_id, arg_max(event_id, ("timestamp", event_id)) AS last_id,
  COUNT(*) AS run_length
FROM numbered WHERE bad GROUP BY service, island HAVING COUNT(*) >= 3"""

STRICT_TEXT = """SELECT event_id, ts_text AS "timestamp", upper(log_level) AS log_level,
  CASE WHEN response_text = 'n/a' THEN 0.0 ELSE CAST(response_text AS DOUBLE) END AS response_time_ms,
  CAST(CASE WHEN regexp_full_match(trim(status_text), '[+-]?[0-9]+') THEN CAST(status_text AS BIGINT) ELSE 0 END AS BIGINT)
    AS status_code,
  trim(message) AS message FROM dirty"""

PLAIN = '"timestamp", service, host, log_level, message, request_id, response_time_ms, status_code'

ORACLES: dict[str, str] = {
    # cleaning
    "logs_adapter": over_logs(f"SELECT event_id, {PLAIN} FROM logs"),
    "parsed_timestamps": over_dirty('SELECT event_id, ts AS "timestamp" FROM dirty'),
    "null_required_fields": over_dirty(
        """SELECT event_id, concat_ws(',',
  CASE WHEN "timestamp" IS NULL THEN 'timestamp' END, CASE WHEN log_level IS NULL THEN 'log_level' END,
  CASE WHEN message IS NULL THEN 'message' END, CASE WHEN response_time_ms IS NULL THEN 'response_time_ms' END,
  CASE WHEN status_code IS NULL THEN 'status_code' END) AS null_fields,
  "timestamp" IS NOT NULL AND log_level IS NOT NULL AND message IS NOT NULL AND response_time_ms IS NOT NULL
    AND status_code IS NOT NULL AS is_complete
FROM typed"""
    ),
    "clean_logs": over_dirty(
        """SELECT event_id, "timestamp", log_level, message,
  CASE WHEN response_time_ms < 0 THEN 0 ELSE response_time_ms END AS response_time_ms,
  CASE WHEN status_code < 0 THEN 0 ELSE status_code END AS status_code FROM typed"""
    ),
    "clean_strict": over_dirty(STRICT_TEXT),
    "quality_flags": over_dirty(
        """SELECT event_id, COALESCE(status_code BETWEEN 0 AND 599, FALSE) AS status_in_range,
  COALESCE(response_time_ms >= 0, FALSE) AS latency_in_range, "timestamp" IS NOT NULL AS has_timestamp FROM typed"""
    ),
    "integer_normalized": """SELECT event_id, CAST(round_even(value * 50, 0) AS BIGINT) AS response_time_ms,
  200 + event_id % 300 AS status_code FROM events""",
    "validated_raw": over_logs(
        """SELECT event_id,
  CASE WHEN event_id % 10 = 0
      THEN 'timestamp,service,host,log_level,message,request_id,response_time_ms,status_code'
    WHEN event_id % 7 = 0 THEN 'host' ELSE '' END AS missing_fields,
  event_id % 10 <> 0 AND event_id % 7 <> 0 AS is_valid,
  CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 7 = 0 THEN service
    WHEN event_id % 3 = 0 THEN NULL ELSE service END AS service,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE status_code END AS status_code FROM logs"""
    ),
    # classification
    "error_flag_record": over_logs(f"SELECT event_id, {ERROR} AS is_error_event FROM logs"),
    "record_anomalies": over_logs(
        f"""SELECT event_id, {REASONS} AS reasons, {SEVERITY} AS severity,
  {REASONS} <> '' AS is_anomaly FROM logs"""
    ),
    "record_alerts": over_logs(
        f"""SELECT event_id, 'LOG_ANOMALY' AS alert_type, {SEVERITY} AS severity, service, host,
  {REASONS} AS reasons, log_level, status_code, response_time_ms, message
FROM logs WHERE {REASONS} <> ''"""
    ),
    "feature_flags": over_logs(
        f"""SELECT event_id, CASE WHEN {LEVEL_OR_STATUS} THEN 1 ELSE 0 END AS is_error,
  CASE WHEN response_time_ms > 5000 THEN 1 ELSE 0 END AS is_high_latency,
  CASE WHEN status_code >= 500 THEN 1 ELSE 0 END AS is_server_error,
  CASE WHEN status_code >= 400 AND status_code < 500 THEN 1 ELSE 0 END AS is_client_error FROM logs"""
    ),
    "filter_errors": over_logs(f"SELECT event_id, {PLAIN} FROM errors"),
    "filter_errors_flagged": over_logs(
        f"""SELECT event_id, CASE WHEN {LEVEL_OR_STATUS} THEN 1 ELSE 0 END AS is_error, message
FROM logs WHERE {LEVEL_OR_STATUS} OR {KEYWORDS}"""
    ),
    "filter_reduction": over_logs(
        f"""SELECT COUNT(*) AS total_count, COUNT(*) FILTER (WHERE {ERROR}) AS error_count,
  (COUNT(*) - COUNT(*) FILTER (WHERE {ERROR})) / COUNT(*) * 100 AS reduction_pct FROM logs"""
    ),
    # windows
    "service_metrics_tumbling": over_logs("SELECT * FROM metrics", *MINUTE_METRICS),
    "service_metrics_hourly": over_logs("SELECT * FROM metrics", *HOUR_METRICS),
    "service_metrics_disjoint": over_logs(
        "SELECT * FROM metrics", windows("errors", 3600), service_metrics("metrics", DISJOINT)
    ),
    "host_metrics": over_logs(
        """SELECT window_start, window_end, host, COUNT(*) AS event_count, AVG(response_time_ms) AS avg_response_time_ms,
  MAX(response_time_ms) AS max_response_time_ms,
  COUNT(*) FILTER (WHERE log_level IN ('ERROR', 'CRITICAL')) AS critical_events
FROM windowed GROUP BY ALL""",
        windows("errors", 3600),
    ),
    "status_metrics": over_logs(
        tally("status_code", "occurrence_count", "affected_services", "windowed", counts=True), windows("logs", 3600)
    ),
    "service_metrics_sliding": over_logs(
        "SELECT * FROM metrics", windows("errors", 60, 10), service_metrics("metrics")
    ),
    "service_metrics_sliding_hour": over_logs(
        "SELECT * FROM metrics", windows("errors", 3600, 600), service_metrics("metrics")
    ),
    "level_metrics_sliding": over_logs(
        tally("log_level", "level_count", "services", "windowed"), windows("logs", 3600, 600)
    ),
    "server_rate_sliding": over_logs("SELECT * FROM rates", windows("errors", 3600, 600), SERVER_RATES),
    "distinct_windows": over_logs(
        "SELECT COUNT(DISTINCT window_start) AS window_count FROM windowed", windows("errors", 60, 10)
    ),
    "error_timeseries": over_logs(
        f"""SELECT *, CASE WHEN error_share > 0.3 THEN 'CRITICAL' WHEN error_share > 0.15 THEN 'HIGH'
  WHEN avg_response_time_ms > 5000 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity
FROM (SELECT window_start, window_end, COUNT(*) AS event_count, COUNT(*) FILTER (WHERE {ERROR}) AS error_count,
  AVG(response_time_ms) AS avg_response_time_ms, ROUND(COUNT(*) FILTER (WHERE {ERROR}) / COUNT(*), 4) AS error_share
  FROM windowed GROUP BY ALL)""",
        windows("logs", 3600),
    ),
    # summaries
    "overall_error_rate": over_logs(
        f"""SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE {ERROR}) AS error_count,
  COUNT(*) FILTER (WHERE {ERROR}) / COUNT(*) AS error_rate FROM logs"""
    ),
    "metrics_summary": over_logs(
        """SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE log_level = 'ERROR') AS error_count,
  COUNT(*) FILTER (WHERE log_level = 'WARNING') AS warning_count, MIN(response_time_ms) AS min_response_time_ms,
  MAX(response_time_ms) AS max_response_time_ms, AVG(response_time_ms) AS mean_response_time_ms,
  ROUND(stddev_samp(response_time_ms), 4) AS stdev_response_time_ms,
  median(response_time_ms) AS median_response_time_ms,
  COUNT(*) FILTER (WHERE log_level = 'ERROR') / COUNT(*) AS error_rate FROM logs"""
    ),
    "dimension_counts": over_logs(
        """SELECT 'service' AS dimension, service AS value, COUNT(*) AS n FROM logs GROUP BY service
UNION ALL SELECT 'host', host, COUNT(*) FROM logs GROUP BY host
UNION ALL SELECT 'log_level', log_level, COUNT(*) FROM logs GROUP BY log_level
UNION ALL SELECT 'status_code', CAST(status_code AS VARCHAR), COUNT(*) FROM logs GROUP BY status_code
UNION ALL SELECT 'total', 'all', COUNT(*) FROM logs"""
    ),
    "null_report": over_dirty(
        " UNION ALL ".join(
            f"SELECT '{name}' AS metric, CAST({value} AS DOUBLE) AS value FROM typed"
            for name, value in {
                "total_records": "COUNT(*)",
                **{
                    f"null_{c}": f'COUNT(*) - COUNT("{c}")'
                    for c in ("event_id", "timestamp", "log_level", "response_time_ms", "status_code", "message")
                },
                "avg_response_time_ms": "AVG(response_time_ms)",
                "max_response_time_ms": "MAX(response_time_ms)",
                "min_response_time_ms": "MIN(response_time_ms)",
            }.items()
        )
    ),
    "feature_summary": over_logs(
        f"""SELECT COUNT(*) FILTER (WHERE {LEVEL_OR_STATUS}) AS total_errors,
  COUNT(*) FILTER (WHERE response_time_ms > 5000) AS high_latency_count, {SERVER} AS server_errors,
  COUNT(*) FILTER (WHERE status_code BETWEEN 400 AND 499) AS client_errors FROM logs"""
    ),
    "errors_by_level": over_logs(
        """SELECT log_level, COUNT(*) AS error_count,
  ROUND(COUNT(*) / (SELECT COUNT(*) FROM errors) * 100, 2) AS pct FROM errors GROUP BY log_level"""
    ),
    "service_profile": over_logs("SELECT * FROM profile", PROFILE),
    "service_share": over_logs(
        """SELECT service, COUNT(*) AS total_events,
  ROUND(COUNT(*) / (SELECT COUNT(*) FROM logs) * 100, 2) AS pct FROM logs GROUP BY service"""
    ),
    "overall_stats": over_logs(
        f"""SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE {ERROR}) AS error_records,
  COUNT(*) FILTER (WHERE response_time_ms > 5000) AS high_latency, {SERVER} AS server_errors,
  COUNT(*) FILTER (WHERE status_code BETWEEN 400 AND 499) AS client_errors,
  AVG(response_time_ms) AS avg_response_time_ms, MAX(response_time_ms) AS max_response_time_ms,
  MIN(response_time_ms) AS min_response_time_ms,
  ROUND(COUNT(*) FILTER (WHERE {ERROR}) / COUNT(*) * 100, 2) AS error_pct,
  ROUND(COUNT(*) FILTER (WHERE response_time_ms > 5000) / COUNT(*) * 100, 2) AS high_latency_pct FROM logs"""
    ),
    "latency_histogram": over_logs(
        """SELECT b.bin, COUNT(l.bin) AS n
FROM (SELECT unnest(generate_series(1, 50)) AS bin) b
LEFT JOIN (SELECT CAST(LEAST(floor((response_time_ms - lo) / (hi - lo) * 50), 49) AS BIGINT) + 1 AS bin
  FROM logs CROSS JOIN (SELECT MIN(response_time_ms) AS lo, MAX(response_time_ms) AS hi FROM logs)) l
ON l.bin = b.bin GROUP BY b.bin"""
    ),
    "alert_metrics": over_logs(
        """SELECT COUNT(*) AS total_anomalies, COUNT(*) FILTER (WHERE high_latency) AS high_latency_alerts,
  COUNT(*) FILTER (WHERE high_error_rate) AS high_error_rate_alerts,
  ROUND(COUNT(*) / ((SELECT COUNT(*) FROM logs) / 60) * 100, 2) AS alert_rate_pct FROM strict""",
        *SERVER_ANOMALIES,
    ),
    "anomaly_breakdown": over_logs(
        """SELECT breakdown, label, COUNT(*) AS anomaly_count,
  ROUND(COUNT(*) / (SELECT COUNT(*) FROM severe WHERE live_anomaly) * 100, 2) AS pct
FROM (SELECT 'type' AS breakdown, anomaly_type AS label FROM severe WHERE live_anomaly
  UNION ALL SELECT 'severity', anomaly_severity FROM severe WHERE live_anomaly) GROUP BY ALL""",
        *DISJOINT_HOURS,
        flagged("metrics"),
        severe("flagged"),
    ),
    # anomalies and alerts
    "window_anomalies": over_logs("SELECT * FROM flagged WHERE is_anomaly", *MINUTE_METRICS, flagged("metrics")),
    "window_anomalies_all_events": over_logs("SELECT * FROM flagged", *DISJOINT_HOURS, flagged("metrics")),
    "service_metrics_export": over_logs("SELECT * FROM flagged", *MINUTE_METRICS, flagged("metrics")),
    "live_anomalies": over_logs(LIVE_VIEW, *LIVE_METRICS),
    "notebook_anomalies": over_logs("SELECT * FROM strict", *SERVER_ANOMALIES),
    "first_anomalies": over_logs(
        "SELECT * FROM strict ORDER BY window_start, service LIMIT 5", *SERVER_ANOMALIES
    ),
    "window_alerts": over_logs(
        """SELECT window_start, window_end, service, event_count, error_rate, avg_response_time_ms,
  anomaly_type AS alert_type, 'AUTOMATED_ALERT' AS source FROM flagged WHERE is_anomaly""",
        *MINUTE_METRICS,
        flagged("metrics"),
    ),
    "window_alerts_limited": over_logs(
        """SELECT window_start, window_end, service, event_count, error_rate, avg_response_time_ms,
  anomaly_type AS alert_type, 'AUTOMATED_ALERT' AS source FROM flagged WHERE is_anomaly AND error_rate > 0.15""",
        *DISJOINT_HOURS,
        flagged("metrics"),
    ),
    "spikes": over_logs(
        f"""SELECT service, pane_start, error_count, baseline FROM (
  SELECT service, t AS pane_start, errors AS error_count, CAST(SUM(errors) OVER past AS DOUBLE) / 12 AS baseline
  FROM panes
  WINDOW past AS (PARTITION BY service ORDER BY t ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))
WHERE baseline > 0 AND error_count > baseline * 2.5""",
        f"""hours AS (
  SELECT service, time_bucket(INTERVAL '1 hour', "timestamp") AS t, COUNT(*) AS events,
    COUNT(*) FILTER (WHERE {ERROR}) AS errors FROM logs GROUP BY ALL)""",
        """panes AS (
  SELECT s.service, g.t, COALESCE(p.events, 0) AS events, COALESCE(p.errors, 0) AS errors
  FROM (SELECT DISTINCT service FROM hours) s
  CROSS JOIN (SELECT unnest(generate_series((SELECT MIN(t) FROM hours), (SELECT MAX(t) FROM hours),
    INTERVAL '1 hour')) AS t) g
  LEFT JOIN hours p ON p.service = s.service AND p.t = g.t)""",
    ),
    "consecutive_errors": over_logs(RUNS, islands("logs", ERROR, "service", '"timestamp", event_id')),
    "critical_latency": over_logs(
        'SELECT event_id, "timestamp", service, response_time_ms FROM logs WHERE response_time_ms > 10000'
    ),
    "ranked_alerts": over_logs(
        """SELECT CAST(CASE anomaly_severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END AS BIGINT)
    AS severity_rank, anomaly_severity, window_start, service, error_rate, avg_response_time_ms
FROM severe WHERE live_anomaly""",
        *DISJOINT_HOURS,
        severe("metrics"),
    ),
    # rules and panels
    "rule_high_error_rate": over_logs(fired(*RULES[0]), GRID),
    "rule_critical_rate": over_logs(fired(*RULES[1]), GRID),
    "rule_high_latency": over_logs(fired("HighResponseTime", "warning", "avg_latency", 2500), GRID),
    "rule_error_spike": over_logs(fired(*RULES[3]), GRID),
    "rule_degraded": over_logs(fired(*RULES[4]), GRID),
    "all_rules": over_logs(ALL_FIRED, GRID),
    "last_hour_events": over_logs(
        """SELECT COUNT(*) AS event_count FROM logs
WHERE "timestamp" > (SELECT MAX("timestamp") FROM logs) - INTERVAL '1 hour'"""
    ),
    "error_rate_series": over_logs(
        "SELECT service, t AS evaluated_at, CAST(er / ev AS DOUBLE) AS error_rate FROM trails WHERE ev > 0", GRID
    ),
    "latency_series": over_logs(
        """SELECT t AS evaluated_at, value AS avg_response_time_ms, value > 2500 AS above_limit
FROM (SELECT t, CAST(SUM(la) / SUM(ev) AS DOUBLE) AS value FROM trails GROUP BY t HAVING SUM(ev) > 0)""",
        GRID,
    ),
    "top_error_services": over_logs(
        "SELECT service, COUNT(*) AS error_count FROM errors GROUP BY service ORDER BY 2 DESC, 1 LIMIT 5"
    ),
    "active_alerts": over_logs(
        f"SELECT COUNT(*) AS active_alerts FROM ({ALL_FIRED}) WHERE evaluated_at = (SELECT MAX(t) FROM steps)", GRID
    ),
    "lag_alerts": over_logs(
        """SELECT 'StreamingProcessingLag' AS rule, 'warning' AS severity, service AS query, MIN(t) AS run_start,
  MAX(t) AS run_end
FROM numbered WHERE bad GROUP BY service, island HAVING MAX(t) - MIN(t) >= INTERVAL '2 hours'""",
        """peaks AS (SELECT service, time_bucket(INTERVAL '1 hour', "timestamp") AS t, MAX(response_time_ms) AS peak
  FROM logs GROUP BY ALL)""",
        islands("peaks", "peak > 5000", "service", "t"),
    ),
    "display_messages": over_logs(
        """SELECT CAST(event_id % 3 AS INT) AS "partition", event_id // 3 AS "offset", strftime("timestamp", '%H:%M:%S.%g') AS "time",
  service, host, log_level, message, CAST(status_code AS VARCHAR) AS status_code,
  CAST(response_time_ms AS VARCHAR) AS response_time_ms
FROM logs ORDER BY 1, 2 LIMIT 50"""
    ),
    "lines_roundtrip": over_logs(
        """SELECT CASE WHEN missing = '' THEN request_id END AS request_id, CASE WHEN missing = '' THEN service END AS service,
  CASE WHEN missing = '' THEN status_code END AS status_code, missing
FROM (SELECT *, CASE WHEN event_id % 9 = 0 THEN
      'timestamp,service,host,log_level,message,request_id,response_time_ms,status_code'
    WHEN event_id % 10 = 0 THEN 'timestamp,log_level,message,request_id,response_time_ms,status_code'
    ELSE '' END AS missing FROM logs
  WHERE event_id % 9 = 0 OR event_id % 10 = 0 OR event_id % 21 <> 0)"""
    ),
    "error_flag_dirty": over_gaps(f"SELECT event_id, {OWN_ERROR} AS is_error_event FROM logs"),
    "record_anomalies_dirty": over_gaps(
        f"""SELECT event_id, {OWN_REASONS} AS reasons, {OWN_SEVERITY} AS severity,
  {OWN_REASONS} <> '' AS is_anomaly FROM logs"""
    ),
    "record_alerts_dirty": over_gaps(
        f"""SELECT event_id, 'LOG_ANOMALY' AS alert_type, {OWN_SEVERITY} AS severity, service, host,
  {OWN_REASONS} AS reasons, log_level, status_code, response_time_ms, message
FROM logs WHERE {OWN_REASONS} <> ''"""
    ),
    "filter_errors_dirty": over_gaps(f"SELECT event_id, {PLAIN} FROM errors"),
    "metrics_summary_dirty": over_gaps(
        """SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE upper(log_level) = 'ERROR') AS error_count,
  COUNT(*) FILTER (WHERE upper(log_level) = 'WARNING') AS warning_count, MIN(ms) AS min_response_time_ms,
  MAX(ms) AS max_response_time_ms, AVG(ms) AS mean_response_time_ms,
  ROUND(stddev_samp(ms), 4) AS stdev_response_time_ms, median(ms) AS median_response_time_ms,
  COUNT(*) FILTER (WHERE upper(log_level) = 'ERROR') / COUNT(*) AS error_rate
FROM (SELECT log_level, COALESCE(response_time_ms, 0) AS ms FROM logs)"""
    ),
    "dimension_counts_dirty": over_gaps(
        """SELECT 'service' AS dimension, COALESCE(service, 'unknown') AS value, COUNT(*) AS n FROM logs GROUP BY 2
UNION ALL SELECT 'host', COALESCE(host, 'unknown'), COUNT(*) FROM logs GROUP BY 2
UNION ALL SELECT 'log_level', COALESCE(log_level, 'unknown'), COUNT(*) FROM logs GROUP BY 2
UNION ALL SELECT 'status_code', COALESCE(CAST(status_code AS VARCHAR), '0'), COUNT(*) FROM logs GROUP BY 2
UNION ALL SELECT 'total', 'all', COUNT(*) FROM logs"""
    ),
    "window_anomalies_dirty": over_gaps(
        "SELECT * FROM flagged",
        windows('(SELECT * FROM logs WHERE "timestamp" IS NOT NULL)', 3600),
        service_metrics("metrics", DISJOINT),
        flagged("metrics"),
    ),
    "keywords_override": over_logs(
        f"""SELECT service, COUNT(*) AS runs, CAST(SUM(run_length) AS BIGINT) AS errors_in_runs, ANY_VALUE(error_count) AS error_count
FROM ({RUNS}) JOIN (SELECT service, COUNT(*) AS error_count FROM marked WHERE bad GROUP BY service) USING (service)
GROUP BY service""",
        islands(
            "logs", f"{LEVEL_OR_STATUS} OR regexp_matches(message, 'timeout|Retry', 'i')", "service", '"timestamp", event_id'
        ),
    ),
    "latency_gauge": over_logs(
        """SELECT service AS query, newest AS delay_ms, LEAST(newest / 10000, 1) * 100 AS gauge_pct,
  newest > 5000 AS above_mark
FROM (SELECT service, arg_max(peak, t) AS newest FROM peaks GROUP BY service)""",
        """peaks AS (SELECT service, time_bucket(INTERVAL '1 hour', "timestamp") AS t, MAX(response_time_ms) AS peak
  FROM logs GROUP BY ALL)""",
    ),
    # joins, top-k
    "totals_join": over_logs(
        """SELECT service, event_count, total_events, event_count / total_events AS error_share FROM profile""",
        PROFILE,
    ),
    "registry_join": over_logs(
        """SELECT m.window_start, m.service, m.event_count, m.error_rate, r.r_name AS owner_region, r.nation_count
FROM metrics m LEFT JOIN registry r ON r.service = m.service""",
        *HOUR_METRICS,
        """registry AS (
  SELECT CASE r_regionkey WHEN 0 THEN 'auth-service' WHEN 1 THEN 'api-gateway' WHEN 2 THEN 'payment-service'
      WHEN 3 THEN 'user-service' WHEN 4 THEN 'notification-service' END AS service, r_name, COUNT(n_nationkey) AS nation_count
  FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL)""",
    ),
    "top_failing": over_logs(
        """SELECT service, COUNT(*) AS error_count, AVG(response_time_ms) AS avg_response_time_ms
FROM errors GROUP BY service ORDER BY 2 DESC, 1 LIMIT 5"""
    ),
    "top3_profile": over_logs(
        """SELECT service, event_count, avg_response_time, error_rate FROM profile
ORDER BY event_count DESC, service LIMIT 3""",
        PROFILE,
    ),
    "first_windows": over_logs(
        "SELECT * FROM rates ORDER BY window_start, service LIMIT 10", windows("errors", 60, 10), SERVER_RATES
    ),
    # sources and sinks
    "kafka_payload_roundtrip": over_logs(f"SELECT {PLAIN} FROM logs"),
    "jsonl_roundtrip": over_logs(f"SELECT {PLAIN} FROM logs"),
    "parquet_roundtrip": over_logs(
        f"SELECT event_id, {PLAIN}, strftime(\"timestamp\", '%Y-%m-%d') AS timestamp_day FROM errors"
    ),
    "csv_roundtrip": over_logs("SELECT * FROM flagged", *MINUTE_METRICS, flagged("metrics")),
    # streams
    "stream_service_metrics": over_logs(LIVE_VIEW, *LIVE_METRICS),
    "stream_alerts": over_logs(
        f"SELECT *, 'AUTOMATED_ALERT' AS source FROM ({LIVE_VIEW}) WHERE is_anomaly", *LIVE_METRICS
    ),
    "stream_pane_metrics": over_logs(
        f"""SELECT * FROM ({LIVE_VIEW})
WHERE window_end <= (SELECT MAX("timestamp") FROM errors) - INTERVAL '10 minutes'""",
        *LIVE_METRICS,
    ),
    "stream_late_rows": over_logs(
        """SELECT r.event_id, r.service, r."timestamp", r.batch
FROM arrived r JOIN newest n ON n.batch = r.batch - 2
WHERE time_bucket(INTERVAL '1 hour', r."timestamp") + INTERVAL '1 hour' <= n.t - INTERVAL '1 hour'""",
        """arrived AS (
  SELECT *, CAST(LEAST(floor((epoch_us("timestamp") - lo) * 6 / (hi - lo + 1)) + CASE WHEN event_id % 50 = 0 THEN 3 ELSE 0 END, 5) AS INT) AS batch
  FROM logs CROSS JOIN (SELECT MIN(epoch_us("timestamp")) AS lo, MAX(epoch_us("timestamp")) AS hi FROM logs))""",
        """newest AS (
  SELECT b.batch, MAX("timestamp") AS t FROM (SELECT DISTINCT batch FROM arrived) b JOIN arrived a ON a.batch <= b.batch GROUP BY b.batch)""",
    ),
    "stream_error_runs": over_logs(
        f"""SELECT r.*, r.last_id = n.newest AS is_open FROM ({RUNS}) r
JOIN (SELECT service, arg_max(event_id, ("timestamp", event_id)) AS newest FROM passed GROUP BY service) n USING (service)""",
        """passed AS (
  SELECT * FROM logs WHERE "timestamp" <= (SELECT MAX("timestamp") FROM logs) - INTERVAL '1 day')""",
        islands("passed", ERROR, "service", '"timestamp", event_id'),
    ),
}
ORACLES["stream_json_restart"] = ORACLES["stream_service_metrics"]
ORACLES["stream_registry_join"] = ORACLES["registry_join"]
ORACLES["last_hour_landed"] = ORACLES["last_hour_events"]
ORACLES["active_alerts_landed"] = ORACLES["active_alerts"]
ORACLES["metrics_summary_landed"] = ORACLES["metrics_summary"]
ORACLES["stream_compacted_metrics"] = ORACLES["stream_service_metrics"]
