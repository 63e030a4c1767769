"""Fixed values.

Names, word lists, thresholds and mixtures that results depend on. They are part
of the data contract, so they are kept together and in plain text.
"""

SERVICES = (
    "auth-service",
    "api-gateway",
    "payment-service",
    "user-service",
    "notification-service",
)
HOSTS = ("host-01", "host-02", "host-03", "host-04", "host-05")
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")

ERROR_LEVELS = ("ERROR", "CRITICAL", "FATAL")
HOST_CRITICAL_LEVELS = ("ERROR", "CRITICAL")
ERROR_KEYWORDS = ("error", "failure", "failed", "exception", "critical")

SUCCESS_CODES = (200, 201, 204)
CLIENT_ERROR_CODES = (400, 401, 403, 404, 422)
SERVER_ERROR_CODES = (500, 502, 503, 504)

NORMAL_MESSAGES = (
    "Request processed successfully",
    "User logged in",
    "Data retrieved",
    "Record created",
    "Operation completed",
    "Cache hit",
    "Background job started",
    "Configuration reloaded",
    "Health check passed",
    "Connection established",
    "Batch processing completed",
    "Index optimization finished",
)
ERROR_MESSAGES = (
    "Database connection timeout",
    "Authentication failed",
    "Authorization denied",
    "Resource not found",
    "Invalid request payload",
    "Internal server error",
    "Service temporarily unavailable",
    "Request timeout",
    "Concurrent modification detected",
    "Memory allocation failed",
    "File descriptor limit exceeded",
    "Network unreachable",
    "Deadlock detected in transaction",
    "Constraint violation in database",
    "External service call failed",
)

# Shorter lists of the interactive-analysis generator.
COMPACT_NORMAL_MESSAGES = (
    "Request processed successfully",
    "User logged in",
    "Data retrieved",
    "Record created",
    "Cache hit",
    "Health check passed",
)
COMPACT_ERROR_MESSAGES = (
    "Database connection timeout",
    "Authentication failed",
    "Resource not found",
    "Internal server error",
    "Service unavailable",
    "Request timeout",
)

RAW_TOPIC = "raw-logs"
PROCESSED_TOPIC = "processed-logs"
ALERT_TOPIC = "log-alerts"

HIGH_LATENCY_MS = 5000
CRITICAL_LATENCY_MS = 10000
ERROR_RATE_BATCH = 0.1
ERROR_RATE_LIVE = 0.15
CRITICAL_ERROR_RATE = 0.3
SPIKE_FACTOR = 2.5
CONSECUTIVE_ERRORS = 5
PROCESSING_LAG_MS = 10000
PROCESSING_LAG_WARN_MS = 5000

COMPACT_ERROR_CODES = (400, 401, 403, 404, 500, 502, 503, 504)
