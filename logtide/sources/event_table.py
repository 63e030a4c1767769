"""The ``events`` table as a log: each event becomes one log record.

The mapping is fixed, so a SQL engine can repeat it exactly. All of it is one projection;
a query that needs four log columns reads only the event columns behind those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..session import use_utc

# Status by (event_id modulo), in order of the remainder.
ERROR_STATUS = {0: 500, 2: 502, 4: 503, 6: 504}
WARNING_STATUS = {0: 400, 1: 401, 2: 403, 3: 404, 4: 422}
PLAIN_STATUS = {"signup": 201, "purchase": 204}


def _pick(code: Column, choices: dict, default=None) -> Column:
    out = F.lit(default)
    for value, label in reversed(choices.items()):
        out = F.when(code == value, F.lit(label)).otherwise(out)
    return out


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def as_logs(events: DataFrame) -> DataFrame:
    """Events as typed log records, with ``event_id`` as the order within a timestamp."""
    event, kind, latency = F.col("event_id"), F.col("event_type"), F.floor(F.col("value") * 40)
    failed, even = kind == "error", F.pmod(event, F.lit(2)) == 0
    level = (
        F.when(failed & (F.pmod(event, F.lit(10)) == 0), "CRITICAL")
        .when(failed & even, "ERROR")
        .when(failed, "WARNING")
        .when(kind == "view", "DEBUG")
        .otherwise("INFO")
    )
    status = (
        F.when(failed & (F.pmod(event, F.lit(10)) == 0), 500)
        .when(failed & even, _pick(F.pmod(event, F.lit(8)), ERROR_STATUS))
        .when(failed, _pick(F.pmod(event, F.lit(5)), WARNING_STATUS))
        .otherwise(_pick(kind, PLAIN_STATUS, 200))
    )
    message = (
        F.when(failed & (F.pmod(event, F.lit(10)) == 0), "Exception: Internal server error")
        .when(failed & (F.pmod(event, F.lit(4)) == 0), "Database connection timeout")
        .when(failed & even, "External service call failed")
        .when(failed, "Resource not found")
        .when((kind == "purchase") & (F.pmod(event, F.lit(25)) == 0), "Retry FAILED once, recovered")
        .when(F.col("value") >= 120, F.concat(F.lit("High latency detected: "), latency, F.lit("ms")))
        .otherwise("Request processed successfully")
    )
    host = F.pmod(event + F.col("user_id"), F.lit(5)) + 1
    return events.select(
        event,
        F.col("ts").alias("timestamp"),
        _pick(F.pmod("user_id", F.lit(5)), dict(enumerate(fv.SERVICES))).alias("service"),
        F.concat(F.lit("host-0"), host).alias("host"),
        level.alias("log_level"),
        message.alias("message"),
        F.md5(event.cast("string")).alias("request_id"),
        latency.cast("double").alias("response_time_ms"),
        status.cast("bigint").alias("status_code"),
    )


def as_dirty_text(events: DataFrame) -> DataFrame:
    """Events as all-text records with malformed, missing and negative values."""
    event, kind = F.col("event_id"), F.col("event_type")

    def every(n: int) -> Column:
        return F.pmod(event, F.lit(n)) == 0

    latency = F.floor(F.col("value") * 40).cast("string")
    level = F.when(kind == "error", "ERROR").otherwise("INFO")
    return events.select(
        event,
        F.when(every(19), "not-a-time").otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(every(7), F.lower(level)).otherwise(level).alias("log_level"),
        F.when(every(11), "n/a")
        .when(every(13), F.concat(F.lit("-"), latency))
        .otherwise(latency)
        .alias("response_time_ms"),
        F.when(every(17), F.lit(None))
        .when(every(23), "-1")
        .when(every(29), "12.7")
        .otherwise("200")
        .alias("status_code"),
        F.when(every(3), F.concat(F.lit("  "), kind, F.lit(" ")))
        .when(every(31), F.lit(None))
        .otherwise(kind)
        .alias("message"),
    )


def as_raw_lines(events: DataFrame) -> DataFrame:
    """Events as JSON lines: some are not JSON, some lack a field, some hold a null."""
    event = F.col("event_id")
    record = ("timestamp", "service", "host", "log_level", "message", "request_id", "response_time_ms", "status_code")
    logs = as_logs(events).withColumn("timestamp", F.col("timestamp").cast("string"))
    whole = F.to_json(F.struct(*record))
    without_host = F.to_json(F.struct(*(name for name in record if name != "host")))
    null_service = F.to_json(
        F.struct(*(F.lit(None).cast("string").alias(n) if n == "service" else F.col(n) for n in record)),
        {"ignoreNullFields": "false"},
    )
    line = (
        F.when(F.pmod(event, F.lit(10)) == 0, "not json")
        .when(F.pmod(event, F.lit(7)) == 0, without_host)
        .when(F.pmod(event, F.lit(3)) == 0, null_service)
        .otherwise(whole)
    )
    return logs.select("event_id", line.alias("value"))


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Service registry from ``region`` and ``nation``: owner region and number of nations."""
    nations = (
        read_table(spark, folder, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("nation_count"))
    )
    regions = read_table(spark, folder, "region")
    return (
        regions.join(nations, regions.r_regionkey == nations.n_regionkey, "left")
        .select(
            _pick(F.col("r_regionkey"), dict(enumerate(fv.SERVICES))).alias("service"),
            F.col("r_name").alias("owner_region"),
            F.coalesce("nation_count", F.lit(0)).alias("nation_count"),
        )
        .where(F.col("service").isNotNull())
    )


def logs_from(spark: SparkSession, folder: str) -> DataFrame:
    return as_logs(read_table(spark, folder, "events"))
