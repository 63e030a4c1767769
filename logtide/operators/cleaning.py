"""Validation and cleaning of log records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records
from ..schema import LOG_DDL, LOG_FIELDS


def parse_timestamps(logs: DataFrame, column: str = "timestamp") -> DataFrame:
    """Text timestamp to event time; malformed text becomes null."""
    return logs.withColumn(column, records.event_time(F.col(column)))


def clean_logs(logs: DataFrame) -> DataFrame:
    """Negative latency and status become zero; nulls stay null."""
    return logs.withColumns(
        {name: records.not_negative(F.col(name)) for name in ("response_time_ms", "status_code")}
    )


def clean_text_logs(logs: DataFrame) -> DataFrame:
    """Clean an all-text record: upper-case level, numbers with default zero, stripped message.

    Columns that are not there are left out.
    """
    rules = {
        "log_level": F.upper,
        "response_time_ms": records.parse_double,
        "status_code": records.parse_integer,
        "message": records.strip,
    }
    return logs.withColumns({name: rule(F.col(name)) for name, rule in rules.items() if name in logs.columns})


def integer_normalize(logs: DataFrame) -> DataFrame:
    """Latency to the nearest integer (ties to even), status to integer."""
    return logs.withColumns(
        {
            "response_time_ms": records.half_even(F.col("response_time_ms")),
            "status_code": F.col("status_code").try_cast("bigint"),
        }
    )


def quality_flags(logs: DataFrame) -> DataFrame:
    """Boolean range checks: status 0 to 599, latency not negative, timestamp present."""
    return logs.withColumns(
        {
            "status_in_range": F.coalesce(F.col("status_code").between(0, 599), F.lit(False)),
            "latency_in_range": F.coalesce(F.col("response_time_ms") >= 0, F.lit(False)),
            "has_timestamp": F.col("timestamp").isNotNull(),
        }
    )


def null_fields(logs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the array ``null_fields`` of the ``columns`` that are null, and ``is_complete``."""
    named = (F.when(F.col(name).isNull(), F.lit(name)) for name in columns)
    return logs.withColumn("null_fields", F.array_compact(F.array(*named))).withColumn(
        "is_complete", F.size("null_fields") == 0
    )


def add_features(logs: DataFrame, **limits: float) -> DataFrame:
    """The 0/1 columns is_error, is_high_latency, is_server_error and is_client_error."""
    return logs.withColumns(records.feature_columns(**limits))


def check_presence(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add ``missing_fields`` and ``is_valid`` to lines of JSON text.

    Filter on ``is_valid`` for the good rows and on its negation for the quarantine;
    a bad line never voids the rest of its file.
    """
    missing = records.missing_fields(F.col(column))
    return lines.withColumn("missing_fields", missing).withColumn(
        "is_valid", F.size("missing_fields") == 0
    )


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to typed log columns; other columns of ``lines`` are kept."""
    kept = [name for name in lines.columns if name != column]
    return _parsed(lines, column).select(*kept, "_log.*").transform(parse_timestamps)


def parse_checked(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed log columns next to the text, with ``missing_fields`` and ``is_valid``.

    A record whose typed fields are all there lacks no key, so the keys are looked up
    only for the others and a sound line is parsed once.
    """
    log = [F.col(f"_log.{name}") for name in LOG_FIELDS]
    complete = reduce(and_, (field.isNotNull() for field in log))
    nothing = F.array().cast("array<string>")
    missing = F.when(complete, nothing).otherwise(records.missing_fields(F.col(column)))
    return (
        _parsed(lines, column)
        .withColumn("missing_fields", missing)
        .select(*lines.columns, *log, "missing_fields", (F.size("missing_fields") == 0).alias("is_valid"))
        .transform(parse_timestamps)
    )


def _parsed(lines: DataFrame, column: str) -> DataFrame:
    return lines.withColumn("_log", F.from_json(F.col(column).cast("string"), LOG_DDL))
