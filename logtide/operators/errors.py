"""Error filters and record-level anomalies."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import rates, records
from ..settings import BATCH_THRESHOLDS, Thresholds


def filter_errors(logs: DataFrame, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """Rows with an error level, a status of 400 or more, or a keyword in the message."""
    return logs.where(records.error_filter(keywords))


def filter_errors_flagged(logs: DataFrame, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """As ``filter_errors``, on rows that carry the feature flags."""
    return logs.where((F.col("is_error") == 1) | records.mentions(F.col("message"), keywords))


def filter_reduction(logs: DataFrame, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """Rows before and after the error filter and the reduction in percent."""
    counted = logs.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(records.error_filter(keywords)).alias("error_count"),
    )
    dropped = F.col("total_count") - F.col("error_count")
    return counted.withColumn("reduction_pct", rates.ratio(dropped, F.col("total_count")) * 100)


def flag_records(logs: DataFrame, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """Add the two-valued ``is_error_event``."""
    return logs.withColumn("is_error_event", records.error_event(keywords))


def record_anomalies(
    logs: DataFrame,
    thresholds: Thresholds = BATCH_THRESHOLDS,
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
) -> DataFrame:
    """Add ``reasons``, ``severity`` and ``is_anomaly`` to each record.

    Latency alone leaves the severity NORMAL.
    """
    tests = records.record_tests(thresholds, keywords)
    # The tests become columns first, so that each is evaluated once for its three uses.
    reasons = F.array(*(F.when(F.col(f"_{reason}"), F.lit(reason)) for reason in tests))
    severity = F.when(F.col("_SERVER_ERROR"), "CRITICAL").when(F.col("_ERROR_EVENT"), "HIGH").otherwise("NORMAL")
    return logs.withColumns({f"_{reason}": test for reason, test in tests.items()}).select(
        *logs.columns,
        F.array_compact(reasons).alias("reasons"),
        severity.alias("severity"),
        reduce(or_, (F.col(f"_{reason}") for reason in tests)).alias("is_anomaly"),
    )


def record_alerts(
    logs: DataFrame,
    thresholds: Thresholds = BATCH_THRESHOLDS,
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
    keep: Iterable[str] = (),
) -> DataFrame:
    """One nested alert per anomalous record; ``timestamp`` is the time of processing.

    ``keep`` names input columns to carry along in front of the alert.
    """
    anomalous = reduce(or_, records.record_tests(thresholds, keywords).values())
    return (
        record_anomalies(logs.where(anomalous), thresholds, keywords)
        .select(
            *keep,
            F.current_timestamp().alias("timestamp"),
            F.lit("LOG_ANOMALY").alias("alert_type"),
            "severity",
            "service",
            "host",
            "reasons",
            F.struct("log_level", "status_code", "response_time_ms", "message").alias("relevant_fields"),
        )
    )


def critical_latency(logs: DataFrame, thresholds: Thresholds = BATCH_THRESHOLDS) -> DataFrame:
    """Records slower than the critical limit."""
    return logs.where(F.col("response_time_ms") > thresholds.critical_latency_ms)
