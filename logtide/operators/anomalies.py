"""Anomaly flags and alerts on window metrics.

Comparisons are strict and follow SQL logic: a missing average is unknown, so
``is_anomaly`` is true when the other test is true and null otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rates
from ..schema import EXPORT_COLUMNS
from ..settings import BATCH_THRESHOLDS, LIVE_THRESHOLDS, Thresholds

SEVERITY_ORDER = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "NORMAL")


def window_anomalies(metrics: DataFrame, thresholds: Thresholds = BATCH_THRESHOLDS) -> DataFrame:
    """Add is_high_latency, is_high_error_rate, is_anomaly and anomaly_type."""
    slow, failing = F.col("is_high_latency"), F.col("is_high_error_rate")
    return (
        metrics.withColumns(
            {
                "is_high_latency": F.col("avg_response_time_ms") > thresholds.latency_ms,
                "is_high_error_rate": F.col("error_rate") > thresholds.error_rate,
            }
        )
        .withColumn("is_anomaly", slow | failing)
        .withColumn(
            "anomaly_type",
            F.when(slow & failing, "LATENCY_AND_ERRORS")
            .when(slow, "HIGH_LATENCY")
            .when(failing, "HIGH_ERROR_RATE")
            .otherwise("NORMAL"),
        )
    )


def live_anomalies(metrics: DataFrame, thresholds: Thresholds = LIVE_THRESHOLDS) -> DataFrame:
    """Add high_latency, high_error_rate, is_anomaly and anomaly_severity.

    The CRITICAL limit does not depend on the error-rate threshold, so a row may be
    CRITICAL without being an anomaly when that threshold is the higher one.
    """
    rate, slow = F.col("error_rate"), F.col("high_latency")
    return (
        metrics.withColumns(
            {
                "high_latency": F.col("avg_response_time_ms") > thresholds.latency_ms,
                "high_error_rate": rate > thresholds.error_rate,
            }
        )
        .withColumn("is_anomaly", slow | F.col("high_error_rate"))
        .withColumn(
            "anomaly_severity",
            F.when(rate > thresholds.critical_error_rate, "CRITICAL")
            .when(rate > thresholds.error_rate, "HIGH")
            .when(slow, "MEDIUM")
            .otherwise("LOW"),
        )
    )


def live_view(anomalies: DataFrame) -> DataFrame:
    """The eight columns shown live, rounded."""
    return anomalies.select(
        "window_start",
        "window_end",
        "service",
        "event_count",
        F.round("avg_response_time_ms", 2).alias("avg_response_ms"),
        F.round("error_rate", 4).alias("error_rate"),
        "anomaly_severity",
        "is_anomaly",
    )


def strict_anomalies(
    metrics: DataFrame,
    thresholds: Thresholds = LIVE_THRESHOLDS,
    latency: str = "avg_response_time",
) -> DataFrame:
    """Anomalous rows only, with two-valued flags (a missing value is not an anomaly)."""

    def known(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    return (
        metrics.withColumns(
            {
                "high_latency": known(F.col(latency) > thresholds.latency_ms),
                "high_error_rate": known(F.col("error_rate") > thresholds.error_rate),
            }
        )
        .withColumn("is_anomaly", F.col("high_latency") | F.col("high_error_rate"))
        .where("is_anomaly")
    )


def first_anomalies(anomalies: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` anomalies in window and service order."""
    return anomalies.orderBy("window_start", "service").limit(n)


def window_alerts(
    anomalies: DataFrame, min_error_rate: float | None = None, clock: bool = True
) -> DataFrame:
    """Alerts from anomalous windows.

    ``min_error_rate`` is off by default: every anomalous window alerts.
    ``clock=False`` leaves the processing time out.
    """
    chosen = anomalies.where("is_anomaly")
    if min_error_rate is not None:
        chosen = chosen.where(F.col("error_rate") > min_error_rate)
    clocked = [F.current_timestamp().alias("alert_generated_time")] if clock else []
    return chosen.select(
        "window_start",
        "window_end",
        "service",
        "event_count",
        "error_rate",
        "avg_response_time_ms",
        F.col("anomaly_type").alias("alert_type"),
        F.lit("AUTOMATED_ALERT").alias("source"),
        *clocked,
    )


def rank_alerts(alerts: DataFrame, severity: str = "anomaly_severity") -> DataFrame:
    """Alerts sorted by severity, then window and service; ``severity_rank`` 1 is the worst."""
    ranks = F.array_position(F.array(*(F.lit(name) for name in SEVERITY_ORDER)), F.col(severity))
    return alerts.withColumn("severity_rank", ranks).orderBy("severity_rank", "window_start", "service")


def export_view(anomalies: DataFrame, clock: bool = True) -> DataFrame:
    """Columns of the exported service metrics, in file order."""
    stamped = anomalies.withColumn("processing_timestamp", F.current_timestamp()) if clock else anomalies
    return stamped.select(*(name for name in EXPORT_COLUMNS if clock or name != "processing_timestamp"))


def alert_metrics(anomalies: DataFrame, total_records: Column) -> DataFrame:
    """Number of anomalies, alert rate per minute-equivalent of 60 records, and counts by cause.

    ``anomalies`` carries ``high_latency`` and ``high_error_rate``; ``total_records`` is a
    scalar column with the number of log records.
    """
    counted = anomalies.agg(
        F.count(F.lit(1)).alias("total_anomalies"),
        F.count_if("high_latency").alias("high_latency_alerts"),
        F.count_if("high_error_rate").alias("high_error_rate_alerts"),
    )
    per_minute = rates.ratio(F.col("total_anomalies"), total_records / 60) * 100
    return counted.withColumn("alert_rate_pct", F.round(per_minute, 2))


def anomaly_breakdown(anomalies: DataFrame) -> DataFrame:
    """Anomalies by type and by severity with their share; one (breakdown, label) per row."""
    total = F.sum("anomaly_count").over(Window.partitionBy("breakdown"))
    # Two labels per window row, merged on the map side: the shuffle carries one row
    # per label and task.
    labels = F.array(
        F.struct(F.lit("type").alias("breakdown"), F.col("anomaly_type").alias("label")),
        F.struct(F.lit("severity").alias("breakdown"), F.col("anomaly_severity").alias("label")),
    )
    return (
        anomalies.where("is_anomaly")
        .select(F.inline(labels))
        .groupBy("breakdown", "label")
        .agg(F.count(F.lit(1)).alias("anomaly_count"))
        .withColumn("pct", rates.percent(F.col("anomaly_count"), total))
    )
