"""Top-k and sorted reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_failing_services(errors: DataFrame, n: int = 5) -> DataFrame:
    """Services with the most error events; ties in name order."""
    return (
        errors.groupBy("service")
        .agg(
            F.count(F.lit(1)).alias("error_count"),
            F.avg("response_time_ms").alias("avg_response_time_ms"),
        )
        .orderBy(F.desc("error_count"), "service")
        .limit(n)
    )


def top_profiles(profile: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` services of a service profile by error events."""
    return (
        profile.orderBy(F.desc("event_count"), "service")
        .limit(n)
        .select("service", "event_count", "avg_response_time", "error_rate")
    )


def first_windows(metrics: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows in window and service order."""
    return metrics.orderBy("window_start", "service").limit(n)
