"""The batch job: read, summarise errors, compute service windows, export.

Two passes over the log: one per-service summary that carries the totals, and the
window metrics. Only their small results are kept between outputs, never the log.
"""

from __future__ import annotations

import random
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rates
from ..functions.records import error_filter
from ..operators.anomalies import export_view, window_alerts, window_anomalies
from ..operators.cleaning import clean_logs
from ..operators.errors import filter_errors
from ..operators.rules import evaluate_rules, spikes
from ..operators.runs import consecutive_errors
from ..operators.summaries import dimension_counts
from ..operators.windows import service_metrics
from ..settings import Settings
from ..sinks.files import land_logs, write_csv, write_jsonl
from ..sources.files import read_logs
from ..sources.synthetic import generate_logs


@dataclass(frozen=True)
class BatchReport:
    """Lazy results of a batch run."""

    by_service: DataFrame
    dimensions: DataFrame
    overall: DataFrame
    top_services: DataFrame
    metrics: DataFrame
    anomalies: DataFrame
    alerts: DataFrame


def batch_report(logs: DataFrame, settings: Settings = Settings()) -> BatchReport:
    clean = clean_logs(logs)
    by_service = (
        clean.withColumn("_error", error_filter(settings.keywords))
        .groupBy("service")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if("_error").alias("error_count"),
            F.avg(F.when(F.col("_error"), F.col("response_time_ms"))).alias("avg_response_time_ms"),
        )
    )
    counts = dimension_counts(clean, settings.dimensions)
    totals = by_service.agg(
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("total_records", "error_count"))
    )
    overall = totals.withColumn("error_rate", rates.share(F.col("error_count"), F.col("total_records")))
    top = (
        by_service.where("error_count > 0")
        .select("service", "error_count", "avg_response_time_ms")
        .orderBy(F.desc("error_count"), "service")
        .limit(settings.top_services)
    )
    metrics = (
        clean.transform(filter_errors, settings.keywords)
        .transform(service_metrics, settings.window)
        .transform(window_anomalies, settings.thresholds)
    )
    anomalies = metrics.where("is_anomaly")
    alerts = window_alerts(metrics, settings.thresholds.alert_error_rate)
    return BatchReport(by_service, counts, overall, top, metrics, anomalies, alerts)


def run_batch(spark: SparkSession, source: str, output: str, settings: Settings = Settings()) -> DataFrame:
    """Print the report of the logs at ``source`` and export the service metrics as CSV."""
    logs = read_logs(spark, source)
    report = batch_report(logs, settings)
    kept = report.by_service.persist()
    report.overall.show(truncate=False)
    report.top_services.show(truncate=False)
    kept.unpersist()
    report.dimensions.orderBy("dimension", F.desc("n"), "value").show(truncate=False)
    target = f"{output}/service_metrics"
    write_csv(export_view(report.metrics), target)
    # The anomalies are read back from the export instead of being computed again.
    exported = spark.read.option("header", True).schema(export_view(report.metrics).schema).csv(target)
    exported.where("is_anomaly").orderBy("window_start", "service").show(truncate=False)
    return exported


def run_job(spark: SparkSession, job: str, source: str, output: str, settings: Settings = Settings()) -> None:
    """One of the jobs rules, runs, spikes and land over the logs at ``source``."""
    logs, limits = clean_logs(read_logs(spark, source)), settings.thresholds
    if job == "land":
        land_logs(logs, output, keywords=settings.keywords)
    elif job == "rules":
        write_jsonl(evaluate_rules(logs, keywords=settings.keywords), output)
    elif job == "spikes":
        write_jsonl(spikes(logs, limits.spike_factor, keywords=settings.keywords), output)
    else:
        # Records carry no number of their own: the request id breaks ties of time.
        order = ("timestamp", "request_id")
        write_jsonl(consecutive_errors(logs, limits.consecutive_errors, order=order, keywords=settings.keywords), output)


def paced_batches(
    spark: SparkSession, records: int, batch_size: int, delay_ms: int, seed: int | None = None
) -> Iterator[DataFrame]:
    """``records`` synthetic logs in batches, ``delay_ms`` apart; other ones each time unless seeded."""
    first = random.SystemRandom().randrange(2**31) if seed is None else seed
    for number, start in enumerate(range(0, records, batch_size)):
        if number:
            time.sleep(delay_ms / 1000)
        n = min(batch_size, records - start)
        yield generate_logs(spark, n, seed=first + number, span_s=delay_ms / 1000 or 1)
