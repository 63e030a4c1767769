"""Whole-log summaries. Each is one aggregation pass unless its text says otherwise."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import rates, records
from .quantiles import RESOLUTION, bucket_edge, exact_percentiles, log_bucket

DIMENSIONS = ("service", "host", "log_level", "status_code")


def overall_error_rate(logs: DataFrame, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """Total, error events and their share; the share of an empty log is zero."""
    counted = logs.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(records.error_filter(keywords)).alias("error_count"),
    )
    return counted.withColumn("error_rate", rates.share(F.col("error_count"), F.col("total_records")))


def latency_sketch(logs: DataFrame, by: Sequence[str] = (), resolution: int = RESOLUTION) -> DataFrame:
    """State of ``metrics_summary`` per value of ``by`` and log bucket of the latency, which merges by sums.

    ``shift`` and ``squares`` are the sums of the distances to the bucket's edge and of their
    squares, so that the spread of large latencies does not cancel out.
    """
    level = F.upper(F.coalesce(F.col("log_level"), F.lit("")))
    rows = logs.select(*by, level.alias("level"), F.coalesce(F.col("response_time_ms").cast("double"), F.lit(0.0)).alias("ms"))
    rows = rows.withColumn("bucket", log_bucket(F.col("ms"), resolution))
    edge = F.coalesce(bucket_edge(F.col("bucket"), resolution), F.lit(0.0))
    rows = rows.withColumn("edge", edge).withColumn("over", F.col("ms") - F.col("edge"))
    return rows.groupBy(*by, "bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("level") == "ERROR").alias("error_count"),
        F.count_if(F.col("level") == "WARNING").alias("warning_count"),
        F.min("ms").alias("low"),
        F.max("ms").alias("high"),
        F.min("edge").alias("edge"),
        F.sum("ms").alias("total"),
        F.sum("over").alias("shift"),
        F.sum(F.col("over") * F.col("over")).alias("squares"),
    )


def merged_sketch(sketch: DataFrame) -> DataFrame:
    """One row per bucket. Sketches merge only if they have one resolution."""
    lowest = [F.min("low").alias("low"), F.max("high").alias("high"), F.min("edge").alias("edge")]
    sums = ("n", "error_count", "warning_count", "total", "shift", "squares")
    return sketch.groupBy("bucket").agg(*lowest, *(F.sum(name).alias(name) for name in sums))


SUMMARY_DDL = (
    "total_records BIGINT, error_count BIGINT, warning_count BIGINT, min_response_time_ms DOUBLE, max_response_time_ms DOUBLE, "
    "mean_response_time_ms DOUBLE, stdev_response_time_ms DOUBLE, median_response_time_ms DOUBLE"
)


def metrics_summary(logs: DataFrame, sketch: DataFrame | None = None) -> DataFrame:
    """Totals by level and the spread of the latency, with the exact median.

    Only level ERROR counts as an error here. A missing latency counts as zero. The log is read
    once for its sketch and once for the values near the median; with a ``sketch`` of the same log
    kept at landing, of any grouping, only for the latter. The buckets, some ten thousand for
    latencies, come to the driver.
    """
    spark = logs.sparkSession
    buckets = (latency_sketch(logs) if sketch is None else merged_sketch(sketch)).collect()
    counted = [(b.low, b.high, b.n) for b in buckets if b.bucket is not None]
    (*_, (_, median)) = [(None, None), *exact_percentiles(logs, "response_time_ms", [0.5], missing=0.0, counted=counted).collect()]
    n = sum(b.n for b in buckets)
    low = high = mean = None
    spread = 0.0
    if n:
        # NaN is larger than any number.
        low = min((b.low for b in buckets), key=lambda v: (math.isnan(v), v))
        high = max((b.high for b in buckets), key=lambda v: (math.isnan(v), v))
        mean = _sum(b.total for b in buckets) / n
        inner = _sum(b.squares - b.shift * b.shift / b.n for b in buckets)
        outer = _sum(b.n * (b.edge + b.shift / b.n - mean) ** 2 for b in buckets)
        spread = math.sqrt((0.0 if inner + outer < 0 else inner + outer) / (n - 1)) if n > 1 else 0.0
    counts = [sum(b[name] for b in buckets) for name in ("error_count", "warning_count")]
    row = (n, *counts, low, high, mean, spread, median)
    return spark.createDataFrame([row], SUMMARY_DDL).withColumn("error_rate", rates.share(F.col("error_count"), F.col("total_records")))


def _sum(values: Iterable[float]) -> float:
    values = list(values)
    return math.fsum(values) if all(map(math.isfinite, values)) else sum(values)


def dimension_counts(logs: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Counts per value of each dimension as (dimension, value, n), and the total.

    Rows are counted per combination first, so the grouping sets multiply combinations
    and not log records. Missing values count as ``unknown``, a missing status as 0.
    """
    missing = {"status_code": F.lit("0")}
    combos = logs.groupBy(
        *(
            F.coalesce(F.col(name).cast("string"), missing.get(name, F.lit("unknown"))).alias(name)
            for name in dimensions
        )
    ).agg(F.count(F.lit(1)).alias("_n"))
    columns = [F.col(name) for name in dimensions]
    sets = combos.groupingSets([[c] for c in columns] + [[]], *columns).agg(
        F.sum("_n").alias("n"), *(F.grouping(c).alias(f"_{name}") for c, name in zip(columns, dimensions))
    )
    dimension, value = F.lit("total"), F.lit("all")
    for name in reversed(dimensions):
        dimension = F.when(F.col(f"_{name}") == 0, name).otherwise(dimension)
        value = F.when(F.col(f"_{name}") == 0, F.col(name)).otherwise(value)
    return sets.select(
        dimension.alias("dimension"), value.alias("value"), F.coalesce("n", F.lit(0)).alias("n")
    )


def null_report(logs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls per column and latency range as (metric, value)."""
    names = list(columns or logs.columns)
    wide: dict[str, Column] = {"total_records": F.count(F.lit(1))}
    wide |= {f"null_{name}": F.count_if(F.col(name).isNull()) for name in names}
    wide |= {
        f"{label}_response_time_ms": how("response_time_ms")
        for label, how in (("avg", F.avg), ("max", F.max), ("min", F.min))
    }
    row = logs.agg(*(column.cast("double").alias(name) for name, column in wide.items()))
    return row.unpivot([], list(wide), "metric", "value")


def feature_summary(features: DataFrame) -> DataFrame:
    """How often each feature flag is set."""
    flags = {
        "total_errors": "is_error",
        "high_latency_count": "is_high_latency",
        "server_errors": "is_server_error",
        "client_errors": "is_client_error",
    }
    return features.agg(*(F.count_if(F.col(flag) == 1).alias(name) for name, flag in flags.items()))


def share_by(rows: DataFrame, column: str, count: str = "n", pct: str = "pct") -> DataFrame:
    """Count and percentage of the rows per value of ``column``, largest first.

    The total is a scalar subquery, so the distinct values never meet in one task to be
    summed.
    """
    whole = rows.agg(F.count(F.lit(1)).alias("whole")).scalar()
    return (
        rows.groupBy(column)
        .agg(F.count(F.lit(1)).alias(count))
        .withColumn(pct, rates.percent(F.col(count), whole))
        .orderBy(F.desc(count), column)
    )


def errors_by_level(errors: DataFrame) -> DataFrame:
    return share_by(errors, "log_level", "error_count")


def service_share(logs: DataFrame) -> DataFrame:
    return share_by(logs, "service", "total_events")


def service_profile(logs: DataFrame, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """Error metrics per service next to its total events, worst first.

    One pass: the metrics are conditional on the error test, the total is not.
    Services without errors fall out. ``error_rate`` is unrounded and of all events.
    """
    error, latency, status = F.col("_error"), F.col("response_time_ms"), F.col("status_code")
    return (
        logs.withColumn("_error", records.error_filter(keywords))
        .groupBy("service")
        .agg(
            F.count_if(error).alias("event_count"),
            F.avg(F.when(error, latency)).alias("avg_response_time"),
            F.max(F.when(error, latency)).alias("max_response_time"),
            F.count_if(error & (status >= 500)).alias("server_errors"),
            F.count_if(error & (status >= 400)).alias("client_errors"),
            F.count(F.lit(1)).alias("total_events"),
        )
        .where("event_count > 0")
        .withColumn(
            "error_rate",
            rates.ratio(F.col("server_errors") + F.col("client_errors"), F.col("total_events")),
        )
        .orderBy(F.desc("event_count"), "service")
    )


def overall_stats(logs: DataFrame, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """Totals, shares in percent, 5xx and 4xx counts and latency range."""
    flags = records.feature_columns()
    total = F.col("total_records")
    return logs.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(records.error_filter(keywords)).alias("error_records"),
        F.count_if(flags["is_high_latency"] == 1).alias("high_latency"),
        F.count_if(flags["is_server_error"] == 1).alias("server_errors"),
        F.count_if(flags["is_client_error"] == 1).alias("client_errors"),
        F.avg("response_time_ms").alias("avg_response_time_ms"),
        F.max("response_time_ms").alias("max_response_time_ms"),
        F.min("response_time_ms").alias("min_response_time_ms"),
    ).withColumns(
        {
            "error_pct": rates.percent(F.col("error_records"), total),
            "high_latency_pct": rates.percent(F.col("high_latency"), total),
        }
    )


def latency_histogram(logs: DataFrame, bins: int = 50, column: str = "response_time_ms") -> DataFrame:
    """Equal-width bins between the smallest and largest value, empty bins included.

    The range is a scalar subquery over one column. Bins are numbered from 1; the last
    one holds its upper edge. When all values are equal the range is widened by half a
    unit on both sides.
    """
    bounds = logs.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    flat = F.col("low") == F.col("high")
    bounds = bounds.select(
        F.struct(
            F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        )
    )
    edges = bounds.scalar()
    low, width = edges["low"], (edges["high"] - edges["low"]) / bins
    position = F.floor((F.col(column) - low) / (edges["high"] - low) * bins)
    filled = (
        logs.where(F.col(column).isNotNull())
        .groupBy((F.least(position, F.lit(bins - 1)) + 1).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    empty = logs.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"), F.lit(0).cast("bigint").alias("n"))
    return (
        filled.unionByName(empty)
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
        .withColumns({"bin_low": low + (F.col("bin") - 1) * width, "bin_high": low + F.col("bin") * width})
    )
