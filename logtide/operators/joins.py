"""Joins of metrics and logs with service-level tables.

No join is hinted. Spark broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive
execution splits the partitions of a hot service.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import rates
from .errors import filter_errors


def join_totals(logs: DataFrame, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> DataFrame:
    """Error aggregates per service, left-joined with the service's total events.

    ``summaries.service_profile`` gives the same totals in one pass; this form serves
    when the errors come from another table than the totals.
    """
    return attach_totals(filter_errors(logs, keywords), logs)


def attach_totals(errors: DataFrame, logs: DataFrame) -> DataFrame:
    """Error events per service from ``errors``, total events per service from ``logs``."""
    failing = errors.groupBy("service").agg(F.count(F.lit(1)).alias("event_count"))
    totals = logs.groupBy("service").agg(F.count(F.lit(1)).alias("total_events"))
    return failing.join(totals, "service", "left").withColumn(
        "error_share", rates.ratio(F.col("event_count"), F.col("total_events"))
    )


def enrich(rows: DataFrame, registry: DataFrame, key: str = "service") -> DataFrame:
    """Left outer join with a registry that has one row per ``key``; works on streams too."""
    return rows.join(registry, key, "left")
