"""Event-time window metrics per service, host, status code or level.

Every metric is a ``Measure`` that can be built from partial values. Tumbling
windows and streams aggregate rows directly. A sliding batch window aggregates
each row once into a pane of the slide's length and then adds the panes up, so the
length/slide copies are made of small pane rows and not of the raw log.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import rates
from ..functions.records import error_filter
from ..settings import LIVE_THRESHOLDS, MINUTE, MINUTE_BY_TEN, Thresholds, Windowing


@dataclass(frozen=True)
class Part:
    """A partial value: computed from rows, then merged by ``merge``."""

    of_rows: Column
    merge: str = "sum"

    def of_parts(self, name: str) -> Column:
        return {"sum": F.sum, "max": F.max, "min": F.min}[self.merge](name)


def _parts(keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> dict[str, Part]:
    latency, status, level = F.col("response_time_ms"), F.col("status_code"), F.col("log_level")
    return {
        "_events": Part(F.count(F.lit(1))),
        "_latency_sum": Part(F.sum(latency)),
        "_latency_n": Part(F.count(latency)),
        "_latency_max": Part(F.max(latency), "max"),
        "_latency_min": Part(F.min(latency), "min"),
        "_server": Part(F.count_if(status >= 500)),
        "_client": Part(F.count_if(status >= 400)),
        "_critical": Part(F.count_if(level.isin(*fv.HOST_CRITICAL_LEVELS))),
        "_errors": Part(F.count_if(error_filter(keywords))),
    }


@dataclass(frozen=True)
class Measure:
    """An output column over named parts."""

    name: str
    needs: tuple[str, ...]
    value: Column = field(compare=False)


def measure(name: str, value: Column, *needs: str) -> Measure:
    return Measure(name, needs, value)


def events(name: str = "event_count") -> Measure:
    return measure(name, F.col("_events"), "_events")


def average_latency(name: str = "avg_response_time_ms") -> Measure:
    return measure(
        name, rates.ratio(F.col("_latency_sum"), F.col("_latency_n")), "_latency_sum", "_latency_n"
    )


def slowest(name: str = "max_response_time_ms") -> Measure:
    return measure(name, F.col("_latency_max"), "_latency_max")


def fastest(name: str = "min_response_time_ms") -> Measure:
    return measure(name, F.col("_latency_min"), "_latency_min")


def server_errors(name: str = "server_error_count") -> Measure:
    return measure(name, F.col("_server"), "_server")


def client_errors(name: str = "client_error_count") -> Measure:
    """Status 400 and above, 5xx included."""
    return measure(name, F.col("_client"), "_client")


def critical_events(name: str = "critical_events") -> Measure:
    return measure(name, F.col("_critical"), "_critical")


def error_rate(kind: str = "overlap") -> Measure:
    server, client, total = F.col("_server"), F.col("_client"), F.col("_events")
    if kind == "server_only":
        return measure("error_rate", rates.server_rate(server, total), "_server", "_events")
    formula = {"overlap": rates.overlap_rate, "disjoint": rates.disjoint_rate}[kind]
    return measure("error_rate", formula(server, client, total), "_server", "_client", "_events")


def windowed(
    logs: DataFrame,
    by: Sequence[str],
    windowing: Windowing,
    measures: Sequence[Measure],
    ts: str = "timestamp",
    panes: bool = True,
    keywords: Iterable[str] = fv.ERROR_KEYWORDS,
    chained: bool = False,
) -> DataFrame:
    """``measures`` per event-time window and ``by``; rows without a timestamp fall out.

    Output: ``window_start``, ``window_end``, the ``by`` columns, the measures.
    ``panes=False`` turns the pane roll-up off. On a stream it needs ``chained``: two aggregates
    one behind the other, which the engine allows in append mode only.
    """
    known = _parts(keywords)
    parts = {name: known[name] for m in measures for name in m.needs}
    rows = [part.of_rows.alias(name) for name, part in parts.items()]

    if panes and windowing.sliding and windowing.divisible and (chained or not logs.isStreaming):
        pane = logs.groupBy(F.window(ts, windowing.slide).alias("_pane"), *by).agg(*rows)
        # The time of a pane's window carries the watermark on to the second aggregate.
        at = F.window_time("_pane") if logs.isStreaming else F.col("_pane.start")
        grouped = (
            pane.withColumn("_at", at)
            .groupBy(F.window("_at", windowing.length, windowing.slide).alias("_window"), *by)
            .agg(*(part.of_parts(name).alias(name) for name, part in parts.items()))
        )
    else:
        span = F.window(ts, windowing.length, windowing.slide)
        grouped = logs.groupBy(span.alias("_window"), *by).agg(*rows)

    return grouped.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *by,
        *(m.value.alias(m.name) for m in measures),
    )


def service_metrics(
    logs: DataFrame, windowing: Windowing = MINUTE, rate: str = "overlap", panes: bool = True, chained: bool = False
) -> DataFrame:
    """Counts, latency and error rate per window and service; ``chained`` as for ``windowed``."""
    measures = (
        events(),
        average_latency(),
        slowest(),
        fastest(),
        server_errors(),
        client_errors(),
        error_rate(rate),
    )
    return windowed(logs, ["service"], windowing, measures, panes=panes, chained=chained)


def host_metrics(logs: DataFrame, windowing: Windowing = MINUTE) -> DataFrame:
    """Counts, latency and ERROR/CRITICAL events per window and host."""
    measures = (events(), average_latency(), slowest(), critical_events())
    return windowed(logs, ["host"], windowing, measures)


def server_rate_metrics(logs: DataFrame, windowing: Windowing = MINUTE_BY_TEN, chained: bool = False) -> DataFrame:
    """Counts, latency and 5xx-only error rate per window and service; ``chained`` as for ``windowed``."""
    measures = (
        events(),
        average_latency("avg_response_time"),
        server_errors("server_errors"),
        error_rate("server_only"),
    )
    return windowed(logs, ["service"], windowing, measures, chained=chained)


def _service_tally(per_service: DataFrame, by: Sequence[str], total: str, tally: str) -> DataFrame:
    """Fold (``by``, service, n) rows into one row with the services and how often each occurs.

    The tally is the whole multiset of services, held as one entry per service. The
    raw log is counted before this step, so a group has as many rows as services.
    """
    entry = F.struct(F.col("service"), F.col("_n").alias("n"))
    return per_service.groupBy("window_start", "window_end", *by).agg(
        F.sum("_n").alias(total),
        F.array_sort(F.collect_list(F.when(F.col("service").isNotNull(), entry))).alias(tally),
    )


def status_metrics(logs: DataFrame, windowing: Windowing = MINUTE) -> DataFrame:
    """Occurrences and affected services per window and status code.

    ``affected_services`` is an array of (service, n). ``service_count`` counts the
    services with repetition, ``distinct_services`` without.
    """
    counted = windowed(logs, ["status_code", "service"], windowing, [events("_n")])
    tallied = _service_tally(counted, ["status_code"], "occurrence_count", "affected_services")
    repeats = F.aggregate(
        "affected_services", F.lit(0).cast("bigint"), lambda total, entry: total + entry["n"]
    )
    return tallied.withColumns(
        {"service_count": repeats, "distinct_services": F.size("affected_services").cast("bigint")}
    )


def level_metrics(logs: DataFrame, windowing: Windowing = MINUTE_BY_TEN) -> DataFrame:
    """Events and services per window and log level; ``services`` is an array of (service, n)."""
    counted = windowed(logs, ["log_level", "service"], windowing, [events("_n")])
    return _service_tally(counted, ["log_level"], "level_count", "services")


def expand_services(tally: str | Column) -> Column:
    """Plain array of service names with repetition from an array of (service, n)."""
    column = F.col(tally) if isinstance(tally, str) else tally
    return F.flatten(
        F.transform(column, lambda entry: F.array_repeat(entry["service"], entry["n"].cast("int")))
    )


def tally_text(tally: str) -> Column:
    """``service:n`` pairs joined by commas."""
    return F.array_join(
        F.transform(tally, lambda entry: F.concat_ws(":", entry["service"], entry["n"])), ","
    )


def error_timeseries(
    logs: DataFrame, windowing: Windowing = MINUTE, thresholds: Thresholds = LIVE_THRESHOLDS
) -> DataFrame:
    """Errors, mean latency of all events and a severity per window, over all services."""
    error_share = measure(
        "error_share", F.round(rates.ratio(F.col("_errors"), F.col("_events")), 4), "_errors", "_events"
    )
    measures = (
        events(),
        measure("error_count", F.col("_errors"), "_errors"),
        average_latency(),
        error_share,
    )
    return windowed(logs, [], windowing, measures).withColumn(
        "severity",
        F.when(F.col("error_share") > thresholds.critical_error_rate, "CRITICAL")
        .when(F.col("error_share") > thresholds.error_rate, "HIGH")
        .when(F.col("avg_response_time_ms") > thresholds.latency_ms, "MEDIUM")
        .otherwise("NORMAL"),
    )


def distinct_windows(logs: DataFrame, windowing: Windowing = MINUTE_BY_TEN) -> DataFrame:
    """Number of different windows that hold at least one row."""
    return windowed(logs, [], windowing, [events()]).agg(F.count(F.lit(1)).alias("window_count"))
