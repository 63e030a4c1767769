"""Registered queries: name -> callable(spark, folder) -> DataFrame.

Each reads the supplied tables whole. Nested results are flattened so that a SQL
engine can be asked the same question (``plans.oracles``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from datetime import datetime, timedelta
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators import anomalies, cleaning, errors, joins, ranking, rules, runs, summaries, windows
from ..schema import LOG_FIELDS
from ..session import scratch_dir
from ..settings import LIVE_THRESHOLDS, MINUTE, MINUTE_BY_TEN, Settings, Windowing
from ..sinks import files as file_sinks
from ..sinks import kafka as kafka_sinks
from ..sources import event_table as tables
from ..sources import files as file_sources
from ..sources import kafka as kafka_sources
from ..sources.synthetic import as_records
from ..streaming import compaction, enriched, fanout, late, live, progress
from ..streaming import runs as live_runs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOUR = Windowing(3600)
HOUR_BY_TEN = Windowing(3600, 600)
LOG_COLUMNS = ("event_id", *LOG_FIELDS)

# The supplied events are minutes apart, so rules run on hours instead of seconds.
HOURLY = {"step_s": 3600, "lookback_s": 5 * 3600, "hold_s": 2 * 3600}
SHORTEST_RUN = 3


def query(of: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Register a query over the log view of ``events`` under its function name."""
    QUERIES[of.__name__] = lambda spark, folder: of(tables.logs_from(spark, folder))
    return of


def table_query(of: Query) -> Query:
    """Register a query that opens its own tables."""
    QUERIES[of.__name__] = of
    return of


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_table(spark, folder, "events")


def joined(array: str | Column) -> Column:
    return F.array_join(array, ",")


# ---------------------------------------------------------------- cleaning


@query
def logs_adapter(logs):
    return logs


@table_query
def parsed_timestamps(spark, folder):
    text = tables.as_dirty_text(events_of(spark, folder)).select("event_id", "timestamp")
    return cleaning.parse_timestamps(text).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def typed_dirty(spark, folder):
    """The malformed records as a typed reader delivers them: bad values are null."""
    return (
        tables.as_dirty_text(events_of(spark, folder))
        .transform(cleaning.parse_timestamps)
        .withColumns(
            {
                "timestamp": F.col("timestamp").cast("timestamp_ntz"),
                "response_time_ms": F.col("response_time_ms").try_cast("double"),
                "status_code": F.col("status_code").try_cast("bigint"),
            }
        )
    )


@table_query
def null_required_fields(spark, folder):
    columns = ("timestamp", "log_level", "message", "response_time_ms", "status_code")
    flagged = cleaning.null_fields(typed_dirty(spark, folder), columns)
    return flagged.select("event_id", joined("null_fields").alias("null_fields"), "is_complete")


@table_query
def clean_logs(spark, folder):
    return cleaning.clean_logs(typed_dirty(spark, folder))


@table_query
def clean_strict(spark, folder):
    return cleaning.clean_text_logs(tables.as_dirty_text(events_of(spark, folder)))


@table_query
def quality_flags(spark, folder):
    return cleaning.quality_flags(typed_dirty(spark, folder)).select(
        "event_id", "status_in_range", "latency_in_range", "has_timestamp"
    )


@table_query
def integer_normalized(spark, folder):
    raw = events_of(spark, folder).select(
        "event_id",
        (F.col("value") * 50).alias("response_time_ms"),
        (F.lit(200.0) + F.pmod("event_id", F.lit(300))).alias("status_code"),
    )
    return cleaning.integer_normalize(raw)


@table_query
def validated_raw(spark, folder):
    parsed = tables.as_raw_lines(events_of(spark, folder)).transform(cleaning.parse_checked)
    return parsed.select("event_id", joined("missing_fields").alias("missing_fields"), "is_valid", "service", "status_code")


# ---------------------------------------------------------------- classification


@query
def error_flag_record(logs):
    return errors.flag_records(logs).select("event_id", "is_error_event")


@query
def record_anomalies(logs):
    return errors.record_anomalies(logs).select(
        "event_id", joined("reasons").alias("reasons"), "severity", "is_anomaly"
    )


@query
def record_alerts(logs):
    return errors.record_alerts(logs, keep=["event_id"]).select(
        "event_id", "alert_type", "severity", "service", "host", joined("reasons").alias("reasons"), "relevant_fields.*"
    )


@query
def feature_flags(logs):
    return cleaning.add_features(logs).select(
        "event_id", "is_error", "is_high_latency", "is_server_error", "is_client_error"
    )


@query
def filter_errors(logs):
    return errors.filter_errors(logs).select(*LOG_COLUMNS)


@query
def filter_errors_flagged(logs):
    return errors.filter_errors_flagged(cleaning.add_features(logs)).select("event_id", "is_error", "message")


@query
def filter_reduction(logs):
    return errors.filter_reduction(logs)


# ---------------------------------------------------------------- windows


@query
def service_metrics_tumbling(logs):
    return windows.service_metrics(errors.filter_errors(logs), MINUTE)


@query
def service_metrics_hourly(logs):
    return windows.service_metrics(errors.filter_errors(logs), HOUR)


@query
def service_metrics_disjoint(logs):
    return windows.service_metrics(errors.filter_errors(logs), HOUR, rate="disjoint")


@query
def host_metrics(logs):
    return windows.host_metrics(errors.filter_errors(logs), HOUR)


@query
def status_metrics(logs):
    found = windows.status_metrics(logs, HOUR)
    return found.withColumn("affected_services", windows.tally_text("affected_services"))


@query
def service_metrics_sliding(logs):
    return windows.service_metrics(errors.filter_errors(logs), MINUTE_BY_TEN)


@query
def service_metrics_sliding_hour(logs):
    return windows.service_metrics(errors.filter_errors(logs), HOUR_BY_TEN)


@query
def level_metrics_sliding(logs):
    return windows.level_metrics(logs, HOUR_BY_TEN).withColumn("services", windows.tally_text("services"))


@query
def server_rate_sliding(logs):
    return windows.server_rate_metrics(errors.filter_errors(logs), HOUR_BY_TEN)


@query
def distinct_windows(logs):
    return windows.distinct_windows(errors.filter_errors(logs), MINUTE_BY_TEN)


@query
def error_timeseries(logs):
    return windows.error_timeseries(logs, HOUR)


# ---------------------------------------------------------------- summaries


@query
def overall_error_rate(logs):
    return summaries.overall_error_rate(logs)


@query
def metrics_summary(logs, sketch=None):
    found = summaries.metrics_summary(logs, sketch)
    return found.withColumn("stdev_response_time_ms", F.round("stdev_response_time_ms", 4))


@query
def dimension_counts(logs):
    return summaries.dimension_counts(logs)


@table_query
def null_report(spark, folder):
    return summaries.null_report(typed_dirty(spark, folder))


@query
def feature_summary(logs):
    return summaries.feature_summary(cleaning.add_features(logs))


@query
def errors_by_level(logs):
    return summaries.errors_by_level(errors.filter_errors(logs))


@query
def service_profile(logs):
    return summaries.service_profile(logs)


@query
def service_share(logs):
    return summaries.service_share(logs)


@query
def overall_stats(logs):
    return summaries.overall_stats(logs)


@query
def latency_histogram(logs):
    return summaries.latency_histogram(logs).select("bin", "n")


def hourly_server_anomalies(logs):
    metrics = windows.server_rate_metrics(errors.filter_errors(logs), HOUR_BY_TEN)
    return anomalies.strict_anomalies(metrics)


@query
def alert_metrics(logs):
    total = logs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return anomalies.alert_metrics(hourly_server_anomalies(logs), total)


def disjoint_hours(logs):
    """Hourly metrics of all events, so that anomalous and normal windows both occur."""
    return windows.service_metrics(logs, HOUR, rate="disjoint")


@query
def anomaly_breakdown(logs):
    found = anomalies.live_anomalies(anomalies.window_anomalies(disjoint_hours(logs)))
    return anomalies.anomaly_breakdown(found)


# ---------------------------------------------------------------- anomalies and alerts


@query
def window_anomalies(logs):
    metrics = windows.service_metrics(errors.filter_errors(logs), MINUTE)
    return anomalies.window_anomalies(metrics).where("is_anomaly")


@query
def window_anomalies_all_events(logs):
    return anomalies.window_anomalies(disjoint_hours(logs))


@query
def service_metrics_export(logs):
    metrics = windows.service_metrics(errors.filter_errors(logs), MINUTE)
    return anomalies.export_view(anomalies.window_anomalies(metrics), clock=False)


@query
def live_anomalies(logs):
    metrics = windows.service_metrics(errors.filter_errors(logs), MINUTE_BY_TEN)
    return anomalies.live_view(anomalies.live_anomalies(metrics))


@query
def notebook_anomalies(logs):
    return hourly_server_anomalies(logs)


@query
def first_anomalies(logs):
    return anomalies.first_anomalies(hourly_server_anomalies(logs), 5)


@query
def window_alerts(logs):
    metrics = windows.service_metrics(errors.filter_errors(logs), MINUTE)
    return anomalies.window_alerts(anomalies.window_anomalies(metrics), clock=False)


@query
def window_alerts_limited(logs):
    found = anomalies.window_anomalies(disjoint_hours(logs))
    return anomalies.window_alerts(found, min_error_rate=fv.ERROR_RATE_LIVE, clock=False)


@query
def spikes(logs):
    return rules.spikes(logs, pane_s=3600, history=12)


@query
def consecutive_errors(logs):
    return runs.consecutive_errors(logs, SHORTEST_RUN)


@query
def critical_latency(logs):
    return errors.critical_latency(logs).select("event_id", "timestamp", "service", "response_time_ms")


@query
def ranked_alerts(logs):
    found = anomalies.live_anomalies(disjoint_hours(logs), LIVE_THRESHOLDS).where("is_anomaly")
    ranked = anomalies.rank_alerts(found)
    return ranked.select(
        "severity_rank", "anomaly_severity", "window_start", "service", "error_rate", "avg_response_time_ms"
    )


# ---------------------------------------------------------------- rules and panels


def hourly_rule(rule: rules.Rule) -> Callable[[DataFrame], DataFrame]:
    return lambda logs: rules.evaluate_rule(logs, rule.scaled(**HOURLY))


RULE_QUERIES = {
    "rule_high_error_rate": rules.HIGH_ERROR_RATE,
    "rule_critical_rate": rules.CRITICAL_ERROR_RATE,
    "rule_high_latency": replace(rules.HIGH_RESPONSE_TIME, threshold=2500),
    "rule_error_spike": rules.CONSECUTIVE_ERROR_SPIKE,
    "rule_degraded": rules.SERVICE_DEGRADED,
}
for _name, _rule in RULE_QUERIES.items():
    QUERIES[_name] = (
        lambda spark, folder, evaluate=hourly_rule(_rule): evaluate(tables.logs_from(spark, folder))
    )


@query
def all_rules(logs):
    return rules.evaluate_rules(logs, [rule.scaled(**HOURLY) for rule in rules.LOG_RULES])


@query
def last_hour_events(logs):
    return rules.recent_events(logs)


@query
def error_rate_series(logs):
    return rules.error_rate_series(logs, HOURLY["step_s"], HOURLY["lookback_s"])


@query
def latency_series(logs):
    return rules.latency_series(logs, HOURLY["step_s"], HOURLY["lookback_s"], limit=2500)


@query
def top_error_services(logs):
    return ranking.top_failing_services(errors.filter_errors(logs), 5).select("service", "error_count")


@query
def active_alerts(logs):
    return rules.active_alerts(logs, [rule.scaled(**HOURLY) for rule in rules.LOG_RULES])


def landed_days(spark: SparkSession, folder: str) -> str:
    """The log landed by day (the supplied events are minutes apart)."""
    path = scratch_dir(spark, "landed")
    file_sinks.land_logs(tables.logs_from(spark, folder), path, unit="day")
    return path


@table_query
def last_hour_landed(spark, folder):
    tail = file_sources.read_landed_tail(spark, landed_days(spark, folder), 3600, unit="day")
    return tail.agg(F.count(F.lit(1)).alias("event_count"))


@table_query
def active_alerts_landed(spark, folder):
    path = landed_days(spark, folder)
    hourly = [rule.scaled(**HOURLY) for rule in rules.LOG_RULES]
    tail = file_sources.read_landed_tail(spark, path, rules.reach_s(hourly), unit="day")
    return rules.active_alerts_of_tail(tail, file_sources.read_landed_services(spark, path), hourly)


@table_query
def metrics_summary_landed(spark, folder):
    """From the sketches that landing keeps and the values near the median."""
    path = landed_days(spark, folder)
    return metrics_summary(file_sources.read_landed_logs(spark, path), file_sources.read_landed_sketch(spark, path))


def delay_samples(logs):
    """Hourly peak latency per service, standing in for the delay of a query's triggers."""
    hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz")
    samples = logs.groupBy(F.col("service").alias("query"), hour.alias("at")).agg(F.max("response_time_ms").alias("delay_ms"))
    return samples.withColumn("batch_id", F.lit(0))


@query
def lag_alerts(logs):
    """Over 5000 ms for two hours or more."""
    return progress.lag_alerts(delay_samples(logs), limit_ms=fv.PROCESSING_LAG_WARN_MS, hold_s=7200)


@query
def latency_gauge(logs):
    return progress.latency_gauge(delay_samples(logs))


# ---------------------------------------------------------------- records with gaps


def gappy_logs(spark: SparkSession, folder: str) -> DataFrame:
    """The log view with null times, services, hosts, levels, codes, messages and latencies (all
    of them null in every sixth hour), and levels in lower case."""

    def without(name: str, condition: Column) -> Column:
        return F.when(~condition, F.col(name))

    def every(n: int) -> Column:
        return F.col("event_id") % n == 0

    level = F.when(every(7), F.lower("log_level")).otherwise(F.col("log_level"))
    return tables.logs_from(spark, folder).withColumns(
        {
            "timestamp": without("timestamp", every(19)),
            "service": without("service", every(23)),
            "host": without("host", every(29)),
            "log_level": F.when(~every(41), level),
            "message": without("message", every(31)),
            "response_time_ms": without("response_time_ms", every(11) | (F.hour("timestamp") % 6 == 0)),
            "status_code": without("status_code", every(17)),
        }
    )


def gappy_query(name: str, of: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: of(gappy_logs(spark, folder))


gappy_query("error_flag_dirty", error_flag_record)
gappy_query("record_anomalies_dirty", record_anomalies)
gappy_query("record_alerts_dirty", record_alerts)
gappy_query("filter_errors_dirty", filter_errors)
gappy_query("metrics_summary_dirty", metrics_summary)
gappy_query("dimension_counts_dirty", dimension_counts)
gappy_query("window_anomalies_dirty", window_anomalies_all_events)


@query
def keywords_override(logs):
    """Runs and windows of errors under another keyword list."""
    own = ["timeout", "Retry"]
    found = runs.consecutive_errors(logs, SHORTEST_RUN, keywords=own)
    kept = errors.filter_errors(logs, own).groupBy("service").agg(F.count(F.lit(1)).alias("error_count"))
    return found.groupBy("service").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("run_length").alias("errors_in_runs")
    ).join(kept, "service")


# ---------------------------------------------------------------- joins, top-k


@query
def totals_join(logs):
    return joins.join_totals(logs)


@table_query
def registry_join(spark, folder):
    logs = tables.logs_from(spark, folder)
    metrics = windows.service_metrics(errors.filter_errors(logs), HOUR)
    return joins.enrich(metrics, tables.registry(spark, folder)).select(
        "window_start", "service", "event_count", "error_rate", "owner_region", "nation_count"
    )


@query
def top_failing(logs):
    return ranking.top_failing_services(errors.filter_errors(logs), 5)


@query
def top3_profile(logs):
    return ranking.top_profiles(summaries.service_profile(logs), 3)


@query
def first_windows(logs):
    return ranking.first_windows(windows.server_rate_metrics(errors.filter_errors(logs), MINUTE_BY_TEN), 10)


# ---------------------------------------------------------------- sources and sinks


@table_query
def generated_logs(spark, folder):
    """One synthetic record per event, numbered by its id."""
    return as_records(events_of(spark, folder), "event_id", F.col("ts"), seed=42)


@query
def kafka_payload_roundtrip(logs):
    encoded = kafka_sinks.as_values(logs.select(*LOG_FIELDS)).select(F.col("value").cast("binary").alias("value"))
    return unzoned(kafka_sources.parse_values(encoded))


def unzoned(logs: DataFrame) -> DataFrame:
    return logs.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@table_query
def jsonl_roundtrip(spark, folder):
    path = scratch_dir(spark, "jsonl")
    file_sinks.write_jsonl(tables.logs_from(spark, folder).select(*LOG_FIELDS), path)
    return unzoned(file_sources.read_logs(spark, path))


@table_query
def parquet_roundtrip(spark, folder):
    """Land the logs, then read the errors back through the stored flag.

    The supplied events are minutes apart, so the folders are days instead of hours.
    """
    path = scratch_dir(spark, "landed")
    file_sinks.land_logs(tables.logs_from(spark, folder), path, unit="day")
    return file_sources.read_landed_logs(spark, path, "is_error").select(
        *LOG_COLUMNS, "timestamp_day"
    )


@table_query
def csv_roundtrip(spark, folder):
    path = scratch_dir(spark, "csv")
    metrics = windows.service_metrics(errors.filter_errors(tables.logs_from(spark, folder)), MINUTE)
    export = anomalies.export_view(anomalies.window_anomalies(metrics), clock=False)
    file_sinks.write_csv(export, path)
    return spark.read.option("header", True).schema(export.schema).csv(path)


@query
def display_messages(logs):
    """The first messages of a topic of three partitions, as shown to a reader."""
    placed = logs.withColumns({"partition": (F.col("event_id") % 3).cast("int"), "offset": F.floor(F.col("event_id") / 3)})
    ends = placed.groupBy("partition").agg(F.min("offset"), F.max("offset") + 1).collect()  # a line per partition
    first, last = ({r[0]: r[side] for r in ends} for side in (1, 2))

    def read(ranges):
        inside = (F.expr(f"partition = {p} AND offset >= {a} AND offset < {b}") for p, (a, b) in ranges.items())
        return placed.where(reduce(or_, inside, F.lit(False)))

    return kafka_sources.display_rows(kafka_sources.first_messages(first, last, 50, read))


@table_query
def lines_roundtrip(spark, folder):
    """Lines of which some are no JSON and some lack fields: logs and quarantine, with what is missing."""
    path = scratch_dir(spark, "lines")
    logs = tables.logs_from(spark, folder)
    part, i = F.to_json(F.struct("service", "host")), F.col("event_id")
    line = F.when(i % 9 == 0, "not json").when(i % 10 == 0, part).when(i % 21 == 0, "  ").otherwise(F.to_json(F.struct(*LOG_FIELDS)))
    logs.select(line.alias("value")).write.text(path)
    good, bad = file_sources.split_lines(file_sources.read_lines(spark, path))
    return good.select("request_id", "service", "status_code", F.lit("").alias("missing")).unionByName(
        bad.select(F.array_join("missing_fields", ",").alias("missing")), allowMissingColumns=True
    )


# ---------------------------------------------------------------- streams


LIVE = Settings(thresholds=LIVE_THRESHOLDS)
LIVE_DDL = (
    "window_start TIMESTAMP, window_end TIMESTAMP, service STRING, event_count BIGINT, "
    "avg_response_ms DOUBLE, error_rate DOUBLE, anomaly_severity STRING, is_anomaly BOOLEAN"
)
RUN_DDL = (
    "service STRING, run_start TIMESTAMP_NTZ, run_end TIMESTAMP_NTZ, first_id BIGINT, last_id BIGINT, "
    "run_length BIGINT, is_open BOOLEAN"
)
WINDOW_KEYS = ("window_start", "window_end", "service")


def stream_of_events(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table as a stream of log records."""
    # As a glob the table may be one file or a folder of files.
    path = f"{folder}/{{events}}.parquet"
    schema = tables.read_table(spark, folder, "events").schema
    return tables.as_logs(spark.readStream.schema(schema).parquet(path))


def newest_windows(spark: SparkSession, path: str, schema: str = LIVE_DDL) -> DataFrame:
    rows = fanout.latest_rows(spark, path, schema, WINDOW_KEYS)
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})


@table_query
def stream_service_metrics(spark, folder):
    path = scratch_dir(spark, "live")
    logs = stream_of_events(spark, folder)
    fanout.start_live(logs, fanout.parquet_sink(f"{path}/rows"), f"{path}/checkpoint", LIVE, trigger=None).awaitTermination()
    return newest_windows(spark, f"{path}/rows")


@table_query
def stream_pane_metrics(spark, folder):
    """Sliding windows from panes on a stream: those that the watermark has passed, each once.

    The engine filters before it looks at the times, so the watermark follows the error events.
    """
    path = scratch_dir(spark, "panes")
    logs = stream_of_events(spark, folder)
    fanout.start_live(
        logs, fanout.parquet_sink(f"{path}/rows"), f"{path}/checkpoint", LIVE, mode="append", trigger=None
    ).awaitTermination()
    return newest_windows(spark, f"{path}/rows")


@table_query
def stream_registry_join(spark, folder):
    """Hourly metrics of a stream with the registry, which each batch opens anew."""
    path = scratch_dir(spark, "enriched")
    logs = live.watermarked(stream_of_events(spark, folder), LIVE.watermark)
    metrics = windows.service_metrics(errors.filter_errors(logs), HOUR).select("window_start", "service", "event_count", "error_rate")
    enriched.start_enriched(
        metrics, lambda: tables.registry(spark, folder), fanout.parquet_sink(f"{path}/rows"), f"{path}/checkpoint", trigger=None
    ).awaitTermination()
    schema = "window_start TIMESTAMP, service STRING, event_count BIGINT, error_rate DOUBLE, owner_region STRING, nation_count BIGINT"
    rows = fanout.latest_rows(spark, f"{path}/rows", schema, ("window_start", "service"))
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@table_query
def stream_late_rows(spark, folder):
    """Six parts of the time one after the other, every 50th event three parts late: which rows come
    after their hour was closed, and in which batch. The stream is restarted for each part."""
    path = scratch_dir(spark, "late")
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    logs = tables.logs_from(spark, folder)
    first, last = logs.agg(F.min(at), F.max(at)).first()
    part = F.floor((at - F.lit(first)) * 6 / F.lit((last or 0) - (first or 0) + 1)) if first is not None else F.lit(0)
    late_by = F.when(F.col("event_id") % 50 == 0, 3).otherwise(0)
    sliced = logs.withColumn("part", F.least(part + late_by, F.lit(5)).cast("int"))
    for n in range(6):
        sliced.where(F.col("part") == n).drop("part").write.parquet(f"{path}/in/{n}")
        stream = spark.readStream.schema(logs.schema).parquet(f"{path}/in/*")
        late.start_late_rows(stream, f"{path}/out", f"{path}/checkpoint", timedelta(hours=1), HOUR, trigger=None).awaitTermination()
    rows = spark.read.schema("event_id BIGINT, service STRING, timestamp TIMESTAMP_NTZ, batch INT").parquet(f"{path}/out/rows")
    return rows.select("event_id", "service", "timestamp", F.col("batch").alias("batch"))


@table_query
def stream_json_restart(spark, folder):
    """JSON files through the file source: half of them, then a restart from the checkpoint."""
    path = scratch_dir(spark, "json")
    logs = tables.logs_from(spark, folder)
    first, last = logs.agg(F.min("timestamp"), F.max("timestamp")).first()
    middle = F.lit(first + (last - first) / 2 if first else datetime(1970, 1, 1))
    for n, half in enumerate((F.col("timestamp") < middle, F.col("timestamp") >= middle)):
        file_sinks.write_jsonl(logs.where(half).select(*LOG_FIELDS).coalesce(1), f"{path}/in/{n}")
        stream = file_sources.stream_logs(spark, f"{path}/in/*")
        fanout.start_live(stream, fanout.parquet_sink(f"{path}/rows"), f"{path}/checkpoint", LIVE, trigger=None).awaitTermination()
    return newest_windows(spark, f"{path}/rows")


@table_query
def stream_compacted_metrics(spark, folder):
    """Three parts of the time one after the other, each a restart; what they wrote is merged after every second batch."""
    path = scratch_dir(spark, "compacted")
    logs = tables.logs_from(spark, folder)
    first, last = logs.agg(F.min("timestamp"), F.max("timestamp")).first()
    first, last = (first, last) if first else (datetime(1970, 1, 1),) * 2
    share = (last - first) / 3 + timedelta(seconds=1)
    # By day: the supplied events are minutes apart.
    sink = compaction.compacting_sink(f"{path}/rows", WINDOW_KEYS, every=2, unit="day")
    for n in range(3):
        span = (F.col("timestamp") >= F.lit(first + n * share)) & (F.col("timestamp") < F.lit(first + (n + 1) * share))
        logs.where(span).write.parquet(f"{path}/in/{n}")
        stream = spark.readStream.schema(logs.schema).parquet(f"{path}/in/*")
        fanout.start_live(stream, sink, f"{path}/checkpoint", LIVE, trigger=None).awaitTermination()
    rows = compaction.latest_updates(spark, f"{path}/rows", LIVE_DDL, WINDOW_KEYS)
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})


@table_query
def stream_alerts(spark, folder):
    path = scratch_dir(spark, "alerts")
    sink = fanout.fan_out(fanout.parquet_sink(f"{path}/metrics"), fanout.parquet_sink(f"{path}/alerts"))
    fanout.start_live(stream_of_events(spark, folder), sink, f"{path}/checkpoint", LIVE, trigger=None).awaitTermination()
    return newest_windows(spark, f"{path}/alerts", f"{LIVE_DDL}, source STRING")


RUN_DELAY = timedelta(days=1)


def arriving(spark: SparkSession, folder: str, path: str, slices: int = 6) -> Iterator[DataFrame]:
    """The ``events`` table as it would arrive: in ``slices`` parts, each row up to a day late.

    The table is written once, by all tasks. One part after the other is moved into the watched
    folder, and the stream over that folder comes out after each.
    """
    logs = tables.logs_from(spark, folder)
    late_by = F.make_dt_interval(hours=F.pmod(F.col("event_id") * 7, F.lit(24)).cast("int"))
    timed = logs.withColumn("arrived", F.col("timestamp") + late_by).where("arrived IS NOT NULL")
    first, last = timed.agg(F.min("arrived"), F.max("arrived")).first()
    if first is None:
        first = last = datetime(1970, 1, 1)
    share = (last - first) / slices + timedelta(seconds=1)
    begun = ((F.col("arrived") >= F.lit(first + n * share)).cast("int") for n in range(1, slices))
    staged = timed.withColumn("slice", reduce(add, begun, F.lit(0))).drop("arrived")
    staged.write.partitionBy("slice").parquet(f"{path}/staged")
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place(f"{path}/in"))
    for n in range(slices):
        part = place(f"{path}/staged/slice={n}")
        if not files.exists(part):  # no row of the table
            logs.limit(0).write.parquet(f"{path}/in/slice={n}")
        elif not files.rename(part, place(f"{path}/in/slice={n}")):
            raise OSError(f"{path}: slice {n} could not be moved")
        yield spark.readStream.schema(logs.schema).parquet(f"{path}/in/slice=*")


@table_query
def stream_error_runs(spark, folder):
    """Runs up to a day before the newest event, over six batches out of order, each after a restart."""
    path = scratch_dir(spark, "runs")
    for logs in arriving(spark, folder, f"{path}/arrivals"):
        live_runs.start_runs(
            logs, f"{path}/runs", f"{path}/carry", f"{path}/checkpoint", SHORTEST_RUN, trigger=None, delay=RUN_DELAY
        ).awaitTermination()
    return fanout.latest_rows(spark, f"{path}/runs", RUN_DDL, ("service", "first_id"))
