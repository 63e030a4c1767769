"""Streams against the batch operators, restart, late rows, several outputs."""

from __future__ import annotations

import random
import time
from datetime import timedelta

import pytest
from helpers import START, as_dicts, frame, log
from pyspark.sql import functions as F

from logtide.operators import anomalies, errors, windows
from logtide.operators.runs import consecutive_errors
from logtide.plans.catalog import LIVE_DDL, QUERIES, RUN_DDL, WINDOW_KEYS, arriving
from logtide.schema import LOG_FIELDS
from logtide.settings import LIVE_THRESHOLDS, MINUTE_BY_TEN, Settings
from logtide.sinks.files import land_stream, write_jsonl
from logtide.sources import event_table as tables
from logtide.sources import files
from logtide.sources.synthetic import stream_synthetic
from logtide.streaming import fanout, live, progress
from logtide.streaming.runs import start_runs

SETTINGS = Settings(thresholds=LIVE_THRESHOLDS, watermark="30 seconds")


def some_logs(n=240, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bad = rng.random() < 0.5
        rows.append(
            log(i, i * 2.0, rng.choice("aaab"), "ERROR" if bad else "INFO", 503 if bad else 200, "m", float(rng.randrange(9000)))
        )
    return rows


def add_file(spark, rows, folder, n):
    """One more file for the watcher, newer than those before."""
    part = frame(spark, rows).select(*LOG_FIELDS).coalesce(1)
    write_jsonl(part, f"{folder}/part-{n:03d}")


def feed(spark, folder, rows, files_n=4):
    size = len(rows) // files_n
    for n in range(files_n):
        add_file(spark, rows[n * size : (n + 1) * size if n < files_n - 1 else len(rows)], folder, n)


def watch(spark, folder, **options):
    return files.stream_logs(spark, f"{folder}/*", **options)


def comparable(df):
    names = ("window_start", "window_end")
    return sorted(map(str, df.withColumns({n: F.col(n).cast("string") for n in names}).collect()))


def expected_view(logs):
    metrics = windows.service_metrics(errors.filter_errors(logs), MINUTE_BY_TEN)
    return anomalies.live_view(anomalies.live_anomalies(metrics, LIVE_THRESHOLDS))


def drain(spark, folder, out, sink=None, mode="update"):
    query = fanout.start_live(
        watch(spark, folder), sink or fanout.parquet_sink(f"{out}/rows"), f"{out}/checkpoint", SETTINGS, mode, trigger=None
    )
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = some_logs()
    feed(spark, source, rows[:120], 2)
    first = drain(spark, source, out)
    assert first.lastProgress.batchId >= 1, "one file per micro-batch"
    add_file(spark, rows[120:], source, 9)
    second = drain(spark, source, out)
    assert sum(p.numInputRows for p in second.recentProgress) == 120, "a restart reads only what is new"
    found = fanout.latest_rows(spark, f"{out}/rows", LIVE_DDL, WINDOW_KEYS)
    assert comparable(found) == comparable(expected_view(frame(spark, rows)))


def test_append_mode_closes_windows_behind_the_watermark(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = some_logs(60)
    sentinel = [log(1000, 4000.0, "z", "ERROR", 500)]
    feed(spark, source, rows, 2)
    add_file(spark, sentinel, source, 8)
    add_file(spark, [log(1001, 4001.0, "z", "ERROR", 500)], source, 9)
    drain(spark, source, out, mode="append")
    found = spark.read.schema(LIVE_DDL).parquet(f"{out}/rows").where("service <> 'z'").drop("batch")
    assert comparable(found) == comparable(expected_view(frame(spark, rows)))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, at in enumerate((0.0, 5000.0, 5001.0, 1.0)):
        add_file(spark, [log(n, at, "a", "ERROR", 500)], source, n)
    with progress.ProgressLog(spark, f"{out}/progress") as kept:
        query = drain(spark, source, out)
        assert kept.wait_for(query)
    late = progress.progress_rows(spark, f"{out}/progress").agg(F.sum("late_rows")).collect()[0][0]
    assert late == 6, "the late row belongs to six sliding windows"
    found = fanout.latest_rows(spark, f"{out}/rows", LIVE_DDL, WINDOW_KEYS)
    assert found.agg(F.sum("event_count")).collect()[0][0] == 18


def test_console(spark, tmp_path):
    source = str(tmp_path / "in")
    feed(spark, source, some_logs(60), 1)
    query = live.start_console(watch(spark, source), str(tmp_path / "cp"), "update", SETTINGS, trigger=None)
    query.awaitTermination()
    assert "console" in query.lastProgress.sink.description.lower()
    assert sum(p.numInputRows for p in query.recentProgress) == 60


def test_fan_out_and_repeated_batch(spark, tmp_path):
    out = str(tmp_path)
    sink = fanout.fan_out(fanout.parquet_sink(f"{out}/metrics"), fanout.parquet_sink(f"{out}/alerts"))
    view = expected_view(frame(spark, some_logs(80)))
    sink(view, 0)
    sink(view, 0)
    metrics = spark.read.parquet(f"{out}/metrics")
    alerts = spark.read.parquet(f"{out}/alerts")
    assert metrics.count() == view.count()
    assert 0 < alerts.count() == view.where("is_anomaly").count()
    assert {r["source"] for r in as_dicts(alerts)} == {"AUTOMATED_ALERT"}


@pytest.mark.parametrize("files_n", [1, 7])
def test_runs_carry_over_batches(spark, tmp_path, files_n):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng = random.Random(files_n)
    rows = []
    for i in range(210):
        bad = rng.random() < 0.85
        rows.append(log(i, float(i), rng.choice("aaab"), "ERROR" if bad else "INFO", 500 if bad else 200))
    # A service that rests for some batches keeps its open run.
    rows += [log(900 + i, float(i), "rare", "ERROR", 500) for i in range(2)]
    rows += [log(950 + i, 300.0 + i, "rare", "ERROR", 500) for i in range(2)]
    rows.sort(key=lambda r: r[1])
    feed(spark, source, rows, files_n)
    stream = watch(spark, source).withColumn("event_id", F.regexp_extract("request_id", "[0-9]+", 0).cast("bigint"))
    stream = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    start_runs(stream, f"{out}/runs", f"{out}/carry", f"{out}/cp", 4, trigger=None).awaitTermination()
    found = fanout.latest_rows(spark, f"{out}/runs", RUN_DDL, ("service", "first_id")).drop("is_open")
    names = ("service", "run_start", "run_end", "first_id", "last_id", "run_length")
    expected = consecutive_errors(frame(spark, rows), 4)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(map(tuple, expected.select(*names).collect()))
    assert any(r.service == "rare" for r in expected.collect())


def run_batches(spark, tmp_path, batches, shortest=2, delay=0):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, rows in enumerate(batches):
        add_file(spark, rows, source, n)
    stream = watch(spark, source).withColumn("event_id", F.regexp_extract("request_id", "[0-9]+", 0).cast("bigint"))
    stream = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    start_runs(
        stream, f"{out}/runs", f"{out}/carry", f"{out}/cp", shortest, trigger=None, delay=timedelta(seconds=delay)
    ).awaitTermination()
    found = as_dicts(fanout.latest_rows(spark, f"{out}/runs", RUN_DDL, ("service", "first_id")))
    late = spark.read.parquet(f"{out}/runs-late").agg(F.sum("late_rows")).first()[0]
    return {(r["service"], r["first_id"], r["last_id"], r["run_length"], r["is_open"]) for r in found}, late


def bad(i, at=None, service="a"):
    return log(i, float(i if at is None else at), service, "ERROR", 500)


def test_runs_close_when_a_good_row_ends_them(spark, tmp_path):
    found, late = run_batches(spark, tmp_path, [[bad(1), bad(2)], [log(3, 3.0, "a")], [bad(4), bad(5)]])
    assert found == {("a", 1, 2, 2, False), ("a", 4, 5, 2, True)} and late == 0


def test_runs_over_batches_out_of_order(spark, tmp_path):
    found, late = run_batches(spark, tmp_path, [[bad(5), bad(6), bad(7)], [bad(1), bad(2), log(3, 3.0, "a")], [log(40, 40.0, "a")]], delay=20)
    assert found == {("a", 1, 2, 2, False), ("a", 5, 7, 3, True)} and late == 0


def test_runs_count_late_rows(spark, tmp_path):
    found, late = run_batches(spark, tmp_path, [[bad(10), bad(11)], [bad(1)], [bad(12)]])
    assert found == {("a", 10, 12, 3, True)} and late == 1


def test_runs_keep_null_apart_from_its_name(spark, tmp_path):
    rows = [[bad(1, 1, None), bad(2, 2, "unknown")], [bad(3, 3, None), bad(4, 4, "unknown")]]
    found, _ = run_batches(spark, tmp_path, rows)
    assert found == {(None, 1, 3, 2, True), ("unknown", 2, 4, 2, True)}


def events_in_files(spark, folder, days, n=400, files_n=4):
    """An ``events`` table in ``files_n`` files, one event an hour on average over the ``days`` given."""
    at = F.element_at(F.array(*(F.lit(d) for d in days)), (F.col("id") % len(days) + 1).cast("int"))
    seconds = at * 86400 + F.col("id") * 137 % 86400
    spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 50 != 7, F.timestamp_seconds(1704067200 + seconds).cast("timestamp_ntz")).alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.when(F.col("id") % 3 > 0, "error").otherwise("view").alias("event_type"),
        (F.col("id") % 90).cast("double").alias("value"),
    ).repartition(files_n).write.parquet(f"{folder}/events.parquet")


def test_arrivals_are_written_by_all_tasks(spark, tmp_path):
    events_in_files(spark, str(tmp_path), range(30))
    stored = spark.read.parquet(f"{tmp_path}/events.parquet")
    arrived = F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") * 7 % 24).cast("int"))
    seen, newest = 0, None
    for n, _ in enumerate(arriving(spark, str(tmp_path), str(tmp_path / "arrivals"))):
        parts = sorted((tmp_path / "arrivals/in").glob("slice=*"))
        assert len(parts) == n + 1, "a part is there only when it has arrived"
        assert len(list(parts[-1].glob("*.parquet"))) > 1, "not one task and one file"
        part = spark.read.parquet(str(parts[-1])).join(stored, "event_id").agg(F.min(arrived), F.max(arrived), F.count("*")).first()
        assert newest is None or part[0] > newest
        seen, newest = seen + part[2], part[1]
    assert n == 5 and seen == stored.where("ts IS NOT NULL").count()


@pytest.mark.parametrize("days, n", [((0, 29), 400), (range(30), 0)])
def test_arrivals_with_gaps_and_none(spark, tmp_path, days, n):
    events_in_files(spark, str(tmp_path), days, n)
    found = QUERIES["stream_error_runs"](spark, str(tmp_path))
    logs = tables.logs_from(spark, str(tmp_path)).cache()
    newest = logs.agg(F.max("timestamp")).first()[0]
    passed = logs.where(F.col("timestamp") <= F.lit(newest and newest - timedelta(days=1)))
    names = ("service", "run_start", "run_end", "first_id", "last_id", "run_length")
    expected = consecutive_errors(passed, 3).select(*names).collect()
    assert sorted(found.select(*names).collect()) == sorted(expected) and bool(expected) == bool(n)


def test_progress_keeps_more_triggers_than_spark(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = frame(spark, [log(i, float(i)) for i in range(2000)]).select(*LOG_FIELDS)
    write_jsonl(rows.repartition(105), source)
    with progress.ProgressLog(spark, f"{out}/progress") as kept:
        query = (
            files.stream_logs(spark, source).writeStream.format("noop").option("checkpointLocation", f"{out}/cp")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert kept.wait_for(query)
    table = progress.progress_rows(spark, f"{out}/progress")
    assert table.where("input_rows > 0").count() > 100 and table.agg(F.sum("input_rows")).first()[0] == 2000


def test_lag_alerts_and_gauge(spark):
    delays = [1000, 12000, 13000, 14000, 15000, 2000, 20000]
    rows = [("live", i, (START + timedelta(seconds=60 * i)).isoformat(), float(d), 10, 0) for i, d in enumerate(delays)]
    table = spark.createDataFrame(rows, progress.PROGRESS_DDL).withColumn("at", F.try_to_timestamp("at"))
    (alert,) = as_dicts(progress.lag_alerts(table))
    assert alert["rule"] == "StreamingProcessingLag"
    assert (alert["run_end"] - alert["run_start"]).total_seconds() == 180
    (gauge,) = as_dicts(progress.latency_gauge(table))
    assert gauge["delay_ms"] == 20000 and gauge["gauge_pct"] == 100.0 and gauge["above_mark"]


def test_landed_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "landed")
    rows = some_logs(60)
    feed(spark, source, rows, 2)
    land_stream(watch(spark, source), out, str(tmp_path / "cp"), trigger=None).awaitTermination()
    found = files.read_landed_logs(spark, out, "timestamp_hour = '2026-04-30-14'")
    assert found.count() == 60
    assert found.where("is_error").count() == errors.filter_errors(frame(spark, rows)).count()


def test_synthetic_stream_runs(spark, tmp_path):
    rows = stream_synthetic(spark, batch_size=20, delay_ms=100, n=30)
    query = (
        rows.writeStream.format("parquet")
        .option("path", str(tmp_path / "rows"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    deadline = time.time() + 60
    while time.time() < deadline and sum(p.numInputRows for p in query.recentProgress) < 30:
        time.sleep(0.5)
    query.stop()
    found = spark.read.parquet(str(tmp_path / "rows"))
    assert found.count() == 30 and found.where("service IS NULL OR status_code IS NULL").count() == 0
