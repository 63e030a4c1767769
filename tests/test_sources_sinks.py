"""Readers, writers, the generator and the batch job."""

from __future__ import annotations

import json
import time
from datetime import datetime
from types import SimpleNamespace

import pytest
from helpers import START, as_dicts, frame, log
from pyspark.sql import functions as F

from logtide.__main__ import arguments, main
from logtide.operators import rules
from logtide.plans.batch import batch_report, paced_batches, run_batch
from logtide.schema import EXPORT_COLUMNS, LOG_FIELDS
from logtide.settings import Settings
from logtide.session import scratch_dir, use_utc
from logtide.sinks import files as sinks
from logtide.sinks import kafka as kafka_sinks
from logtide.sources import files, kafka, synthetic


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


RECORD = {
    "timestamp": "2026-04-30T14:10:03.679781", "service": "s", "host": "h", "log_level": "INFO", "message": "m",
    "request_id": "r", "response_time_ms": 62, "status_code": 200,
}


def test_read_logs_is_permissive(spark, tmp_path):
    lines = [json.dumps(RECORD | {"extra": 1}), json.dumps(RECORD | {"status_code": "401"}), "not json"]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    rows = as_dicts(files.read_logs(spark, str(tmp_path)))
    assert len(rows) == 3 and set(rows[0]) == set(LOG_FIELDS)
    assert rows[0]["timestamp"] == datetime(2026, 4, 30, 14, 10, 3, 679781)
    assert rows[1]["status_code"] is None and rows[1]["host"] == "h"
    assert all(value is None for value in rows[2].values())


def test_bad_lines_are_quarantined(spark, tmp_path):
    lines = [json.dumps(RECORD), "", "  ", "{broken", json.dumps({"service": "s"})]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    good, bad = files.split_lines(files.read_lines(spark, str(tmp_path)))
    assert [r["response_time_ms"] for r in as_dicts(good)] == [62.0]
    assert sorted(len(r["missing_fields"]) for r in as_dicts(bad)) == [7, 8]


def test_missing_file_has_no_lines(spark, tmp_path):
    absent = str(tmp_path / "absent")
    assert files.read_lines(spark, absent).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_lines(spark, absent, missing_ok=False)


def test_paths_are_file_system_uris(spark, tmp_path):
    uri = f"file://{tmp_path}/logs"
    sinks.write_jsonl(frame(spark, [log(1)]).select(*LOG_FIELDS), uri)
    assert files.read_logs(spark, uri).count() == files.read_lines(spark, uri).where("is_valid").count() == 1


def test_jsonl_overwrites_and_appends(spark, tmp_path):
    logs = frame(spark, [log(1, 0.123456, message=None)]).select(*LOG_FIELDS)
    path = str(tmp_path / "logs")
    sinks.write_jsonl(logs, path)
    sinks.write_jsonl(logs, path, append=True)
    text = [line for p in (tmp_path / "logs").glob("*.json") for line in p.read_text().splitlines()]
    assert len(text) == 2 and json.loads(text[0])["message"] is None
    assert json.loads(text[0])["timestamp"] == "2026-04-30T14:10:00.123456"
    sinks.write_jsonl(logs, path)
    assert files.read_logs(spark, path).count() == 1


def test_landed_parquet_prunes_and_pushes(spark, tmp_path):
    rows = [log(i, i * 1800, "a" if i % 3 else "b", status=500 if i % 4 == 0 else 200) for i in range(8)]
    rows.append(log(99, None))
    path = str(tmp_path / "landed")
    sinks.land_logs(frame(spark, rows), path)
    assert files.read_landed_logs(spark, path).count() == 9
    some = files.read_landed_logs(spark, path, "timestamp_hour = '2026-04-30-16' AND service = 'a' AND is_error")
    assert {r["event_id"] for r in as_dicts(some)} == {4}
    plan = plan_of(some)
    assert "EqualTo(is_error,true)" in plan or "IsNotNull(is_error)" in plan
    assert "PartitionFilters: [isnotnull(timestamp_hour" in plan


def test_kafka_values(spark):
    logs = frame(spark, [log(1, 1.5), log(2, 2, service=None, status=None)]).select(*LOG_FIELDS)
    values = kafka_sinks.as_values(logs)
    assert values.columns == ["value"]
    assert json.loads(values.collect()[1][0])["service"] is None
    messages = values.select(
        F.lit("raw-logs").alias("topic"), F.lit(2).alias("partition"),
        F.monotonically_increasing_id().alias("offset"), F.col("value").cast("binary").alias("value"),
    )
    parsed = kafka.parse_values(messages, kafka.META)
    assert parsed.columns == [*kafka.META, *LOG_FIELDS]
    shown = as_dicts(kafka.display_rows(parsed))
    assert {r["time"] for r in shown} == {"14:10:01.500", "14:10:02.000"}
    absent = next(r for r in shown if r["time"] == "14:10:02.000")
    assert absent["service"] == "N/A" and absent["status_code"] == "N/A"


def test_offsets_of_the_first_messages():
    assert kafka.plan_offsets({}, {}, 5) == {}
    assert kafka.plan_offsets({0: 7, 1: 0}, {0: 7, 1: 0}, 5) == {0: (7, 7), 1: (0, 0)}  # empty
    assert kafka.plan_offsets({0: 7, 1: 2}, {0: 9, 1: 3}, 5) == {0: (7, 9), 1: (2, 3)}  # short
    # One partition holds nearly all; the ones after it are not opened.
    assert kafka.plan_offsets({2: 0, 0: 4, 1: 10}, {0: 5, 1: 10**9, 2: 8}, 20) == {0: (4, 5), 1: (10, 29), 2: (0, 0)}
    assert kafka.plan_offsets({0: 3}, {0: 9}, 0) == {0: (3, 3)}
    assert kafka.offsets_json("t", {1: (2, 3), 0: (7, 9)}) == ('{"t": {"0": 7, "1": 2}}', '{"t": {"0": 9, "1": 3}}')


@pytest.mark.parametrize("n", [0, 1, 4, 9, 50])
def test_first_messages_over_gaps(spark, n):
    """Compacted partitions: most offsets hold nothing, yet the first ``n`` messages come whole."""
    held = [(0, i) for i in (3, 400, 401)] + [(2, i) for i in (0, 1, 90, 5000, 9000)]
    topic = spark.createDataFrame(held, "partition INT, offset LONG")
    first, last = {0: 0, 1: 5, 2: 0}, {0: 402, 1: 5, 2: 10_000}
    opened = []

    def read(ranges):
        opened.append(sum(b - a for a, b in ranges.values()))
        inside = " OR ".join(f"partition = {p} AND offset >= {a} AND offset < {b}" for p, (a, b) in ranges.items())
        return topic.where(inside)

    found = [tuple(r) for r in kafka.first_messages(first, last, n, read).collect()]
    assert found == sorted(held)[:n]
    assert opened[0] <= n and len(opened) < 15


def test_kafka_wiring_needs_the_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_topic(spark, "localhost:9092", "raw-logs")
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.stream_topic(spark, "localhost:9092", "raw-logs")


@pytest.mark.parametrize("profile", [synthetic.STANDARD, synthetic.COMPACT])
def test_generator_distribution(spark, profile):
    n = 20000
    logs = synthetic.generate_logs(spark, n, "2026-04-30 14:10:00", profile=profile).persist()
    share = {r["log_level"]: r["count"] / n for r in as_dicts(logs.groupBy("log_level").count())}
    status = {r["status_code"]: r["count"] / n for r in as_dicts(logs.groupBy("status_code").count())}
    normal, odd = 1 - profile.anomaly_share, profile.anomaly_share
    assert share["INFO"] == pytest.approx(0.6 * normal, abs=0.02)
    assert share["DEBUG"] == pytest.approx(0.3 * normal, abs=0.02)
    critical = sum(k.weight for k in profile.errors if k.levels == ("CRITICAL",))
    assert share["CRITICAL"] == pytest.approx(critical * odd, abs=0.01)
    slow = profile.errors[0]
    assert status[200] == pytest.approx(profile.success_weights[0] * normal + slow.weight * odd, abs=0.02)
    late = logs.where("response_time_ms >= 3000").agg(
        F.count(F.lit(1)).alias("n"), F.min("response_time_ms").alias("lo"), F.max("response_time_ms").alias("hi")
    ).collect()[0]
    assert late.n / n == pytest.approx(slow.weight * odd, abs=0.01)
    assert slow.latency[0] <= late.lo and late.hi <= slow.latency[1]
    assert logs.select("request_id").distinct().count() == n
    edges = logs.agg(F.min("timestamp"), F.max("timestamp")).collect()[0]
    assert edges[0] == START and (edges[1] - START).total_seconds() == pytest.approx(60, abs=0.01)
    for name, options in (("service", profile.services), ("host", profile.hosts)):
        counts = {r[name]: r["count"] / n for r in as_dicts(logs.groupBy(name).count())}
        assert set(counts) == set(options) and all(c == pytest.approx(0.2, abs=0.02) for c in counts.values())
    logs.unpersist()


def test_generator_ignores_partitioning(spark):
    numbers = spark.range(200)
    at = F.lit("2026-01-01").cast("timestamp")
    one = synthetic.as_records(numbers.coalesce(1), "id", at)
    many = synthetic.as_records(numbers.repartition(7), "id", at)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    other = synthetic.as_records(numbers, "id", at, seed=1)
    assert sorted(map(str, one.collect())) != sorted(map(str, other.collect()))


def test_synthetic_stream_has_the_log_columns(spark):
    rows = synthetic.stream_synthetic(spark, batch_size=50, delay_ms=100, n=10)
    assert rows.isStreaming and rows.columns == list(LOG_FIELDS)


def test_batch_job(spark, tmp_path, capsys):
    source, output = str(tmp_path / "logs"), str(tmp_path / "out")
    rows = [log(i, i * 10, "ab"[i % 2], status=503 if i % 4 == 0 else 200, latency=-1.0) for i in range(12)]
    sinks.write_jsonl(frame(spark, rows).select(*LOG_FIELDS), source)
    exported = run_batch(spark, source, output)
    assert tuple(exported.columns) == EXPORT_COLUMNS
    found = as_dicts(exported)
    assert sum(r["event_count"] for r in found) == 3 and {r["service"] for r in found} == {"a"}
    assert all(r["error_rate"] == 2.0 and r["is_anomaly"] for r in found)
    assert all(r["min_response_time_ms"] == 0.0 for r in found), "negative latency is cleaned first"
    shown = capsys.readouterr().out
    assert "|12           |3          |0.25      |" in shown and "HIGH_ERROR_RATE" in shown
    report = batch_report(files.read_logs(spark, source))
    assert report.alerts.count() == report.anomalies.count() == len(found)


def test_command_line(spark, tmp_path):
    logs, out = str(tmp_path / "logs"), str(tmp_path / "out")
    main(["generate", logs, "--records", "300"])
    assert spark.read.json(logs).count() == 300
    main(["batch", logs, out])
    assert spark.read.option("header", True).csv(f"{out}/service_metrics").count() > 0
    with pytest.raises(SystemExit):
        arguments().parse_args(["stream"])


def test_scratch_folder_comes_from_the_session(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_tail_from_the_table_of_services(spark, tmp_path):
    """The newest folders alone are read, after an appended landing too; a log without the table gives the same rows."""
    path = str(tmp_path / "landed")
    rows = [log(i, i * 900.0, "ab"[i % 2]) for i in range(40)] + [log(99, None, "a")]
    sinks.land_logs(frame(spark, rows), path)
    sinks.land_logs(frame(spark, [log(200 + i, 40000.0 + i, "c") for i in range(3)]), path, mode="append")
    spans = {r["service"]: (r["first"] - START, r["newest"] - START) for r in files.read_landed_services(spark, path).collect()}
    assert {s: (a.total_seconds(), b.total_seconds()) for s, (a, b) in spans.items()} == {
        "a": (0, 38 * 900), "b": (900, 39 * 900), "c": (40000, 40002)
    }
    tail = files.read_landed_tail(spark, path, 7200)
    wanted = {i for i in range(40) if i * 900 > 40002 - 7200} | {200, 201, 202}
    assert {r["event_id"] for r in tail.collect()} == wanted
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert ">= 2026-04-30-23)" in plan.split("PartitionFilters: [")[1].split("]")[0]
    (tmp_path / "landed-services").rename(tmp_path / "apart")
    assert files.read_landed_services(spark, path) is None
    assert {r["event_id"] for r in files.read_landed_tail(spark, path, 7200).collect()} == wanted


def test_active_alerts_of_a_tail(spark, tmp_path):
    """A service that began a long ago, a young one and one that rests, against the whole log."""
    path = str(tmp_path / "landed")
    rows = [log(i, i * 40.0, "old", "ERROR" if i % 3 else "INFO", 500 if i % 3 else 200) for i in range(400)]
    rows += [log(1000 + i, 15000.0 + i * 20, "young", "ERROR", 500) for i in range(48)] + [log(2000, 5.0, "rests", "ERROR", 500)]
    logs = frame(spark, rows)
    sinks.land_logs(logs, path)
    tail = files.read_landed_tail(spark, path, rules.reach_s(rules.LOG_RULES))
    assert tail.count() < logs.count()
    (found,) = rules.active_alerts_of_tail(tail, files.read_landed_services(spark, path)).collect()
    (whole,) = rules.active_alerts(logs).collect()
    assert found.active_alerts == whole.active_alerts > 0


def test_landed_names_stay_text_and_the_tail_reads_new_folders(spark, tmp_path):
    path = str(tmp_path / "landed")
    sinks.land_logs(frame(spark, [log(i, i * 3600.0, "007") for i in range(20)]), path)
    found = files.read_landed_logs(spark, path)
    assert {r["service"] for r in found.select("service").collect()} == {"007"}
    assert dict(found.dtypes)["timestamp_hour"] == "string"
    tail = files.read_landed_tail(spark, path, 2 * 3600)
    assert tail.count() == 2
    tail.collect()
    assert len(tail.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(timestamp_hour" in tail._jdf.queryExecution().toString()


def test_session_setting_stays(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        with pytest.raises(ValueError):
            use_utc(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    cluster = SimpleNamespace(conf={"x": 1}, sparkContext=SimpleNamespace(master="spark://h:7077"))
    with pytest.raises(ValueError):
        scratch_dir(cluster, "x")
    cluster.conf = {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert scratch_dir(cluster, "x").startswith("hdfs:///shared/x-")


def test_jobs_follow_the_settings(spark, tmp_path):
    source, config = str(tmp_path / "logs"), tmp_path / "app.json"
    rows = [log(i, i * 10.0, "a", "INFO", 200, "kaputt") for i in range(60)]
    sinks.write_jsonl(frame(spark, rows).select(*LOG_FIELDS), source)
    own = {"processing": {"error_keywords": ["kaputt"]}, "alerting": {"consecutive_errors_threshold": 7}}
    config.write_text(json.dumps(own))
    counts = {}
    for job in ("rules", "runs", "spikes", "land"):
        for name, extra in (("plain", []), ("own", ["--config", str(config)])):
            out = str(tmp_path / f"{job}-{name}")
            main([job, source, out, *extra])
            if job == "land":
                counts[job, name] = files.read_landed_logs(spark, out, "is_error").count()
            else:
                counts[job, name] = len(spark.read.text(out).collect())
    assert counts["runs", "plain"] == 0 and counts["runs", "own"] == 1
    assert counts["rules", "plain"] == 0 < counts["rules", "own"]
    assert counts["land", "plain"] == 0 and counts["land", "own"] == 60
    config.write_text(json.dumps({**own, "alerting": {"consecutive_errors_threshold": 61}}))
    main(["runs", source, str(tmp_path / "long"), "--config", str(config)])
    assert spark.read.text(str(tmp_path / "long")).count() == 0


def test_alert_limit_from_settings():
    limits = Settings.from_config({"alerting": {"high_error_rate_threshold": 0.15}}).thresholds
    assert limits.alert_error_rate == 0.15 and Settings().thresholds.alert_error_rate is None


def test_bounded_producer_is_paced_and_fresh(spark):
    began = time.monotonic()
    first = [b.select("request_id").collect() for b in paced_batches(spark, 25, 10, 200)]
    assert time.monotonic() - began >= 0.4 and [len(b) for b in first] == [10, 10, 5]
    ids = {r[0] for b in first for r in b}
    again = {r[0] for b in paced_batches(spark, 25, 10, 0) for r in b.select("request_id").collect()}
    assert len(ids) == 25 and not ids & again
    seeded = [{r[0] for b in paced_batches(spark, 5, 5, 0, seed=1) for r in b.select("request_id").collect()} for _ in range(2)]
    assert seeded[0] == seeded[1]
