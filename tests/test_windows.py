"""Window metrics, anomalies, summaries and rankings on small inputs."""

from __future__ import annotations

import random

import pytest
from helpers import START, as_dicts, frame, log

from logtide.operators import anomalies, errors, joins, ranking, summaries, windows
from logtide.operators.quantiles import exact_percentiles
from logtide.settings import Settings, Thresholds, Windowing


@pytest.fixture(scope="module")
def noisy(spark):
    """Random rows with gaps, equal timestamps, nulls and one service with most of the rows."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        service = rng.choice(["hot"] * 6 + ["a", "b", None])
        at = None if rng.random() < 0.03 else float(rng.choice([rng.randrange(900), rng.randrange(30)]))
        latency = None if rng.random() < 0.05 else float(rng.randrange(9000))
        status = rng.choice([200, 200, 204, 404, 500, 503, None])
        rows.append(log(i, at, service, rng.choice(["INFO", "ERROR", "CRITICAL"]), status, "m", latency))
    return frame(spark, rows).repartition(5)


def ordered(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("span", [(60, 10), (60, 20), (90, 30)])
def test_panes_equal_direct_windows(noisy, span):
    windowing = Windowing(*span)
    rolled = windows.service_metrics(noisy, windowing)
    direct = windows.service_metrics(noisy, windowing, panes=False)
    assert rolled.columns == direct.columns
    assert ordered(rolled) == ordered(direct)


def test_slide_that_does_not_divide_falls_back(noisy):
    assert windows.service_metrics(noisy, Windowing(50, 20)).count() > 0
    with pytest.raises(ValueError):
        Windowing(10, 20)


def test_service_metrics_by_hand(spark):
    rows = frame(
        spark,
        [
            log(1, 1, status=500, latency=100.0),
            log(2, 59.9, status=404, latency=300.0),
            log(3, 60, status=200, latency=None),
            log(4, None, status=500),
        ],
    )
    first, second = sorted(as_dicts(windows.service_metrics(rows)), key=lambda r: r["window_start"])
    assert first["window_start"] == START and first["event_count"] == 2
    assert (first["server_error_count"], first["client_error_count"]) == (1, 2)
    assert first["error_rate"] == 1.5
    assert (first["avg_response_time_ms"], first["max_response_time_ms"], first["min_response_time_ms"]) == (
        200.0, 300.0, 100.0
    )
    assert second["avg_response_time_ms"] is None and second["error_rate"] == 0.0
    fixed = {r["window_start"]: r["error_rate"] for r in as_dicts(windows.service_metrics(rows, rate="disjoint"))}
    assert fixed[START] == 1.0


def test_sample_alerts(spark):
    """Published result of the sample log: four service windows of ten error events."""
    sample = {
        "user-service": ([500, 404], [1423.0, 242.0]),
        "notification-service": ([404], [118.0]),
        "api-gateway": ([400, 401, 422], [223.0, 67.0, 183.0]),
        "auth-service": ([500, 503, 403, 404], [1951.0, 188.0, 300.0, 289.0]),
    }
    rows, i = [], 0
    for service, (codes, latencies) in sample.items():
        for code, latency in zip(codes, latencies):
            i += 1
            rows.append(log(i, i, service, "ERROR" if code >= 500 else "WARNING", code, "m", latency))
    found = anomalies.window_anomalies(windows.service_metrics(errors.filter_errors(frame(spark, rows))))
    by_service = {r["service"]: r for r in as_dicts(found)}
    assert {s: r["error_rate"] for s, r in by_service.items()} == {
        "user-service": 1.5, "notification-service": 1.0, "api-gateway": 1.0, "auth-service": 1.5
    }
    assert {s: r["event_count"] for s, r in by_service.items()} == {
        "user-service": 2, "notification-service": 1, "api-gateway": 3, "auth-service": 4
    }
    assert by_service["user-service"]["avg_response_time_ms"] == 832.5
    assert by_service["auth-service"]["avg_response_time_ms"] == 682.0
    assert by_service["api-gateway"]["avg_response_time_ms"] == pytest.approx(157.66666666666666, abs=1e-12)
    assert {r["anomaly_type"] for r in by_service.values()} == {"HIGH_ERROR_RATE"}
    top = as_dicts(ranking.top_failing_services(frame(spark, rows)))
    assert [r["service"] for r in top] == ["auth-service", "api-gateway", "user-service", "notification-service"]


def test_host_metrics_do_not_count_fatal(spark):
    rows = frame(spark, [log(1, level="FATAL"), log(2, level="ERROR"), log(3, level="CRITICAL"), log(4)])
    assert as_dicts(windows.host_metrics(rows))[0]["critical_events"] == 2


def test_status_tally_is_the_whole_multiset(spark):
    rows = frame(spark, [log(i, i, s) for i, s in enumerate(["b", "a", "b", None, "b"])])
    found = windows.status_metrics(rows)
    row = as_dicts(found.withColumn("plain", windows.expand_services("affected_services")))[0]
    assert row["occurrence_count"] == 5 and row["service_count"] == 4 and row["distinct_services"] == 2
    assert row["affected_services"] == [{"service": "a", "n": 1}, {"service": "b", "n": 3}]
    assert row["plain"] == ["a", "b", "b", "b"]


METRIC_DDL = "window_start TIMESTAMP, window_end TIMESTAMP, service STRING, event_count BIGINT, " \
    "avg_response_time_ms DOUBLE, error_rate DOUBLE"


@pytest.fixture(scope="module")
def metric_rows(spark):
    cases = [
        ("at", 100.0, 0.1), ("over", 100.0, 0.31), ("both", 6000.0, 1.0), ("slow", 6000.0, 0.0),
        ("unknown-bad", None, 1.0), ("unknown-good", None, 0.0), ("edge", 5000.0, 0.0),
    ]
    return spark.createDataFrame([(START, START, s, 1, ms, rate) for s, ms, rate in cases], METRIC_DDL)


def test_window_anomalies(metric_rows):
    found = {r["service"]: r for r in as_dicts(anomalies.window_anomalies(metric_rows))}
    assert [found[s]["is_anomaly"] for s in ("at", "over", "both", "slow", "unknown-bad", "unknown-good", "edge")] == [
        False, True, True, True, True, None, False
    ]
    assert [found[s]["anomaly_type"] for s in ("both", "slow", "over", "unknown-good")] == [
        "LATENCY_AND_ERRORS", "HIGH_LATENCY", "HIGH_ERROR_RATE", "NORMAL"
    ]
    alerts = as_dicts(anomalies.window_alerts(anomalies.window_anomalies(metric_rows)))
    assert {a["service"] for a in alerts} == {"over", "both", "slow", "unknown-bad"}
    assert all(a["source"] == "AUTOMATED_ALERT" and a["alert_generated_time"] for a in alerts)
    limited = anomalies.window_alerts(anomalies.window_anomalies(metric_rows), min_error_rate=0.5)
    assert {a["service"] for a in as_dicts(limited)} == {"both", "unknown-bad"}


def test_live_severity(metric_rows):
    found = {r["service"]: r for r in as_dicts(anomalies.live_anomalies(metric_rows, Thresholds(error_rate=0.5)))}
    assert found["over"]["anomaly_severity"] == "CRITICAL" and found["over"]["is_anomaly"] is False
    assert found["slow"]["anomaly_severity"] == "MEDIUM" and found["at"]["anomaly_severity"] == "LOW"
    ranked = anomalies.rank_alerts(anomalies.live_anomalies(metric_rows)).collect()
    assert [r.severity_rank for r in ranked] == sorted(r.severity_rank for r in ranked)


def test_strict_anomalies_have_no_unknowns(metric_rows):
    found = anomalies.strict_anomalies(metric_rows, latency="avg_response_time_ms")
    rows = {r["service"]: r for r in as_dicts(found)}
    assert set(rows) == {"over", "both", "slow", "unknown-bad"}
    assert rows["unknown-bad"]["high_latency"] is False


def test_summary_of_one_and_of_none(spark):
    one = as_dicts(summaries.metrics_summary(frame(spark, [log(1, level="error", latency=None)])))[0]
    assert (one["error_count"], one["stdev_response_time_ms"], one["median_response_time_ms"]) == (1, 0.0, 0.0)
    none = as_dicts(summaries.metrics_summary(frame(spark, [])))[0]
    assert none["total_records"] == 0 and none["error_rate"] == 0.0
    assert as_dicts(summaries.overall_error_rate(frame(spark, [])))[0]["error_rate"] == 0.0


def test_dimension_defaults(spark):
    rows = frame(spark, [log(1, service=None, status=None), log(2)])
    counts = {(r["dimension"], r["value"]): r["n"] for r in as_dicts(summaries.dimension_counts(rows))}
    assert counts[("service", "unknown")] == 1 and counts[("status_code", "0")] == 1 and counts[("total", "all")] == 2
    only = {r["dimension"] for r in as_dicts(summaries.dimension_counts(rows, ["host"]))}
    assert only == {"host", "total"}


def test_histogram_of_equal_values(spark):
    rows = frame(spark, [log(i, latency=100.0) for i in range(4)])
    bins = {r["bin"]: r["n"] for r in as_dicts(summaries.latency_histogram(rows, bins=10))}
    assert len(bins) == 10 and sum(bins.values()) == 4 and bins[6] == 4


def test_percentiles_by_brute_force(spark):
    import numpy as np

    rng = random.Random(3)
    values = [0.0, 0.0, -5.0, -1e9, 1e12, 1e-9] + [round(rng.lognormvariate(6, 2), 3) for _ in range(500)]
    values += [250.0] * 400
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x DOUBLE").repartition(6)
    fractions = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    found = {r["fraction"]: r["value"] for r in as_dicts(exact_percentiles(df, "x", fractions))}
    for fraction in fractions:
        assert found[fraction] == pytest.approx(float(np.quantile(values, fraction)), rel=1e-12), fraction
    assert exact_percentiles(df.limit(0), "x", [0.5]).count() == 0


@pytest.mark.parametrize("low, width", [(1e9, 1e4), (0.0001, 0.0001), (-7.0, 1e-9)])
def test_percentiles_of_a_narrow_range(spark, low, width):
    """All values in one or two log buckets: they are cut again until a part is small."""
    import numpy as np

    rng = random.Random(4)
    values = [low + width * rng.random() for _ in range(3000)] + [low + width / 2] * 200
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE").repartition(6)
    found = {r["fraction"]: r["value"] for r in as_dicts(exact_percentiles(df, "x", [0.1, 0.5, 0.95], part_rows=20))}
    for fraction, value in found.items():
        assert value == pytest.approx(float(np.quantile(values, fraction)), rel=1e-12)


def test_profiles_and_totals(spark):
    rows = frame(
        spark, [log(1, status=500), log(2), log(3, service="b", status=404), log(4, service="c"), log(5, service="b")]
    )
    profile = summaries.service_profile(rows)
    found = {r["service"]: r for r in as_dicts(profile)}
    assert set(found) == {"auth-service", "b"} and found["auth-service"]["error_rate"] == 1.0
    assert [r["service"] for r in as_dicts(ranking.top_profiles(profile, 1))] == ["auth-service"]
    totals = {r["service"]: (r["event_count"], r["total_events"]) for r in as_dicts(joins.join_totals(rows))}
    assert totals == {"auth-service": (1, 2), "b": (1, 2)}
    registry = spark.createDataFrame([("b", "team")], "service STRING, owner STRING")
    owners = {r["service"]: r["owner"] for r in as_dicts(joins.enrich(profile, registry))}
    assert owners == {"auth-service": None, "b": "team"}


def test_settings_from_config():
    config = {
        "spark": {"streaming": {"window_duration_seconds": 120, "slide_duration_seconds": 30}},
        "processing": {
            "error_keywords": ["boom"],
            "anomaly_detection": {"error_rate_threshold": 0.2},
            "aggregation": {"by_host": False},
        },
        "alerting": {"consecutive_errors_threshold": 7},
    }
    read = Settings.from_config(config)
    assert read.live_window == Windowing(120, 30) and read.keywords == ("boom",)
    assert read.thresholds.error_rate == 0.2 and read.thresholds.consecutive_errors == 7
    assert read.dimensions == ("service", "log_level", "status_code")
    assert Settings.from_config({}) == Settings()


# The latencies of the published sample of 100 records, in ascending order.
SAMPLE_LATENCIES = [
    62, 66, 67, 85, 87, 99, 105, 117, 118, 120, 120, 125, 131, 135, 158, 159, 165, 167, 178, 182,
    183, 184, 185, 185, 186, 188, 191, 194, 202, 205, 208, 209, 212, 219, 223, 229, 233, 239, 242, 242,
    243, 246, 249, 260, 265, 266, 269, 275, 276, 279, 286, 292, 300, 305, 308, 308, 314, 321, 326, 326,
    327, 329, 329, 331, 336, 339, 341, 345, 358, 360, 361, 363, 368, 377, 377, 390, 390, 391, 406, 417,
    429, 443, 448, 451, 465, 487, 489, 490, 490, 496, 498, 499, 499, 500, 1423, 1951, 3333, 4988, 6853, 7345,
]


def test_published_totals(spark):
    """Totals published for the sample, on rows made to have its latencies, levels and errors."""
    levels = ["ERROR"] * 3 + ["WARNING"] * 19 + ["DEBUG"] * 32 + ["INFO"] * 46
    failing = [("auth-service", 500)] * 2 + [("auth-service", 404)] * 2 + [("api-gateway", 404)] * 3
    failing += [("user-service", 500), ("user-service", 404), ("notification-service", 404)]
    rows = []
    for i, (level, latency) in enumerate(zip(levels, SAMPLE_LATENCIES)):
        service, status = failing[i] if i < 10 else ("payment-service", 200)
        rows.append(log(i, i * 0.5, service, level, status, latency=float(latency)))
    logs = frame(spark, rows)
    (found,) = as_dicts(summaries.metrics_summary(logs))
    assert found["mean_response_time_ms"] == pytest.approx(521.31, abs=1e-9)
    assert found["median_response_time_ms"] == 282.5 and found["max_response_time_ms"] == 7345.0
    assert found["stdev_response_time_ms"] == pytest.approx(1120.2112237241583, abs=1e-9)
    assert found["total_records"] == 100 and found["error_count"] == 3 and found["warning_count"] == 19
    counts = {(r["dimension"], r["value"]): r["n"] for r in as_dicts(summaries.dimension_counts(logs))}
    assert [counts["log_level", name] for name in ("INFO", "DEBUG", "WARNING", "ERROR")] == [46, 32, 19, 3]
    (overall,) = as_dicts(summaries.overall_error_rate(logs))
    assert overall["error_count"] == 10 and overall["error_rate"] == 0.1
    metrics = as_dicts(windows.service_metrics(errors.filter_errors(logs), Windowing(60)))
    rates = {r["service"]: (r["event_count"], r["error_rate"]) for r in metrics}
    assert rates == {
        "auth-service": (4, 1.5),
        "api-gateway": (3, 1.0),
        "user-service": (2, 1.5),
        "notification-service": (1, 1.0),
    }
