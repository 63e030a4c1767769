"""Edge rows of the filters, flags, anomalies and cleaning."""

from __future__ import annotations

import pytest
from helpers import as_dicts, frame, log
from pyspark.sql import functions as F

from logtide.functions import records
from logtide.operators import cleaning, errors
from logtide.settings import Thresholds

# id, level, status, message, latency, kept by the filter, error event of a record
EDGES = [
    (1, "INFO", 200, "ok", 100.0, False, False),
    (2, "error", 200, "ok", 100.0, False, True),
    (3, "INFO", None, "ok", 100.0, False, False),
    (4, "INFO", 200, None, 100.0, False, False),
    (5, "FATAL", 200, "ok", 100.0, True, True),
    (6, "INFO", 399, "ok", 100.0, False, False),
    (7, "INFO", 400, "ok", 100.0, True, True),
    (8, "INFO", 499, "ok", 100.0, True, True),
    (9, "INFO", 500, "ok", 100.0, True, True),
    (10, "INFO", 200, "Retry FAILED", 100.0, True, True),
    (11, "INFO", 200, "terror drill", 100.0, True, True),
    (12, "WARNING", 200, "slow", 7345.0, False, False),
    (13, "ERROR", 500, "x", 12000.0, True, True),
    (14, "INFO", 200, "ok", 5000.0, False, False),
    (15, "INFO", None, "an Exception", 100.0, True, True),
    (16, None, None, None, None, False, False),
]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [log(i, i, level=lv, status=st, message=m, latency=ms) for i, lv, st, m, ms, _, _ in EDGES]
    return frame(spark, rows)


def test_filter_and_record_flag(edges):
    kept = {r["event_id"] for r in as_dicts(errors.filter_errors(edges))}
    assert kept == {e[0] for e in EDGES if e[5]}
    flags = {r["event_id"]: r["is_error_event"] for r in as_dicts(errors.flag_records(edges))}
    assert flags == {e[0]: e[6] for e in EDGES}


def test_flagged_filter_keeps_the_same_rows(edges):
    flagged = errors.filter_errors_flagged(cleaning.add_features(edges))
    assert {r["event_id"] for r in as_dicts(flagged)} == {e[0] for e in EDGES if e[5]}


def test_keywords_are_literal_and_replaceable(spark):
    rows = frame(spark, [log(1, message="a.b"), log(2, message="axb"), log(3, message="ERROR")])
    assert [r["event_id"] for r in as_dicts(errors.filter_errors(rows, ["A.B"]))] == [1]
    assert as_dicts(errors.filter_errors(rows, [])) == []


def test_feature_flags(edges):
    flags = {r["event_id"]: r for r in as_dicts(cleaning.add_features(edges))}
    assert [flags[i]["is_client_error"] for i in (6, 7, 8, 9)] == [0, 1, 1, 0]
    assert [flags[i]["is_server_error"] for i in (6, 7, 8, 9)] == [0, 0, 0, 1]
    assert flags[14]["is_high_latency"] == 0 and flags[12]["is_high_latency"] == 1
    assert flags[10]["is_error"] == 0, "the message is not looked at"
    assert all(flags[16][n] == 0 for n in ("is_error", "is_high_latency", "is_server_error", "is_client_error"))


def test_record_anomalies(edges):
    found = {r["event_id"]: r for r in as_dicts(errors.record_anomalies(edges))}
    assert found[12]["reasons"] == ["HIGH_RESPONSE_TIME"] and found[12]["severity"] == "NORMAL"
    assert found[12]["is_anomaly"]
    assert found[13]["reasons"] == ["HIGH_RESPONSE_TIME", "ERROR_EVENT", "SERVER_ERROR"]
    assert found[13]["severity"] == "CRITICAL"
    assert found[7]["severity"] == "HIGH"
    assert found[16]["reasons"] == [] and not found[16]["is_anomaly"]
    low = {r["event_id"]: r for r in as_dicts(errors.record_anomalies(edges, Thresholds(latency_ms=50)))}
    assert low[1]["reasons"] == ["HIGH_RESPONSE_TIME"]


def test_record_alerts_are_nested(edges):
    alerts = as_dicts(errors.record_alerts(edges, keep=["event_id"]))
    assert {a["event_id"] for a in alerts} == {e[0] for e in EDGES if e[6]} | {12}
    alert = next(a for a in alerts if a["event_id"] == 13)
    assert alert["alert_type"] == "LOG_ANOMALY" and alert["timestamp"] is not None
    assert alert["relevant_fields"] == {
        "log_level": "ERROR", "status_code": 500, "response_time_ms": 12000.0, "message": "x"
    }


def test_reduction_of_an_empty_log(edges):
    row = as_dicts(errors.filter_reduction(edges))[0]
    assert (row["total_count"], row["error_count"]) == (16, 8)
    assert row["reduction_pct"] == 50.0
    assert as_dicts(errors.filter_reduction(edges.limit(0)))[0]["reduction_pct"] is None


def test_clean_logs(spark):
    rows = frame(spark, [log(1, status=-1, latency=-5.0), log(2, status=None, latency=None), log(3)])
    found = {r["event_id"]: (r["response_time_ms"], r["status_code"]) for r in as_dicts(cleaning.clean_logs(rows))}
    assert found == {1: (0.0, 0), 2: (None, None), 3: (100.0, 200)}


def test_clean_text(spark):
    text = [
        ("info", " 12.5 ", " 401 ", "\t hello \n"),
        ("Error", "n/a", "12.7", "  "),
        ("ERROR", None, None, None),
        ("x", "1e3", "+7", " a b "),
        ("x", "1d", "0x10", "a"),
        ("x", "-3", "-1", "a"),
    ]
    names = "log_level STRING, response_time_ms STRING, status_code STRING, message STRING"
    found = cleaning.clean_text_logs(spark.createDataFrame(text, names))
    assert dict(found.dtypes) == {
        "log_level": "string", "response_time_ms": "double", "status_code": "bigint", "message": "string"
    }
    assert [tuple(r) for r in found.collect()] == [
        ("INFO", 12.5, 401, "hello"),
        ("ERROR", 0.0, 0, ""),
        ("ERROR", 0.0, 0, None),
        ("X", 1000.0, 7, "a b"),
        ("X", 0.0, 0, "a"),
        ("X", -3.0, -1, "a"),
    ]


def test_half_even_and_ranges(spark):
    rows = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (None,), (float("nan"),)], "x DOUBLE")
    assert [r[0] for r in rows.select(records.half_even(F.col("x"))).collect()] == [0, 2, 2, 0, None, None]
    logs = frame(spark, [log(1, status=600), log(2, status=599), log(3, at=None, status=None, latency=-1.0)])
    flags = {r["event_id"]: r for r in as_dicts(cleaning.quality_flags(logs))}
    assert [flags[i]["status_in_range"] for i in (1, 2, 3)] == [False, True, False]
    assert not flags[3]["latency_in_range"] and not flags[3]["has_timestamp"]


def test_presence_is_not_nullness(spark):
    full = (
        '{"timestamp":null,"service":null,"host":"h","log_level":"INFO","message":"m",'
        '"request_id":"r","response_time_ms":1,"status_code":"401"}'
    )
    lines = [(1, "not json"), (2, full), (3, '{"service":"s"}'), (4, "[1]"), (5, full.replace('"host":"h",', ""))]
    checked = cleaning.check_presence(spark.createDataFrame(lines, "n INT, value STRING"))
    found = {r["n"]: r for r in as_dicts(checked)}
    assert [found[i]["is_valid"] for i in range(1, 6)] == [False, True, False, False, False]
    assert len(found[1]["missing_fields"]) == 8 and len(found[3]["missing_fields"]) == 7
    assert found[5]["missing_fields"] == ["host"]
    parsed = {r["n"]: r for r in as_dicts(cleaning.parse_lines(checked))}
    assert parsed[2]["status_code"] is None and parsed[2]["host"] == "h"
    assert parsed[1]["host"] is None


def test_timestamps(spark):
    text = [("2026-04-30T14:10:03.679781",), ("2026-04-30T14:10:03Z",), ("yesterday",), (None,)]
    found = cleaning.parse_timestamps(spark.createDataFrame(text, "timestamp STRING"))
    shown = [r[0] for r in found.select(F.col("timestamp").cast("string")).collect()]
    assert shown == ["2026-04-30 14:10:03.679781", "2026-04-30 14:10:03", None, None]
