"""Panes on a stream, late rows kept apart, a registry that changes."""

from __future__ import annotations

from datetime import timedelta

from helpers import START, as_dicts, frame, log
from pyspark.sql import functions as F
from test_streaming import SETTINGS, add_file, comparable, drain, expected_view, feed, some_logs, watch

from logtide.operators import errors, windows
from logtide.plans.catalog import LIVE_DDL
from logtide.settings import MINUTE, MINUTE_BY_TEN
from logtide.streaming import enriched, fanout, late, live, progress


def collected(spark, folder, out, chained):
    """Progress of the sliding windows of a folder in append mode, with or without panes."""
    view = live.live_metrics(watch(spark, folder), SETTINGS, chained=chained)
    query = live.writer(view, f"{out}/checkpoint", "append", None).format("parquet").option("path", f"{out}/rows").start()
    query.awaitTermination()
    return query.recentProgress


def test_panes_on_a_stream_equal_batch_and_hold_less_state(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [log(i, i * 70.0, "ab"[i % 2], "ERROR", 500) for i in range(60)]
    feed(spark, source, rows, 3)
    add_file(spark, [log(1000, 9000.0, "z", "ERROR", 500)], source, 8)
    add_file(spark, [log(1001, 9001.0, "z", "ERROR", 500)], source, 9)
    states = {}
    for chained in (True, False):
        out = f"{tmp_path}/{chained}"
        reports = collected(spark, source, out, chained)
        found = spark.read.schema(LIVE_DDL).parquet(f"{out}/rows").where("service <> 'z'")
        assert found.count() == expected_view(frame(spark, rows)).count()
        states[chained] = max(sum(o.numRowsTotal for o in p.stateOperators) for p in reports)
        assert len(reports[0].stateOperators) == (2 if chained else 1)
    # Each row is held in one pane instead of six windows.
    assert states[True] * 5 < states[False]


def test_append_mode_uses_panes(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = some_logs(60)
    feed(spark, source, rows, 2)
    for n, at in ((8, 4000.0), (9, 4001.0)):
        add_file(spark, [log(1000 + n, at, "z", "ERROR", 500)], source, n)
    query = drain(spark, source, out, mode="append")
    assert len(query.recentProgress[0].stateOperators) == 2
    found = spark.read.schema(LIVE_DDL).parquet(f"{out}/rows").where("service <> 'z'").drop("batch")
    assert comparable(found) == comparable(expected_view(frame(spark, rows)))


def test_panes_in_batch_and_direct_agree(spark):
    logs = errors.filter_errors(frame(spark, some_logs(200)))
    first, second = (windows.service_metrics(logs, MINUTE_BY_TEN, panes=panes) for panes in (True, False))
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))


LATE = [
    [log(0, 0.0, "a"), log(1, 30.0, "b")],
    [log(2, 400.0, "a")],
    [log(3, 410.0, "a"), log(4, 10.0, "c")],  # judged by the first batch alone: in time
    [log(5, 420.0, "a"), log(6, 20.0, "d"), log(7, 339.0, "e"), log(8, None, "f")],  # d and e are late
    [log(9, 1.0, "g"), log(10, 500.0, "a"), log(11, 361.0, "h")],  # g is late
]


def test_late_rows_are_those_the_engine_drops(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, rows in enumerate(LATE):
        add_file(spark, rows, source, n)
    late.start_late_rows(watch(spark, source), out, f"{out}/cp", timedelta(seconds=30), MINUTE, trigger=None).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    assert {(r["request_id"], r["batch"]) for r in rows.collect()} == {("r6", 3), ("r7", 3), ("r9", 4)}
    counters = as_dicts(late.late_counters(spark, out).orderBy("batch"))
    assert [(r["rows"], r["late_rows"]) for r in counters] == [(2, 0), (1, 0), (2, 0), (4, 2), (3, 1)]

    grouped = live.watermarked(watch(spark, source), "30 seconds").groupBy(F.window("timestamp", "60 seconds"), "service").count()
    with progress.ProgressLog(spark, f"{out}/progress") as kept:
        query = live.writer(grouped, f"{out}/cp-engine", "update", None).format("noop").start()
        query.awaitTermination()
        assert kept.wait_for(query)
    dropped = progress.progress_rows(spark, f"{out}/progress").agg(F.sum("late_rows")).first()[0]
    assert dropped == sum(r["late_rows"] for r in counters) == 3


def test_late_rows_of_sliding_windows(spark):
    rows = frame(spark, [log(1, 0.0), log(2, 9.9), log(3, 10.0), log(4, None)])
    ends = [r[0] for r in rows.orderBy("event_id").select(late.last_window_end(F.col("timestamp"), MINUTE_BY_TEN)).collect()]
    assert [end and (end.replace(tzinfo=None) - START).total_seconds() for end in ends] == [60.0, 60.0, 70.0, None]


def test_registry_that_changes_between_batches(spark, tmp_path):
    source, out, table = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "registry")

    def register(owner):
        spark.createDataFrame([("a", owner), ("b", owner)], "service STRING, owner STRING").write.mode("overwrite").parquet(table)

    register("first")
    for n, service in enumerate("abc"):
        add_file(spark, [log(n, float(n), service)], source, n)
    keep = fanout.parquet_sink(f"{out}/rows")

    def sink(batch, batch_id):
        keep(batch, batch_id)
        register("second")

    def registry():
        return spark.read.schema("service STRING, owner STRING").parquet(table)

    enriched.start_enriched(watch(spark, source), registry, sink, f"{out}/cp", mode="append", trigger=None).awaitTermination()
    found = {(r["service"], r["owner"]) for r in spark.read.parquet(f"{out}/rows").collect()}
    assert found == {("a", "first"), ("b", "second"), ("c", None)}
