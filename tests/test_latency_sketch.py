"""Latency sketches: how often the log is read, merging, sketches kept at landing."""

from __future__ import annotations

import random
import statistics

import pytest
from helpers import as_dicts, frame, log
from pyspark.sql import functions as F

from logtide.operators import summaries
from logtide.operators.quantiles import Part, bucket_edge, counts_inside, exact_percentiles, log_bucket
from logtide.sinks import files as sinks
from logtide.sources import files


def counting(spark, df):
    """The same rows, and a counter of those that were read."""
    seen = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(through, df.schema), seen


def latencies(n, seed=1):
    rng = random.Random(seed)
    return [round(rng.lognormvariate(6, 1.5), 2) for _ in range(n)]


def by_hand(rows):
    ms = [row[7] or 0.0 for row in rows]
    return {
        "total_records": len(rows),
        "error_count": sum((row[4] or "").upper() == "ERROR" for row in rows),
        "warning_count": sum((row[4] or "").upper() == "WARNING" for row in rows),
        "min_response_time_ms": min(ms),
        "max_response_time_ms": max(ms),
        "mean_response_time_ms": pytest.approx(statistics.fmean(ms), rel=1e-12),
        "stdev_response_time_ms": pytest.approx(statistics.stdev(ms), rel=1e-9),
        "median_response_time_ms": pytest.approx(statistics.median(ms), rel=1e-12),
    }


def some_rows(n=700):
    levels = ["ERROR", "error", "Warning", "INFO", None]
    rows = [log(i, i * 60.0, "abc"[i % 7 % 3], levels[i % 5], latency=v) for i, v in enumerate(latencies(n))]
    rows += [log(n + i, None, None, latency=None) for i in range(5)]
    return rows + [log(n + 10 + i, 5.0, "a", latency=-3.5) for i in range(3)]


def test_summary_reads_the_log_twice(spark):
    rows = [log(i, latency=400 + i * 0.003, level=["INFO", "ERROR"][i % 2]) for i in range(708)]
    logs, seen = counting(spark, frame(spark, rows))
    (found,) = as_dicts(summaries.metrics_summary(logs))
    assert seen.value == 2 * len(rows)
    wanted = by_hand(rows)
    assert {name: found[name] for name in wanted} == wanted


def test_percentiles_read_the_data_twice_when_parts_are_wide(spark):
    import numpy as np

    values = [1e6 + x for x in latencies(3000)] + [1e6 + 100.0] * 50
    df, seen = counting(spark, spark.createDataFrame([(v,) for v in values], "x DOUBLE").repartition(5))
    fractions = [0.05, 0.5, 0.95]
    found = {r["fraction"]: r["value"] for r in as_dicts(exact_percentiles(df, "x", fractions, part_rows=4))}
    assert seen.value == 2 * len(values)
    for fraction in fractions:
        assert found[fraction] == pytest.approx(float(np.quantile(values, fraction)), rel=1e-12)


@pytest.mark.parametrize("resolution", [1, 64])
def test_sketches_merge_whatever_the_grouping(spark, resolution):
    rows = some_rows()
    logs = frame(spark, rows)
    wanted = by_hand(rows)
    for by in ((), ("service",), ("service", "host", "log_level")):
        sketch = summaries.latency_sketch(logs, by, resolution)
        again, seen = counting(spark, logs)
        (found,) = as_dicts(summaries.metrics_summary(again, sketch))
        assert {name: found[name] for name in wanted} == wanted and seen.value == len(rows)


def test_spread_of_large_equal_distances(spark):
    """The sum of squares of 1e9 and neighbours would lose the spread; distances to the edge keep five digits of it."""
    rows = [log(i, latency=1e9 + i % 3) for i in range(300)]
    (found,) = as_dicts(summaries.metrics_summary(frame(spark, rows)))
    assert found["stdev_response_time_ms"] == pytest.approx(statistics.stdev(row[7] for row in rows), rel=1e-5)


def test_missing_and_not_a_number(spark):
    rows = [log(1, latency=None), log(2, latency=4.0), log(3, latency=float("nan")), log(4, latency=None)]
    (found,) = as_dicts(summaries.metrics_summary(frame(spark, rows)))
    assert (found["total_records"], found["min_response_time_ms"], found["median_response_time_ms"]) == (4, 0.0, 0.0)
    assert all(found[f"{name}_response_time_ms"] != found[f"{name}_response_time_ms"] for name in ("max", "mean", "stdev"))
    for value in (None, float("nan")):
        rows = spark.createDataFrame([(value,)], "x DOUBLE")
        assert exact_percentiles(rows, "x", [0.5]).count() == 0
    assert exact_percentiles(spark.createDataFrame([(None,)], "x DOUBLE"), "x", [0.5], missing=2.0).first()["value"] == 2.0


def test_bucket_edges(spark):
    values = [0.0, 0.3, 1.0, 7.5, 1e9, -0.3, -7.5, -1e9]
    rows = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    for resolution in (1, 64, 4096):
        bucket = log_bucket(F.col("x"), resolution)
        for r in rows.select("x", bucket_edge(bucket, resolution).alias("edge")).collect():
            assert abs(r["edge"]) <= abs(r["x"]) * (1 + 1e-9) and (abs(r["x"]) + 1) / (abs(r["edge"]) + 1) < 2 ** (1 / resolution) * (1 + 1e-9)


def test_landed_sketch_after_two_landings(spark, tmp_path):
    path = str(tmp_path / "landed")
    rows = some_rows()
    sinks.land_logs(frame(spark, rows[:400]), path)
    sinks.land_logs(frame(spark, rows[400:]), path, mode="append")
    logs, sketch = files.read_landed_logs(spark, path), files.read_landed_sketch(spark, path)
    (found,) = as_dicts(summaries.metrics_summary(logs, sketch))
    wanted = by_hand(rows)
    assert {name: found[name] for name in wanted} == wanted
    # Landed again without its sketch, the log is larger than what the sketch counts; the reverse is noticed.
    with pytest.raises(ValueError, match="sketch counts more rows"):
        summaries.metrics_summary(logs.where("response_time_ms < 50"), sketch)
    assert files.read_landed_sketch(spark, str(tmp_path / "other")) is None


def test_bounds_reach_the_scan(spark, tmp_path):
    """The pass for the values is given the bounds of the latency and reads this column alone."""
    path = str(tmp_path / "landed")
    sinks.land_logs(frame(spark, some_rows()), path)
    logs = files.read_landed_logs(spark, path)
    for low, test in ((300.0, "GreaterThanOrEqual(response_time_ms,300.0)"), (-1.0, "IsNull")):  # the text of a plan is cut
        inside = counts_inside(logs, "response_time_ms", [Part(low, 310.0, 1, 0)], missing=0.0)
        plan = inside._jdf.queryExecution().executedPlan().toString()
        assert test in plan.split("PushedFilters: [")[1].split("]")[0]
        assert "ReadSchema: struct<response_time_ms:double>" in plan
