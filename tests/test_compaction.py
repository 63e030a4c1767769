"""Updates of streams: a bounded number of folders, runs apart, repeated and broken off batches."""

from __future__ import annotations

import random
from datetime import timedelta
from pathlib import Path

import pytest
from helpers import START, frame
from pyspark.sql import functions as F
from test_streaming import add_file, comparable, drain, expected_view, some_logs, watch

from logtide.plans.catalog import LIVE_DDL
from logtide.streaming import compaction
from logtide.streaming.compaction import WINDOW_KEYS, RunFolder, compacting_sink, latest_updates, runs_of

DDL = "window_start TIMESTAMP, window_end TIMESTAMP, service STRING, n BIGINT"


def minutes(m):
    return START + timedelta(minutes=m)


def updates(spark, rows):
    """(minute, service, n) as rows of one-minute windows."""
    return spark.createDataFrame([(minutes(m), minutes(m + 1), s, n) for m, s, n in rows], DDL).coalesce(1)


def state(spark, path, run="r"):
    rows = latest_updates(spark, path, DDL, WINDOW_KEYS, run).collect()
    return {((r.window_start - START) // timedelta(minutes=1), r.service): r.n for r in rows}


def test_many_batches_few_folders(spark, tmp_path):
    """Every batch updates windows of the last minutes; a repeated batch changes nothing."""
    path, every, rng, wanted = str(tmp_path / "out"), 20, random.Random(2), {}
    sink = compacting_sink(path, WINDOW_KEYS, every, "10 minutes", run="r")
    for n in range(201):
        rows = {(5 * n - rng.randrange(10), rng.choice("ab")): n for _ in range(4)}
        batch = updates(spark, [(*key, v) for key, v in rows.items()])
        sink(batch, n)
        if n % 50 == 0:
            sink(batch, n)
        wanted |= rows
        folder = Path(path) / "run=r"
        assert len(list((folder / "live").iterdir())) <= 2 * every + 1
        if n >= every:
            assert len(list((folder / "open").iterdir())) <= 2
    assert state(spark, path) == wanted
    hours = {p.name for p in (folder / "closed").glob("upto=*/hour=*")}
    assert hours and len(list((folder / "closed").glob("upto=*/hour=*"))) == len(hours)  # each hour once
    # What is carried on is what the stream has not left behind.
    done = RunFolder(spark, path, "r").swapped()
    assert done == 199 and spark.read.parquet(f"{folder}/open/upto={done}").count() < 80


def test_late_update_of_a_closed_hour(spark, tmp_path):
    path = str(tmp_path / "out")
    sink = compacting_sink(path, WINDOW_KEYS, 1, "10 minutes", run="r")
    for n, rows in enumerate([[(0, "a", 1)], [(300, "a", 2)], [(0, "a", 3)], [(301, "a", 4)], [(302, "a", 5)]]):
        sink(updates(spark, rows), n)
    assert len(list(Path(path).glob("run=r/closed/upto=*/hour=*"))) == 2
    assert state(spark, path) == {(0, "a"): 3, (300, "a"): 2, (301, "a"): 4, (302, "a"): 5}


def test_broken_off_between_closed_and_open(spark, tmp_path, monkeypatch):
    """The state stays that of the last swap, and the repeated batch does the work again."""
    path = str(tmp_path / "out")
    sink = compacting_sink(path, WINDOW_KEYS, 2, "10 minutes", run="r")
    wanted = {}
    for n in range(4):
        sink(updates(spark, [(300 * n, "a", n)]), n)
        wanted[300 * n, "a"] = n
    at = RunFolder.at

    def fails(self, kind, number):
        if kind == "open" and number == 3 and not done:
            raise OSError("lost")
        return at(self, kind, number)

    done = False
    monkeypatch.setattr(RunFolder, "at", fails)
    with pytest.raises(OSError):
        sink(updates(spark, [(1200, "a", 4)]), 4)
    wanted[1200, "a"] = 4
    assert (Path(path) / "run=r/closed/upto=3").exists() and state(spark, path) == wanted
    done = True
    sink(updates(spark, [(1200, "a", 4)]), 4)
    assert RunFolder(spark, path, "r").swapped() == 3 and state(spark, path) == wanted


def test_odd_rows_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "out")
    sink = compacting_sink(path, WINDOW_KEYS, 1, "0 seconds", run="r")
    empty = updates(spark, [])
    odd = spark.createDataFrame([(None, None, None, 1), (minutes(0), minutes(1), None, None)], DDL)
    for n, batch in enumerate([empty, odd, empty, odd.limit(0), odd]):
        sink(batch, n)
    rows = latest_updates(spark, path, DDL, WINDOW_KEYS).collect()
    assert sorted(map(str, rows)) == sorted(map(str, odd.collect()))
    assert latest_updates(spark, path, DDL, WINDOW_KEYS).schema.names == [*WINDOW_KEYS, "n"]


def test_batch_outside_a_query_needs_a_name(spark, tmp_path):
    with pytest.raises(ValueError, match="name the run"):
        compacting_sink(str(tmp_path), WINDOW_KEYS)(updates(spark, []), 0)


def test_two_streams_over_one_path_and_a_restart(spark, tmp_path):
    path, rows = str(tmp_path / "rows"), some_logs(120)
    sink = compacting_sink(path, WINDOW_KEYS, every=1, delay="30 seconds")
    for name, part in (("one", rows), ("two", rows[:60])):
        for n in range(3):  # started anew for each file
            size = len(part) // 3
            add_file(spark, part[n * size : (n + 1) * size], f"{tmp_path}/{name}", n)
            drain(spark, f"{tmp_path}/{name}", f"{tmp_path}/{name}-out", sink)
    names = runs_of(spark, path)
    assert len(names) == 2
    with pytest.raises(ValueError, match="holds 2 runs"):
        latest_updates(spark, path, LIVE_DDL, WINDOW_KEYS)
    found = sorted(comparable(latest_updates(spark, path, LIVE_DDL, WINDOW_KEYS, run)) for run in names)
    assert found == sorted(comparable(expected_view(frame(spark, part))) for part in (rows, rows[:60]))
    assert all(RunFolder(spark, path, run).swapped() >= 1 for run in names)


def test_newest_version_per_key(spark):
    rows = updates(spark, [(0, "a", 1), (0, "a", 2), (0, None, 3)]).withColumn("batch", F.col("n"))
    assert sorted(r.n for r in compaction.newest(rows, WINDOW_KEYS).collect()) == [2, 3]
