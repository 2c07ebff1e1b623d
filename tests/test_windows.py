"""Streams with state: windows, late rows, restarts and repeated deliveries."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from flowgauge.registry import streaming
from flowgauge.registry import views as v
from flowgauge.sources.scratch import fresh_dir
from flowgauge.streaming import windows as ops
from flowgauge.streaming.alerts import read_flow_stream

SCHEMA = "flow_id long, kind string, at timestamp"
ZERO = datetime(2024, 5, 1, tzinfo=timezone.utc)


def minute(n):
    return ZERO + timedelta(minutes=n)


def deliver(spark, path, rows):
    """One more file of (flow_id, kind, minute)."""
    frame = spark.createDataFrame([(i, kind, minute(m)) for i, kind, m in rows], SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(path)


def run(stream, out, checkpoint):
    job = ops.start_to_files(stream, out, checkpoint)
    job.awaitTermination()
    return job


@pytest.fixture
def places(spark):
    return tuple(fresh_dir(spark, name) for name in ("arrivals", "windows", "progress"))


def windows(spark, arrivals):
    stream = read_flow_stream(spark, arrivals, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    return ops.window_counts(stream, "at", "10 minutes", "20 minutes", by=["kind"])


def written(spark, stream, out):
    rows = spark.read.schema(stream.schema).parquet(out).select("kind", F.unix_seconds(ops.START).alias("s"), ops.COUNT).collect()
    found = {(r["kind"], (r["s"] - int(ZERO.timestamp())) // 60): r[ops.COUNT] for r in rows}
    assert len(found) == len(rows)
    return found


def test_a_restart_counts_nothing_twice(spark, places):
    arrivals, out, checkpoint = places
    deliver(spark, arrivals, [(1, "a", 1), (2, "a", 9), (3, "b", 12), (4, "a", 31)])
    run(windows(spark, arrivals), out, checkpoint)
    assert written(spark, windows(spark, arrivals), out) == {("a", 0): 2}
    deliver(spark, arrivals, [(5, "b", 15), (6, "a", 33), (7, "a", 2)])  # the last is late
    deliver(spark, arrivals, [(8, "a", 65)])
    run(windows(spark, arrivals), out, checkpoint)
    counts = written(spark, windows(spark, arrivals), out)
    assert counts == {("a", 0): 2, ("b", 10): 2, ("a", 30): 2}
    run(windows(spark, arrivals), out, checkpoint)
    assert written(spark, windows(spark, arrivals), out) == counts
    given = spark.read.schema(SCHEMA).parquet(arrivals)
    balance = ops.alert_balance(spark.read.parquet(out), ops.open_counts(spark, checkpoint), given)
    assert {r["kind"]: r[ops.COUNT] for r in balance.collect()} == {"written": 6, "open": 1, "late": 1}


def test_parts_of_the_state_are_the_jobs_own(spark, places):
    arrivals, out, checkpoint = places
    deliver(spark, arrivals, [(i, "a", i) for i in range(50)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    job = ops.start_to_files(windows(spark, arrivals), out, checkpoint, state_parts=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    job.awaitTermination()
    assert job.recentProgress[0]["stateOperators"][0]["numShufflePartitions"] == 3


def test_no_alerts_at_all(spark, places):
    arrivals, out, checkpoint = places
    deliver(spark, arrivals, [])
    run(windows(spark, arrivals), out, checkpoint)
    assert written(spark, windows(spark, arrivals), out) == {}


def test_overlapping_windows_hold_a_row_each(spark, places):
    arrivals, out, checkpoint = places
    deliver(spark, arrivals, [(1, "a", 7), (2, "a", 200)])
    stream = read_flow_stream(spark, arrivals, spark.createDataFrame([], SCHEMA).schema)
    run(ops.window_counts(stream, "at", "10 minutes", "20 minutes", by=["kind"], slide="5 minutes"), out, checkpoint)
    assert written(spark, windows(spark, arrivals), out) == {("a", 0): 1, ("a", 5): 1}


def test_repeated_deliveries_give_each_alert_once_and_state_shrinks(spark, places):
    arrivals, out, checkpoint = places
    files = [[(100 * k + i, "a", 60 * k + i % 60) for i in range(100)] for k in range(6)]
    for rows in files:
        for _ in range(2):
            deliver(spark, arrivals, rows)
    stream = read_flow_stream(spark, arrivals, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    job = run(ops.once(stream, ["flow_id"], "at", "90 minutes"), out, checkpoint)
    found = Counter(r["flow_id"] for r in spark.read.parquet(out).collect())
    assert found == Counter(i for rows in files for i, _, _ in rows)
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in job.recentProgress]
    assert max(held) < len(found) and held[-1] < max(held), held


def test_windows_over_the_files_of_an_alert_job(spark, places):
    """A micro-batch of the alert job that was run again, after the windows had read its first files."""
    job, out, checkpoint = places

    def batch(number, rows):
        frame = spark.createDataFrame([(i, kind, minute(m)) for i, kind, m in rows], "flow_id long, alert string, at timestamp")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{job}/alerts/batch={number}")

    def count():
        ops.start_alert_windows(spark, job, out, checkpoint, "flow_id", "at", "10 minutes", "30 minutes").awaitTermination()
        rows = spark.read.parquet(out).select("alert", F.unix_seconds(ops.START).alias("s"), ops.COUNT).collect()
        assert len({(r["alert"], r["s"]) for r in rows}) == len(rows)
        return {(r["alert"], (r["s"] - int(ZERO.timestamp())) // 60): r[ops.COUNT] for r in rows}

    first = [(1, "scan", 1), (2, "scan", 2), (3, "flood", 12)]
    batch(0, first)
    assert count() == {}
    batch(0, [*first, (4, "flood", 13)])
    batch(1, [(3, "flood", 12), (5, "scan", 14), (6, "scan", 90)])
    assert count() == {("scan", 0): 2, ("flood", 10): 2, ("scan", 10): 1}


def test_event_time_does_not_follow_the_session_zone(spark):
    rows = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179575' as ts")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rows.select(F.unix_micros(ops.event_time(F.col("ts")))).first()[0] == 1_704_067_207_179_575
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_timed_alerts_draw_each_member_in_one_place(spark, sf_dir, capsys):
    streaming._timed_alerts(spark, sf_dir).explain()
    assert capsys.readouterr().out.count("md5(") == 2 * v.MEMBERS  # the rule reads a draw twice


def test_timed_alerts_read_the_flows_once(spark, sf_dir, capsys):
    streaming._timed_alerts(spark, sf_dir).explain()
    assert capsys.readouterr().out.count("FileScan parquet") == 2  # flows and classes


def test_scoring_has_more_tasks_for_more_flows(spark, sf_dir, monkeypatch, capsys):
    class_rows = v.classes(spark, sf_dir)
    flows = v.flows(spark, sf_dir).count()
    for rows, tasks in ((flows, v.DEALT), (flows // 50, 50)):
        monkeypatch.setattr(v, "DEALT_ROWS", rows)
        v.scored(spark, sf_dir, class_rows).explain()
        assert f", {tasks}), REPARTITION_BY_NUM" in capsys.readouterr().out


@pytest.mark.parametrize("part_rows, files", [(10, 3), (3, 9), (1000, 1)])
def test_a_delivery_of_many_files_is_one_micro_batch(spark, places, part_rows, files):
    """Deliveries of 25, 1 and 12 rows, each twice; the second has fewer rows than files."""
    sizes = {4: 25, 7: 1, 9: 12}
    frame = [(100 * d + i, "a", minute(d), d) for d, n in sizes.items() for i in range(n)]
    rows = spark.createDataFrame(frame, f"{SCHEMA}, delivery int")
    stream, given, parts = streaming._delivered(rows, times=2, part_rows=part_rows)
    assert parts == max(streaming.STATE_PARTS, files)
    assert all("/delivery=" in path for path in given.inputFiles())
    job = run(ops.window_counts(stream, "at", "1 minute", "20 minutes"), *places[1:])
    took = [p["numInputRows"] for p in job.recentProgress if p["numInputRows"]]
    assert took == [n for n in sizes.values() for _ in range(2)]
