"""Digest trees, published runs, the run log, scratch scopes and stored votes."""

from __future__ import annotations

import os
import random
from threading import Barrier, Thread

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from flowgauge.jobs import together
from flowgauge.operators import digests, voting
from flowgauge.plans import history, published, runlog
from flowgauge.sources.scratch import fresh_dir, remove_folder, scratch_scope, written
from flowgauge.sources.tables import MissingReport, read_report, write_reports


def exists(path):
    return os.path.exists(path.removeprefix("file:"))


# Digest trees


def tree(spark, rows, bits=digests.BITS):
    path = fresh_dir(spark, "tree")
    frame = spark.createDataFrame(rows, "k long, x string")
    digests.write_tree(digests.digest_tree(frame.repartition(3), "k", bits=bits), path)
    return digests.read_tree(spark, path)


@pytest.mark.parametrize("bits", [1, 4, 6, 12])
def test_differing_buckets_are_those_of_the_differing_rows(spark, bits):
    draw = random.Random(bits)
    before = [(i, str(i % 7)) for i in range(400)]
    after = [(i, x if draw.random() > 0.02 else x + "!") for i, x in before if i % 101] + [(1000, None), (None, "n")]
    changed = set(before) ^ set(after)
    frame = spark.createDataFrame(sorted(changed, key=str), "k long, x string")
    wanted = {r[0] for r in frame.select(digests.leaf_bucket("k", bits)).collect()}
    found = digests.differing_buckets(tree(spark, before, bits), tree(spark, after, bits), bits).collect()
    assert {r["bucket"] for r in found} == wanted
    assert sum(r["rows_after"] - r["rows_before"] for r in found) == len(after) - len(before)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_equal_versions_read_no_more_than_the_root(spark):
    rows = [(i, "x") for i in range(100)]
    found = digests.differing_buckets(tree(spark, rows), tree(spark, rows[::-1]))
    assert found.count() == 0 and "parquet" not in plan_of(found)
    assert digests.digest_tree(spark.createDataFrame([], "k long"), "k").count() == 0


def test_a_pass_reads_only_the_folders_of_differing_nodes(spark):
    rows = [(i, "x") for i in range(3000)]
    old, new = tree(spark, rows), tree(spark, [(i, "y" if i == 17 else x) for i, x in rows])
    found = digests.differing_buckets(old, new)
    bucket = found.first()["bucket"]
    plan = plan_of(found)
    assert found.count() == 1 and "PartitionFilters" in plan
    folders = {f.rsplit("/", 2)[1] for f in old.inputFiles() if "level=12" in f}
    assert len(folders) == 16
    read = old.where((F.col("level") == 12) & F.col("part").isin([bucket >> 8])).select("_metadata.file_path").distinct().collect()
    assert {r[0].rsplit("/", 2)[1] for r in read} == {f"part={bucket >> 8}"}


# Published runs


def finish(spark, out, run, value, when=None):
    write_reports({"label_counts": spark.createDataFrame([(value,)], "n int")}, f"{out}/{run}/reports")
    return published.publish(spark, out, run, when)


def newest(spark, out):
    return published.read_published(spark, out, "label_counts").first()["n"]


def test_a_run_without_its_record_is_never_read(spark):
    out = fresh_dir(spark, "runs")
    with pytest.raises(MissingReport):
        published.newest_run(spark, out)
    finish(spark, out, "a", 1)
    write_reports({"label_counts": spark.createDataFrame([(9,)], "n int")}, f"{out}/broken/reports")
    assert newest(spark, out) == 1
    with pytest.raises(ValueError):
        published.publish(spark, out, "a")
    finish(spark, out, "b", 2)
    assert newest(spark, out) == 2 and exists(f"{out}/broken")


def test_two_runs_at_once_leave_one_newest(spark):
    out, barrier = fresh_dir(spark, "runs"), Barrier(2)

    def work(run, value):
        barrier.wait()
        finish(spark, out, run, value, 5_000_000)

    threads = [Thread(target=work, args=a) for a in (("x", 1), ("y", 2))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert [r.run_id for r in published.finished_runs(spark, out)] == ["x", "y"] and newest(spark, out) == 2


def test_older_runs_go_and_unfinished_ones_stay(spark):
    out = fresh_dir(spark, "runs")
    for n in range(4):
        finish(spark, out, f"r{n}", n, n)
    write_reports({"label_counts": spark.createDataFrame([(9,)], "n int")}, f"{out}/working/reports")
    assert published.remove_older(spark, out, keep=2) == ["r0", "r1"]
    assert [exists(f"{out}/{r}") for r in ("r0", "r1", "r2", "r3", "working")] == [False, False, True, True, True]
    assert published.remove_older(spark, out, keep=2) == [] and newest(spark, out) == 3
    with pytest.raises(ValueError):
        published.remove_older(spark, out, keep=0)


def test_only_an_absent_report_is_called_missing(spark):
    base = fresh_dir(spark, "reports")
    with pytest.raises(MissingReport):
        read_report(spark, base, "label_counts")
    spark.range(3).write.csv(f"{base}/odd")
    for name in os.listdir(f"{base}/odd".removeprefix("file:")):
        if name.startswith("part"):
            os.rename(f"{base}/odd/{name}".removeprefix("file:"), f"{base}/odd/_{name}".removeprefix("file:"))
    with pytest.raises(AnalysisException) as found:
        read_report(spark, base, "odd")
    assert not isinstance(found.value, MissingReport)


# The run log


def test_history_of_odd_runs(spark):
    rows = [
        ("a", "run", "finished", "20"), ("a", "metric", "f1", "0.5"), ("a", "param", "x", "1"), ("a", "data", "digest", "7"), ("a", "step", "fit", "3.0"),
        ("b", "run", "finished", "10"), ("b", "metric", "f1", "0.5"), ("b", "param", "y", "2"), ("b", "data", "digest", "8"),
        ("c", "run", "finished", "30"), ("c", "param", "x", "1"),
        ("broken", "metric", "f1", "0.9"),
    ]
    log = spark.createDataFrame(rows, runlog.RECORD_SCHEMA)
    found = {r["run_id"]: r for r in history.run_history(log, "f1").collect()}
    assert [(k, found[k]["number"], found[k]["best"]) for k in "bac"] == [("b", 1, True), ("a", 2, False), ("c", 3, False)]
    assert found["a"]["changed_params"] == "x: - -> 1; y: 2 -> -" and found["c"]["changed_params"] == "" and found["a"]["other_data"]
    assert found["c"]["metric"] is None and found["c"]["metric_change"] is None and found["a"]["seconds_change"] is None
    assert history.best_run(log, "f1") == "b" and history.best_run(log, "other") is None
    assert history.run_history(log.limit(0), "f1").count() == 0


# Scratch scopes


def test_scopes_in_scopes_and_beside_each_other(spark):
    with scratch_scope(spark):
        outer = written(spark.range(3), "outer").inputFiles()[0]
        with scratch_scope(spark):
            inner = written(spark.range(3), "inner").inputFiles()[0]
            with scratch_scope(spark):
                pass
        assert exists(outer[7:] if outer.startswith("file://") else outer) and not exists(inner[7:] if inner.startswith("file://") else inner)
    assert not exists(outer[7:] if outer.startswith("file://") else outer)


def test_a_scope_leaves_the_folders_of_other_threads(spark):
    begun, done, paths = Barrier(2), Barrier(2), {}

    def other():
        begun.wait()
        paths["other"] = fresh_dir(spark, "other")
        spark.range(3).write.parquet(paths["other"])
        done.wait()

    thread = Thread(target=other)
    thread.start()
    with scratch_scope(spark):
        begun.wait()
        own = together(lambda n: spark.range(n).write.parquet(paths.setdefault(n, fresh_dir(spark, "own"))), [1, 2], 2)
        done.wait()
    thread.join()
    assert len(own) == 2 and exists(paths["other"]) and not exists(paths[1]) and not exists(paths[2])
    remove_folder(spark, paths["other"])


# Stored votes


def stored(spark, rows, buckets=4):
    name = f"votes_{random.getrandbits(60):x}"
    voting.write_votes(spark.createDataFrame(rows, "flow_id long, prediction double"), name, fresh_dir(spark, "votes"), "flow_id", buckets)
    return name


def test_stored_votes_are_lined_up_without_an_exchange(spark):
    names = [stored(spark, [(i, float(i % m)) for i in range(200) if i % 7 != m]) for m in (1, 2, 3)]
    wide = voting.line_up_tables(spark, names, "flow_id")
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    wanted = {(i, float(i % 1), float(i % 2), float(i % 3)) for i in range(200) if i % 7 not in (1, 2, 3)}
    assert {tuple(r) for r in wide.collect()} == wanted


def test_stored_votes_with_repeated_and_null_keys(spark):
    twice = voting.line_up_tables(spark, [stored(spark, [(1, 1.0), (1, 1.0)]), stored(spark, [(1, 1.0)])], "flow_id")
    with pytest.raises(Exception, match="scored twice by one member: 1"):
        twice.collect()
    with pytest.raises(Exception, match="flow_id is null"):
        stored(spark, [(None, 1.0)])
    some = voting.line_up_tables(spark, [stored(spark, [(1, None), (2, 3.0)]), stored(spark, [(1, 4.0)])], "flow_id")
    assert [tuple(r) for r in some.collect()] == [(1, None, 4.0)]
