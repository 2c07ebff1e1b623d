"""Finished runs: a commit record written last, a reader of the newest one, and removal of older ones.

A run writes its tables to a folder of its own. Its record is a file of its own
too, made in one step after all tables, so a run that broke off has none and is
never read, and runs that end at once do not disturb each other. The newest run
is that with the greatest (end in microseconds, run id), the same for every reader.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flowgauge.sources.scratch import remove_folder
from flowgauge.sources.tables import MissingReport, read_report

RECORDS = "finished"
_DIGITS = 20


@dataclass(frozen=True, order=True)
class Finished:
    """A finished run."""

    finished: int
    run_id: str


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, out: str, run_id: str, finished: int | None = None) -> Finished:
    """Mark the run in out/run_id as finished; to be called after its last table.

    The record is written beside its place and renamed into it, so that no reader
    sees half of one. A run that is published twice is an error.
    """
    run = Finished(finished if finished is not None else time.time_ns() // 1000, run_id)
    if any(r.run_id == run_id for r in finished_runs(spark, out)):
        raise ValueError(f"run {run_id} is published already")
    name = f"{run.finished:0{_DIGITS}d}-{run_id}"
    place, files = _files(spark, f"{out}/{RECORDS}/{name}.json")
    beside, _ = _files(spark, f"{out}/{RECORDS}/.{name}.tmp")
    stream = files.create(beside, True)
    stream.write(bytearray(json.dumps(run.__dict__).encode()))
    stream.close()
    if not files.rename(beside, place):
        raise OSError(f"the record of run {run_id} could not be put in place")
    return run


def finished_runs(spark: SparkSession, out: str) -> list[Finished]:
    """All finished runs, the newest last."""
    folder, files = _files(spark, f"{out}/{RECORDS}")
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    records = [n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith(".")]
    return sorted(Finished(int(n[:_DIGITS]), n[_DIGITS + 1 :]) for n in records)


def newest_run(spark: SparkSession, out: str) -> str:
    """Folder of the newest finished run; an error where none has finished."""
    runs = finished_runs(spark, out)
    if not runs:
        raise MissingReport(f"no finished run below {out}")
    return f"{out}/{runs[-1].run_id}"


def read_published(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A report table of the newest finished run."""
    return read_report(spark, f"{newest_run(spark, out)}/reports", name)


def remove_older(spark: SparkSession, out: str, keep: int = 2) -> list[str]:
    """Remove all but the newest `keep` finished runs; gives the ids of those removed.

    A record goes before its folder, so a run is never listed without its tables.
    With `keep` above one, a reader that has just opened the run before the newest
    can end. Runs without a record, which may be at work, are left alone.
    """
    if keep < 1:
        raise ValueError("at least one run must be kept")
    old = finished_runs(spark, out)[:-keep]
    for run in old:
        remove_folder(spark, f"{out}/{RECORDS}/{run.finished:0{_DIGITS}d}-{run.run_id}.json")
        remove_folder(spark, f"{out}/{run.run_id}")
    return [r.run_id for r in old]
