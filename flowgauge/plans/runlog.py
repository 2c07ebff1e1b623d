"""Step timing and run records as tables."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowgauge.functions.measures import ratio

LOG_SCHEMA = "step string, rows bigint, seconds double"
RECORD_SCHEMA = "run_id string, kind string, name string, value string"
EXPORT = "export"
# Kinds of the run log's rows, and the row that a finished run has.
DATA, METRIC, PARAM, STEP, RUN = "data", "metric", "param", "step", "run"
FINISHED = "finished"


class Step:
    """A running step; set `rows` to log how many it worked on."""

    def __init__(self) -> None:
        self.rows: int | None = None


class StepLog:
    """Wall-clock seconds of each named step of one run."""

    def __init__(self) -> None:
        self._started = time.monotonic()
        self._steps: dict[str, tuple[int | None, float]] = {}

    @contextmanager
    def step(self, name: str, rows: int | None = None) -> Iterator[Step]:
        begun, step = time.monotonic(), Step()
        step.rows = rows
        yield step
        self._steps[name] = (step.rows, time.monotonic() - begun)

    def seconds(self) -> list[tuple[str, float]]:
        """Seconds of each step so far."""
        return [(name, seconds) for name, (_, seconds) in self._steps.items()]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(n, r, s) for n, (r, s) in self._steps.items()], LOG_SCHEMA)

    def shares(self, spark: SparkSession) -> DataFrame:
        """Seconds, share and throughput of each step so far; the rest of the run is the export."""
        return step_shares(self.table(spark), spark.range(1).select(F.lit(self.elapsed()).alias("total")))

    def elapsed(self) -> float:
        return time.monotonic() - self._started


def step_shares(log: DataFrame, total_seconds: DataFrame) -> DataFrame:
    """Seconds, share of the total, rows per second and ms per row of each step.

    `total_seconds` has one row and column `total`; what the steps leave of it
    is shown as the export step.
    """
    spent = F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("spent")
    export = log.agg(spent).select(
        F.lit(EXPORT).alias("step"),
        F.lit(None).cast("bigint").alias("rows"),
        (total_seconds.select("total").scalar() - F.col("spent")).alias("seconds"),
    )
    steps = log.select("step", "rows", "seconds").unionByName(export)
    share = ratio(F.col("seconds"), F.sum("seconds").over(W.partitionBy()))
    return steps.select(
        "step",
        "rows",
        F.round("seconds", 3).alias("seconds"),
        F.round(share * 100.0, 4).alias("percent"),
        F.round(F.try_divide(F.col("rows"), F.col("seconds")), 4).alias("rows_per_second"),
        F.round(F.try_divide(F.col("seconds") * 1000.0, F.col("rows")), 6).alias("ms_per_row"),
    )


def record_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    data: DataFrame,
    metrics: Mapping[str, float],
    params: Mapping[str, object],
    steps: Sequence[tuple[str, float]] = (),
    finished: int | None = None,
) -> DataFrame:
    """Append one run's data fingerprint, metrics and parameters to the run log, and its seconds by step and end (microseconds) if given.

    Only runs with an end are put in order by the history.
    """
    print_ = data.first().asDict()
    end = {FINISHED: finished} if finished is not None else {}
    kinds = ((DATA, print_), (METRIC, metrics), (PARAM, params), (STEP, dict(steps)), (RUN, end))
    rows = [(run_id, kind, name, str(value)) for kind, values in kinds for name, value in values.items()]
    spark.createDataFrame(rows, RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(RECORD_SCHEMA).parquet(path)
