"""Runs of the run log side by side: measures, settings, data and times.

The log is long: (run_id, kind, name, value). One row a run is left after the
first aggregation, so the windows over all runs work on small tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from flowgauge.plans.runlog import DATA, FINISHED, METRIC, PARAM, RUN, STEP

def _in_order() -> WindowSpec:
    return W.orderBy("finished", "run_id")


def _finished(log: DataFrame) -> DataFrame:
    """(run_id, finished) of the runs that have ended; one that broke off has no such row."""
    rows = log.where((F.col("kind") == RUN) & (F.col("name") == FINISHED))
    return rows.groupBy("run_id").agg(F.max(F.col("value").cast("bigint")).alias("finished"))


def _one(kind: str, name: str | None = None):
    wanted = F.col("kind") == kind
    return wanted if name is None else wanted & (F.col("name") == name)


def runs_wide(log: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """(run_id, number, one column a metric), runs numbered in the order of their ends; names are given, so no job looks for them."""
    found = log.where(_one(METRIC)).groupBy("run_id").pivot("name", list(metrics)).agg(F.max(F.col("value").cast("double")))
    numbered = _finished(log).withColumn("number", F.row_number().over(_in_order()))
    return numbered.join(found, "run_id", "left").select("run_id", "number", *metrics)


def run_history(log: DataFrame, metric: str, digits: int = 4) -> DataFrame:
    """One row a run: its measure, whether it is the best so far of all (ties: the earlier), and what differs from the run before.

    `changed_params` lists "name: before -> now" by name, a setting that one of
    the two lacks as "-"; `other_data` says whether the training data differ.
    """
    entry = F.struct("name", "value")
    facts = log.groupBy("run_id").agg(
        F.max(F.when(_one(METRIC, metric), F.col("value").cast("double"))).alias("metric"),
        F.sum(F.when(_one(STEP), F.col("value").cast("double"))).alias("seconds"),
        F.map_from_entries(F.array_sort(F.collect_set(F.when(_one(PARAM), entry)))).alias("params"),
        F.array_sort(F.collect_set(F.when(_one(DATA), entry))).alias("data"),
    )
    runs = _finished(log).join(facts, "run_id")
    before = {c: F.lag(c).over(_in_order()) for c in ("metric", "seconds", "params", "data")}
    best = F.row_number().over(W.orderBy(F.desc_nulls_last("metric"), "finished", "run_id")) == 1
    first = F.row_number().over(_in_order()) == 1
    runs = runs.select("*", F.row_number().over(_in_order()).alias("number"), best.alias("best"), first.alias("first"), *[b.alias(f"last_{c}") for c, b in before.items()])
    names = F.array_sort(F.array_union(F.map_keys("params"), F.coalesce(F.map_keys("last_params"), F.array().cast("array<string>"))))
    changed = F.filter(names, lambda n: ~F.element_at("params", n).eqNullSafe(F.element_at("last_params", n)))
    shown = F.transform(changed, lambda n: F.concat(n, F.lit(": "), F.coalesce(F.element_at("last_params", n), F.lit("-")), F.lit(" -> "), F.coalesce(F.element_at("params", n), F.lit("-"))))
    return runs.select(
        "run_id",
        "number",
        "metric",
        F.round(F.col("metric") - F.col("last_metric"), digits).alias("metric_change"),
        (F.col("best") & F.col("metric").isNotNull()).alias("best"),
        F.when(F.col("first"), "").otherwise(F.array_join(shown, "; ")).alias("changed_params"),
        (~F.col("first") & (F.col("data") != F.col("last_data"))).alias("other_data"),
        "seconds",
        F.round(F.col("seconds") - F.col("last_seconds"), digits).alias("seconds_change"),
    )


def step_changes(log: DataFrame, digits: int = 4) -> DataFrame:
    """(run_id, step, seconds, change): seconds of each step, and against the same step of the last run that had it."""
    steps = log.where(_one(STEP)).groupBy("run_id", F.col("name").alias("step")).agg(F.sum(F.col("value").cast("double")).alias("seconds"))
    before = F.lag("seconds").over(W.partitionBy("step").orderBy("finished", "run_id"))
    return steps.join(_finished(log), "run_id").select("run_id", "step", "seconds", F.round(F.col("seconds") - before, digits).alias("change"))


def best_run(log: DataFrame, metric: str) -> str | None:
    """The run with the highest measure, the earlier one on ties."""
    found = run_history(log, metric).where("best").select("run_id").first()
    return found["run_id"] if found else None
