"""Alerts counted by event time, and each alert once; both keep state behind a watermark.

A row is late when its window, session or repetition span ended at or before the
watermark that the micro-batch before last left behind (Spark lets a micro-batch
take what only its own watermark would drop). Late rows change nothing that has
been written. State goes as soon as the watermark has passed it, so it is bounded
by the alerts of the allowed delay and not by the length of the stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowgauge.streaming.alerts import ALERTS

START, END, COUNT = "window_start", "window_end", "alerts"
_SPAN = "_span"


def event_time(clock: Column) -> Column:
    """A clock reading without a zone as the same reading in UTC, whatever the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, clock))


def _counted(rows: DataFrame, span: Column, by: Sequence[str]) -> DataFrame:
    counts = rows.groupBy(span.alias(_SPAN), *by).agg(F.count(F.lit(1)).alias(COUNT))
    return counts.select(*by, F.col(f"{_SPAN}.start").alias(START), F.col(f"{_SPAN}.end").alias(END), COUNT)


def window_counts(rows: DataFrame, time: str, size: str, delay: str, by: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """Rows for each window of event time and each value of `by`; a window is written once, when the delay after it has passed.

    With `slide` below `size` windows overlap and a row counts in each of its windows.
    """
    return _counted(rows.withWatermark(time, delay), F.window(time, size, slide), by)


def session_counts(rows: DataFrame, time: str, gap: str, delay: str, by: Sequence[str]) -> DataFrame:
    """Rows for each run of alerts of one value of `by` with less than `gap` between neighbours."""
    return _counted(rows.withWatermark(time, delay), F.session_window(time, gap), by)


def once(rows: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row of each key, as long as repetitions come within the delay.

    A source that delivers again after a failure repeats rows in later
    micro-batches, where a plain `distinct` of a batch would not see them.
    """
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def start_alert_windows(
    spark: SparkSession,
    alert_job: str,
    out: str,
    checkpoint: str,
    key: str,
    time: str,
    size: str,
    delay: str,
    by: Sequence[str] = ("alert",),
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Count the alerts that an alert job writes, by class and window, each alert once.

    The job must keep the event time in its alerts. A micro-batch that it runs again
    after a failure puts its rows into new files, and sources may repeat rows too;
    both count once as long as they come within the delay.
    """
    folder = f"{alert_job}/{ALERTS}"
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    counts = _counted(once(stream, [key], time, delay), F.window(time, size), by)
    return start_to_files(counts, out, checkpoint, trigger)


def start_to_files(
    stream: DataFrame, out: str, checkpoint: str, trigger: Mapping[str, object] | None = None, state_parts: int | None = None
) -> StreamingQuery:
    """Append finished rows to Parquet files; the same checkpoint goes on where the last run ended.

    `state_parts` is the number of parts of the state, by default the session's
    shuffle partitions. It holds from the first start of a checkpoint on, whatever
    later starts ask for. The session has its own setting back once the job runs.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
    conf, name = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(name)
    conf.set(name, str(state_parts or before))
    try:
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        conf.set(name, before)


def open_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows of each window or session that is still counted: the job's state, read from its checkpoint."""
    return spark.read.format("statestore").load(checkpoint).select(F.col("value.count").alias(COUNT))


def alert_balance(counted: DataFrame, still_open: DataFrame, given: DataFrame) -> DataFrame:
    """(kind, alerts): rows in written windows, in open ones, and late ones, which are in neither."""
    parts = {"written": (counted, F.col(COUNT)), "open": (still_open, F.col(COUNT)), "given": (given, F.lit(1))}
    sums = [df.agg(F.sum(value).cast("bigint").alias(COUNT)).select(F.lit(kind).alias("kind"), COUNT) for kind, (df, value) in parts.items()]
    found = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col(COUNT))), F.lit(0)) for k in parts}
    late = found["given"] - found["written"] - found["open"]
    kinds = [F.struct(F.lit(k).alias("kind"), n.alias(COUNT)) for k, n in (("written", found["written"]), ("open", found["open"]), ("late", late))]
    return reduce(DataFrame.unionByName, sums).agg(F.array(*kinds).alias("found")).select(F.inline("found"))
