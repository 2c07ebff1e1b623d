"""Scoring of an unbounded flow table; every step is stateless."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowgauge.jobs import kept
from flowgauge.operators.forests import load_members, score_ensemble

REASON = "reason"
ALERTS, REJECTS, MODELS = "alerts", "rejects", "models"
_VOTED = "_voted"


def read_flow_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def benign_index(labels: Sequence[str], benign: str) -> float:
    """Index of the benign class in the saved label list."""
    if benign not in labels:
        raise ValueError(f"class {benign} is not among the saved labels")
    return float(list(labels).index(benign))


def with_reason(rows: DataFrame, assembler: VectorAssembler, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """Key, kept columns and features as doubles, and why a row cannot be scored: its missing or infinite features.

    Nothing else of a row matters: live rows have no label, and other columns may be null.
    """
    features = assembler.getInputCols()
    absent = [c for c in (key, *keep, *features) if c.lower() not in {x.lower() for x in rows.columns}]
    if absent:
        raise ValueError(f"columns missing in the stream: {', '.join(absent)}")
    kept_columns = dict.fromkeys([key, *[c for c in keep if c not in features]])
    cast = rows.select(*kept_columns, *[F.col(f"`{c}`").try_cast("double").alias(c) for c in features])
    # NaN sorts above infinity, so one comparison finds both.
    faults = [F.when(~F.coalesce(F.abs(F.col(f"`{c}`")) < float("inf"), F.lit(False)), F.lit(c)) for c in features]
    return cast.withColumn(REASON, F.concat_ws(",", *faults))


def score_stream(
    stream: DataFrame,
    models: Sequence[RandomForestClassificationModel],
    assembler: VectorAssembler,
    key: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The rows that can be scored, with member predictions and their vote."""
    usable = with_reason(stream, assembler, key, keep).filter(F.col(REASON) == "").drop(REASON)
    return score_ensemble(assembler.transform(usable), models).drop(assembler.getOutputCol())


def rejected(stream: DataFrame, assembler: VectorAssembler, key: str, keep: Sequence[str] = ()) -> DataFrame:
    """The rows that cannot be scored, with the reason."""
    return with_reason(stream, assembler, key, keep).filter(F.col(REASON) != "")


def alerts(scored: DataFrame, benign: float) -> DataFrame:
    """Rows whose vote is not the benign class.

    A filter on the vote itself would be pushed below it, and every mention of a
    member in the vote would then predict or draw anew; one on a generated column stays.
    """
    voted = scored.withColumn(_VOTED, F.explode(F.array("final_prediction")))
    return voted.filter(F.col(_VOTED) != F.lit(benign)).drop(_VOTED)


def start_alerts(
    stream: DataFrame,
    run_folder: str,
    out: str,
    checkpoint: str,
    key: str,
    benign: str,
    keep: Sequence[str] = (),
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start the alert job of a batch run's saved models.

    Each micro-batch overwrites its own folders below out/alerts and out/rejects,
    so a batch that is run again after a failure is there once. The default
    trigger takes what has arrived and ends; {"processingTime": "1 minute"} runs
    on. Members travel with every micro-batch, so triggers should not be short.
    """
    indexer, assembler, models = load_members(f"{run_folder}/{MODELS}")
    normal = benign_index(indexer.labels, benign)
    names = F.array(*[F.lit(x) for x in indexer.labels])

    def write(rows: DataFrame, number: int) -> None:
        with kept(rows):
            scored = score_stream(rows, models, assembler, key, keep)
            found = alerts(scored, normal).withColumn("alert", F.get(names, F.col("final_prediction").cast("int")))
            found.write.mode("overwrite").parquet(f"{out}/{ALERTS}/batch={number}")
            rejected(rows, assembler, key, keep).write.mode("overwrite").parquet(f"{out}/{REJECTS}/batch={number}")

    start = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return start.trigger(**(trigger or {"availableNow": True})).start()


def run_to_files(stream: DataFrame, out: str, checkpoint: str, timeout: float | None = None) -> DataFrame:
    """Append all rows available now to Parquet files; returns a scan of them.

    The checkpoint makes the sink exactly-once when the job is restarted. A
    timeout in seconds, if one is given, ends a run that takes longer.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    done = query.awaitTermination(timeout) if timeout is not None else (query.awaitTermination(), True)[1]
    if not done:
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
