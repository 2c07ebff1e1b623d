"""Stream scoring and alerts, run to the end of the files that have arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.operators import forests
from flowgauge.operators.voting import agreement, with_vote
from flowgauge.registry import views as v
from flowgauge.registry.entry import query
from flowgauge.registry.modelling import Prepared
from flowgauge.registry.sql import with_views
from flowgauge.sources.scratch import fresh_dir, written
from flowgauge.streaming import alerts as ops
from flowgauge.streaming import windows

DAY = 86_400
# The given flows span thirty days from this second on.
FIRST_SECOND = 1_704_067_200
WINDOW, WINDOW_DELAY = "6 hours", "12 hours"
GAP, GAP_DELAY = "6 hours", "11 days"
REPEAT_DELAY = "16 days"
SLICE_DAYS = 5
STATE_PARTS = 4
# Rows of a delivery for which it has one more file, and the state one more part.
PART_ROWS = 100_000


def arriving(df: DataFrame, spark: SparkSession) -> str:
    """A folder of Parquet files holding all rows of df."""
    path = fresh_dir(spark, "arrivals")
    df.write.parquet(path)
    return path


@query(
    "stream_alerts",
    with_views(
        """select flow_id, label, final_prediction from voted
           where final_prediction <> (select label_index from classes where label = 'benign')""",
        "voted",
    ),
)
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    class_rows = v.classes(spark, sf_dir)
    rows = v.scored(spark, sf_dir, class_rows)
    path = arriving(rows, spark)
    labels = [r["label"] for r in class_rows.orderBy("label_index").collect()]
    stream = ops.read_flow_stream(spark, path, rows.schema)
    found = ops.alerts(with_vote(stream, v.members()), ops.benign_index(labels, v.BENIGN))
    columns = found.select("flow_id", "label", "final_prediction")
    return ops.run_to_files(columns, fresh_dir(spark, "alerts"), fresh_dir(spark, "alerts-progress"))


def _timed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts with the time of their flow, and the delivery that brings them.

    A delivery holds the flows of some days; of every 11 flows one comes a delivery later.
    """
    class_rows = v.classes(spark, sf_dir)
    labels = [r["label"] for r in class_rows.orderBy("label_index").collect()]
    voted = v.voted(spark, sf_dir, class_rows, keep=("user_id", "ts")).where(F.col(v.KEY).isNotNull())
    at = windows.event_time(F.col("ts")).alias("at")
    found = ops.alerts(voted, ops.benign_index(labels, v.BENIGN)).select("flow_id", "final_prediction", "user_id", at)
    day = F.floor((F.unix_micros("at") - FIRST_SECOND * 1_000_000) / (DAY * SLICE_DAYS * 1_000_000))
    return found.withColumn("delivery", (day + F.when(F.col("flow_id") % 11 == 3, 1).otherwise(0)).cast("int"))


def _delivered(rows: DataFrame, times: int = 1, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """(stream, batch, parts) of the rows: deliveries in order, one to a micro-batch; each comes `times` times over.

    All deliveries have the same number of files, which the stream takes at once: one
    for every `part_rows` rows of the largest. `parts` is a size of state to go with it.
    """
    spark = rows.sparkSession
    kept = written(rows, "deliveries", by=["delivery"])
    sizes = dict(kept.groupBy("delivery").count().collect())
    files = max([1, *(-(-n // part_rows) for n in sizes.values())])
    path, due = fresh_dir(spark, "arrivals"), 0
    for number in sorted(sizes):
        delivery = kept.where(F.col("delivery") == number)
        for _ in range(times):
            delivery.repartition(files).write.mode("append").parquet(path)
            due += files
            # A part without rows leaves no file; an empty one stands for it.
            for _ in range(due - len(spark.read.schema(kept.schema).parquet(path).inputFiles())):
                delivery.limit(0).coalesce(1).write.mode("append").parquet(path)
    return ops.read_flow_stream(spark, path, kept.schema, files_per_trigger=files), kept, max(STATE_PARTS, files)


def _run(stream: DataFrame, parts: int) -> tuple[DataFrame, str]:
    """What the job writes until the deliveries end, and its checkpoint."""
    spark = stream.sparkSession
    out, checkpoint = fresh_dir(spark, "windows"), fresh_dir(spark, "windows-progress")
    windows.start_to_files(stream, out, checkpoint, state_parts=parts).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out), checkpoint


# Delivered alerts, and the watermark in microseconds that the micro-batch of delivery n drops late rows by.
_ALERTS = f"""
    alerts as (
        select v.flow_id, v.final_prediction, f.user_id, epoch_us(f.ts) as us,
               (epoch_us(f.ts) - {FIRST_SECOND * 1_000_000}) // {DAY * SLICE_DAYS * 1_000_000}
               + case when v.flow_id % 11 = 3 then 1 else 0 end as delivery
        from voted v join flows f using (flow_id)
        where v.final_prediction <> (select label_index from classes where label = 'benign'))"""


def _watermark(rows: str, hours: int) -> str:
    return f"coalesce((select (max(us) // 1000 - {hours} * 3600000) * 1000 from {rows}), 0)"


_WINDOWED = f"""
    numbered as (select *, dense_rank() over (order by delivery) as batch, us // 21600000000 * 21600000000 as began from alerts),
    batches as (select distinct batch from numbered),
    marks as (select b.batch, {_watermark("numbered n where n.batch < b.batch - 1", 12)} as mark from batches b),
    final as (select {_watermark("numbered", 12)} as mark),
    judged as (select n.*, began + 21600000000 > m.mark as in_time, began + 21600000000 <= (select mark from final) as closed
               from numbered n join marks m using (batch))"""


@query(
    "stream_alert_windows",
    with_views("", "voted", "flows").rstrip() + "," + _ALERTS + "," + _WINDOWED + """
        select 'window' as kind, final_prediction, began // 1000000 as window_start, count(*) as alerts
        from judged where in_time and closed group by all
        union all select 'written', null, null, count(*) filter (where in_time and closed) from judged
        union all select 'open', null, null, count(*) filter (where in_time and not closed) from judged
        union all select 'late', null, null, count(*) filter (where not in_time) from judged""",
)
def stream_alert_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts per class and window of event time from deliveries out of order, and the rows written, open and late."""
    stream, given, parts = _delivered(_timed_alerts(spark, sf_dir))
    counts, checkpoint = _run(windows.window_counts(stream, "at", WINDOW, WINDOW_DELAY, by=["final_prediction"]), parts)
    balance = windows.alert_balance(counts, windows.open_counts(spark, checkpoint), given)
    found = counts.select(
        F.lit("window").alias("kind"), "final_prediction", F.unix_seconds(windows.START).alias("window_start"), windows.COUNT
    )
    return found.unionByName(balance, allowMissingColumns=True)


@query(
    "stream_alert_sessions",
    with_views("", "voted", "flows").rstrip() + "," + _ALERTS + f"""
        , steps as (select *, case when us - lag(us) over w < 21600000000 then 0 else 1 end as begins
                    from alerts window w as (partition by user_id order by us)),
        sessions as (select *, sum(begins) over (partition by user_id order by us rows unbounded preceding) as session from steps),
        spans as (select user_id, min(us) as began, max(us) + 21600000000 as ended, count(*) as alerts
                  from sessions group by user_id, session)
        select user_id, began as window_start, ended as window_end, alerts from spans
        where ended <= {_watermark("alerts", 264)}""",
)
def stream_alert_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of alerts of one user, from deliveries out of order; those that the watermark has closed."""
    stream, _, parts = _delivered(_timed_alerts(spark, sf_dir))
    counts, _ = _run(windows.session_counts(stream, "at", GAP, GAP_DELAY, by=["user_id"]), parts)
    start, end = (F.unix_micros(c).alias(c) for c in (windows.START, windows.END))
    return counts.select("user_id", start, end, windows.COUNT)


@query(
    "stream_alerts_once",
    with_views("", "voted", "flows").rstrip() + "," + _ALERTS + " select flow_id, final_prediction, user_id from alerts",
)
def stream_alerts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of deliveries that all come twice: each of them once."""
    stream, _, parts = _delivered(_timed_alerts(spark, sf_dir), times=2)
    found, _ = _run(windows.once(stream, ["flow_id"], "at", REPEAT_DELAY), parts)
    return found.select("flow_id", "final_prediction", "user_id")


def _scored_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(stream result, batch result) of the same flows and members.

    Members are trained and saved once; the stream only loads and applies them.
    """
    data = Prepared(spark, sf_dir)
    models = forests.train_ensemble(data.train, v.TRAIN)
    saved = fresh_dir(spark, "models")
    forests.save_members(models, data.indexer, v.FEATURES, saved)
    _, assembler, loaded = forests.load_members(saved)

    stream = ops.read_flow_stream(spark, data.path, data.rows.schema)
    scored = ops.score_stream(stream, loaded, assembler, v.KEY, keep=("label",))
    columns = scored.select("flow_id", "label", *forests.pred_columns(models), "final_prediction")
    done = ops.run_to_files(columns, fresh_dir(spark, "scored"), fresh_dir(spark, "scored-progress"))
    return done, forests.score_ensemble(data.table, models)


@query("stream_scored", with_views("select flow_id, label, true as known from flows where k is not null", "flows"))
def stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every streamed row, and whether its vote is a class that one of its members named."""
    scored = _scored_stream(spark, sf_dir)[0]
    return scored.select("flow_id", "label", (agreement(forests.pred_columns(range(v.TRAIN.n_models))) > 0).alias("known"))


def unequal_keys(found: DataFrame, expected: DataFrame) -> DataFrame:
    """The keys that one table has more often than the other, both read once."""
    key = found.columns[0]
    sides = [df.select(F.col(key).alias("key"), F.lit(n).alias("n")) for df, n in ((found, 1), (expected, -1))]
    return sides[0].unionByName(sides[1]).groupBy("key").agg(F.sum("n").alias("more")).where("more <> 0")


@query(
    "stream_rejects",
    with_views(
        """select reason, count(*) as "rows" from (
             select concat_ws(',', case when not coalesce(isfinite(try_cast(value_txt as double)), false) then 'value' end,
                                   case when k is null then 'k' end) as reason from dirty)
           where reason <> '' group by reason
           union all select 'scored', count(*) from dirty where k is not null and isfinite(try_cast(value_txt as double))""",
        "dirty",
    ),
)
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert job on dirty rows without labels: rows left out by reason, and rows scored."""
    data = Prepared(spark, sf_dir)
    folder = fresh_dir(spark, "run")
    models = forests.train_ensemble(data.train, v.TRAIN)
    forests.save_members(models, data.indexer, v.FEATURES, f"{folder}/{ops.MODELS}")
    hour, user = (F.col("flow_id") % 24).alias("hour"), F.col("user_id").alias("user")
    rows = v.dirty(spark, sf_dir).select("flow_id", "src_ip", F.col("value_txt").alias("value"), "k", hour, user)
    stream = ops.read_flow_stream(spark, arriving(rows, spark), rows.schema)
    out = fresh_dir(spark, "alert-job")
    job = ops.start_alerts(stream, folder, out, fresh_dir(spark, "alert-progress"), v.KEY, v.BENIGN, keep=("src_ip",))
    job.awaitTermination()
    left_out = spark.read.parquet(f"{out}/{ops.REJECTS}").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    _, assembler, loaded = forests.load_members(f"{folder}/{ops.MODELS}")
    batch = ops.score_stream(rows, loaded, assembler, v.KEY)
    expected = ops.alerts(batch, ops.benign_index(data.indexer.labels, v.BENIGN)).select("flow_id")
    alerted = spark.read.parquet(f"{out}/{ops.ALERTS}").select("flow_id")
    if unequal_keys(alerted, expected).count():
        raise AssertionError("alerts of the job differ from those of a batch")
    return left_out.unionByName(batch.agg(F.lit("scored").alias("reason"), F.count(F.lit(1)).alias("rows")))


@query(
    "stream_agreement",
    with_views("select label, count(*) as streamed, count(*) as agreeing from flows where k is not null group by label", "flows"),
)
def stream_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed rows per class, and how many got the vote that a batch run gives."""
    streamed, batch = _scored_stream(spark, sf_dir)
    batch_votes = batch.select("flow_id", F.col("final_prediction").alias("batch_vote"))
    return streamed.join(batch_votes, "flow_id", "left").groupBy("label").agg(
        F.count(F.lit(1)).alias("streamed"),
        F.count_if(F.col("final_prediction") == F.col("batch_vote")).alias("agreeing"),
    )
