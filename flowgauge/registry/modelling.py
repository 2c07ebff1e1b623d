"""Index, vector, forests and their scores on the flow view."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.operators import forests, voting
from flowgauge.operators.cleaning import drop_incomplete, labelled
from flowgauge.operators.sampling import split
from flowgauge.params import CleanParams, SampleParams
from flowgauge.plans.batch import BatchParams, run_batch
from flowgauge.registry import views as v
from flowgauge.registry.entry import query
from flowgauge.registry.sql import below, bucket, with_views
from flowgauge.sources.scratch import fresh_dir, written
from flowgauge.sources.tables import read_report

_TEST = below(v.SEED, v.TEST_SHARE)
_POINTS = len(v.TRAIN.grid_num_trees) * len(v.TRAIN.grid_max_depth)


def _per_class(*checks: str) -> str:
    """Test rows per class; every check must hold for all of them."""
    counted = "".join(f", count(*) as {c}" for c in checks)
    return with_views(f"select label, count(*) as test_rows{counted} from flows where {_TEST} and k is not null group by label", "flows")


def _checked(rows: DataFrame, **checks) -> DataFrame:
    """Rows per class, and how many of them pass each check."""
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("test_rows"), *[F.count_if(c).alias(n) for n, c in checks.items()])


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.flows(spark, sf_dir).select(
        "flow_id",
        "label",
        "value",
        "k",
        F.hour("ts").cast("double").alias("hour"),
        F.col("user_id").cast("double").alias("user"),
    )
    return drop_incomplete(labelled(rows))


class Prepared:
    """Indexed and assembled flows, split into train and test.

    The features are parsed and written once; index, vectors and streams read them from `path`.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        parsed = feature_rows(spark, sf_dir)
        self.path = fresh_dir(spark, "features")
        parsed.write.parquet(self.path)
        self.rows = spark.read.schema(parsed.schema).parquet(self.path)
        self.indexer = forests.fit_indexer(self.rows)
        self.table = forests.model_input(self.rows, v.FEATURES, self.indexer, v.KEY, v.TRAIN.layout)
        self.train, self.test = split(self.table, v.KEY, v.TEST_SHARE, v.SEED)


@query("index_labels", with_views("select f.flow_id, f.label, c.label_index from flows f join classes c using (label)", "classes"))
def index_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.flows(spark, sf_dir).select("flow_id", "label")
    return forests.fit_indexer(rows).transform(rows)


@query(
    "assemble_features",
    with_views(
        """select flow_id, value as value_at_0, k as value_at_1, hour(ts)::double as value_at_2, user_id::double as value_at_3
           from flows""",
        "flows",
    ),
)
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = forests.assembler(v.FEATURES).transform(feature_rows(spark, sf_dir))
    parts = vector_to_array(F.col("features"))
    return ready.select("flow_id", *[parts[i].alias(f"value_at_{i}") for i in range(len(v.FEATURES))])


@query("rf_predict", _per_class("known_rows", "repeated_rows"))
def rf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with a known class predicted, and with the same class by a second fit of other read splits."""
    data = Prepared(spark, sf_dir)
    model = forests.train_one(data.train, v.TRAIN)
    again = forests.train_one(data.train.repartition(3, "label"), v.TRAIN)
    scored = forests.score_members(data.test, [model, again])
    known = F.col("pred_0").isin(*[float(i) for i in range(len(v.CLASSES))])
    return _checked(scored, known_rows=known, repeated_rows=F.col("pred_0") == F.col("pred_1"))


@query("prediction_export", _per_class("sum_to_one", "largest_is_predicted"))
def prediction_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported rows whose probabilities add up to 1, and whose largest is the prediction's."""
    data = Prepared(spark, sf_dir)
    exported = forests.prediction_export(data.test, forests.train_one(data.train, v.TRAIN))
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    largest = F.array_position("probability", F.array_max("probability")) - 1
    return _checked(exported, sum_to_one=F.abs(total - 1) < 1e-9, largest_is_predicted=largest == F.col("prediction"))


@query("ensemble_predict", _per_class("voted_rows"))
def ensemble_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows whose vote equals a count of the members' predictions by grouping."""
    data = Prepared(spark, sf_dir)
    models = forests.train_ensemble(data.train, v.TRAIN)
    names = forests.pred_columns(models)
    scored = written(forests.score_ensemble(data.test, models).select("flow_id", "label", *names, "final_prediction"), "scored")
    cast = scored.select("flow_id", F.posexplode(F.array(*names)).alias("place", "pred"))
    counted = cast.groupBy("flow_id", "pred").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    most = counted.groupBy("flow_id").agg(F.max_by("pred", F.struct("n", -F.col("first"))).alias("most"))
    return _checked(scored.join(most, "flow_id"), voted_rows=F.col("most") == F.col("final_prediction"))


@query(
    "mean_importance",
    f"""select feature, {v.TRAIN.n_models} as members, 1.0::double as total from (values {", ".join(f"('{x}')" for x in v.FEATURES)}) t(feature)
        where (select count(*) from events) > 0""",
)
def mean_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature, the members whose own importances it averages, and what all features add up to."""
    data = Prepared(spark, sf_dir)
    models = forests.train_ensemble(data.train, v.TRAIN)
    mean = forests.mean_importance(models, v.FEATURES, data.train)
    rows = [(n, float(x)) for m in models for n, x in zip(v.FEATURES, m.featureImportances.toArray())]
    own = spark.createDataFrame(rows, "feature string, own double").join(mean, "feature")
    off = F.abs(F.avg("own") - F.first("importance")) < 1e-12
    per_feature = own.groupBy("feature").agg(F.when(off, F.count(F.lit(1))).alias("members"), F.first("importance").alias("i"))
    return per_feature.select("feature", F.col("members").cast("int"), F.round(F.sum("i").over(W.partitionBy()), 9).alias("total"))


@query(
    "model_reload",
    with_views(
        f"""select label, count(*) as scored_rows, 0::bigint as changed_rows
            from flows where {_TEST} and k is not null group by label""",
        "flows",
    ),
)
def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows per class, and how many of them score otherwise after a reload."""
    data = Prepared(spark, sf_dir)
    models = forests.train_ensemble(data.train, v.TRAIN)
    path = fresh_dir(spark, "models")
    forests.save_members(models, data.indexer, v.FEATURES, path)
    _, _, loaded = forests.load_members(path)
    names = forests.pred_columns(models)
    before = forests.score_members(data.test, models).withColumnsRenamed({n: f"{n}_before" for n in names})
    after = forests.score_members(before, loaded)
    changed = F.lit(False)
    for n in names:
        changed = changed | (F.col(n) != F.col(f"{n}_before"))
    return after.groupBy("label").agg(
        F.count(F.lit(1)).alias("scored_rows"), F.count_if(changed).alias("changed_rows")
    )


def _fold_scores(data: Prepared) -> DataFrame:
    return forests.fold_scores(forests.folded(data.train, v.KEY, v.TRAIN), v.TRAIN)


_GRID = f"""from (values {", ".join(f"({t})" for t in v.TRAIN.grid_num_trees)}) a(num_trees)
    cross join (values {", ".join(f"({d})" for d in v.TRAIN.grid_max_depth)}) b(max_depth)"""


@query(
    "cv_grid_scores",
    with_views(
        f"""select fold, num_trees, max_depth, held_rows, true as is_share
            from (select {bucket(f'fold:{v.SEED}', v.TRAIN.n_folds)}::int as fold, count(*) as held_rows
                  from flows where not ({_TEST}) and k is not null group by 1) f
            cross join (select num_trees, max_depth {_GRID}) g""",
        "flows",
    ),
)
def cv_grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows of each fold and grid point, and whether the score is a share; tests compare the scores with MLlib's."""
    scores = _fold_scores(Prepared(spark, sf_dir))
    return scores.select("fold", "num_trees", "max_depth", "held_rows", F.col("f1").between(0.3, 1).alias("is_share"))


@query("cv_best_params", f"select {_POINTS}::bigint as points, 0::bigint as better_points where (select count(*) from events) > 0")
def cv_best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid points, and those that score better than the chosen one, or as well with a smaller forest."""
    scores = forests.mean_scores(_fold_scores(Prepared(spark, sf_dir)))
    best = forests.best_params(scores).select(F.struct("f1", -F.col("max_depth"), -F.col("num_trees"))).scalar()
    mine = F.struct("f1", -F.col("max_depth"), -F.col("num_trees"))
    return scores.agg(F.count(F.lit(1)).alias("points"), F.count_if(mine > best).alias("better_points"))


@query(
    "cv_gap",
    with_views(
        f"""select num_trees, max_depth, true as is_difference,
                   (select count(*) from flows where {_TEST} and k is not null) as test_rows {_GRID}""",
        "flows",
    ),
)
def cv_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validation score against test score at each grid point: the test rows, and whether the gap is their difference."""
    data = Prepared(spark, sf_dir)
    points = forests.grid_points(v.TRAIN)
    cv = forests.mean_scores(_fold_scores(data))
    gap = forests.score_gap(cv, forests.test_scores(data.test, points, forests.fit_points(data.train, points)))
    same = F.abs((F.col("cv_f1") - F.col("test_f1")) * 100 - F.col("gap_points")) < 1e-9
    shares = F.col("cv_f1").between(0, 1) & F.col("test_f1").between(0, 1)
    return gap.select("num_trees", "max_depth", (same & shares).alias("is_difference"), F.lit(data.test.count()).alias("test_rows"))


@query(
    "ensemble_coverage",
    with_views(f"select label, count(*) as scored_rows from flows where {_TEST} and k is not null group by label", "flows"),
)
def ensemble_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows per class that got a vote one of their members cast."""
    data = Prepared(spark, sf_dir)
    scored = forests.score_ensemble(data.test, forests.train_ensemble(data.train, v.TRAIN))
    cast = voting.agreement([f"pred_{i}" for i in range(v.TRAIN.n_models)]) > 0
    return scored.groupBy("label").agg(F.count_if(cast).alias("scored_rows"))




_RAW = T.StructType(
    [
        T.StructField("flow_id", T.LongType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("packets_count", T.DoubleType()),
        T.StructField("src_port", T.DoubleType()),
        T.StructField("total_header_bytes", T.LongType()),
        T.StructField("label", T.StringType()),
    ]
)


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """The dirty flow view as CSV files under the names of a flow table."""
    path = fresh_dir(spark, "raw-csv")
    v.dirty(spark, sf_dir).select(
        "flow_id",
        "src_ip",
        "protocol",
        F.col("value").alias("Duration"),
        F.col("value_txt").alias("Packets Count"),
        F.col("user_id").alias("src port"),
        "total_header_bytes",
        "label",
    ).write.option("header", True).csv(path)
    return path


BATCH = BatchParams(
    sample=SampleParams(class_limits=v.CAPS, seed=v.SEED, test_share=v.TEST_SHARE),
    clean=CleanParams(cast_columns=("duration", "packets_count", "src_port")),
    train=v.TRAIN,
)
_CLEAN = "label <> 'NULL' and isfinite(try_cast(value_txt as double))"


@query("batch_run", with_views(f"select label, count(*) as test_rows from dirty where {_CLEAN} and {_TEST} group by label", "dirty"))
def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job from CSV files to report tables: test rows per class, from the written class metrics."""
    result = run_batch(spark, raw_csv(spark, sf_dir), fresh_dir(spark, "batch"), BATCH, _RAW)
    per_class = read_report(spark, f"{result.path}/reports", "per_class_metrics")
    return per_class.select("label", (F.col("tp") + F.col("fn")).alias("test_rows"))


_CAPPED = "case label " + " ".join(f"when '{c}' then {n}" for c, n in v.CAPS.items()) + " end"


@query(
    "batch_train_rows",
    with_views(
        f"""select label, least(count(*), coalesce({_CAPPED}, count(*))) as "count"
            from dirty where {_CLEAN} and not ({_TEST}) group by label""",
        "dirty",
    ),
)
def batch_train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class that fit the forests of the job, capped after the split."""
    params = replace(BATCH, search=False)
    result = run_batch(spark, raw_csv(spark, sf_dir), fresh_dir(spark, "batch"), params, _RAW)
    return read_report(spark, f"{result.path}/reports", "train_counts")
