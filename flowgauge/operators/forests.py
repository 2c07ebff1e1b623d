"""Label index, feature vector, forests, grid search and the voted ensemble."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions.hashing import hash_bucket
from flowgauge.jobs import FILES_AT_ONCE, kept, together
from flowgauge.operators.confusion import pattern_scores, prediction_scores, vote_patterns
from flowgauge.operators.sampling import with_fold
from flowgauge.operators.voting import with_vote
from flowgauge.params import LAYOUT, TrainParams
from flowgauge.sources.scratch import written

LABEL, INDEX, FEATURES = "label", "label_index", "features"
PLACE = "layout_place"
PREPARATION = "preparation"
MANIFEST = "manifest"


def fit_indexer(df: DataFrame) -> StringIndexerModel:
    """Class index by falling frequency, ties by name; unknown labels are an error."""
    return StringIndexer(inputCol=LABEL, outputCol=INDEX, stringOrderType="frequencyDesc", handleInvalid="error").fit(df)


def for_scoring(indexer: StringIndexerModel) -> StringIndexerModel:
    """The same index, leaving out rows whose label was never seen."""
    return indexer.copy().setHandleInvalid("skip")


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES)


def model_input(
    df: DataFrame, features: Sequence[str], indexer: StringIndexerModel, key: str, layout: int = LAYOUT
) -> DataFrame:
    """Indexed and assembled rows, written once, with the layout place of each row.

    The place is drawn from the row key, so it depends on neither the cores nor
    the splits of a read. Give a larger layout for larger tables: it is the
    number of tasks of a fit.
    """
    ready = assembler(features).transform(indexer.transform(df))
    return written(ready.select(key, LABEL, INDEX, FEATURES, hash_bucket("layout", layout, key).cast("int").alias(PLACE)), "model-input")


def arranged(train: DataFrame, layout: int = LAYOUT) -> DataFrame:
    """Training rows laid out by place, each partition in the order of the key.

    A forest draws its samples partition by partition; this order makes a fit
    repeat on any cluster.
    """
    key = train.columns[0]
    return train.repartitionById(layout, F.col(PLACE)).sortWithinPartitions(key)


def forest(params: TrainParams, seed: int) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=INDEX, featuresCol=FEATURES, numTrees=params.num_trees, maxDepth=params.max_depth, seed=seed
    )


def train_ensemble(train: DataFrame, params: TrainParams) -> list[RandomForestClassificationModel]:
    """n_models forests with seeds seed, seed + 1, ..; some are fitted side by side."""
    rows = arranged(train, params.layout)
    with kept(rows):
        return together(
            lambda member: forest(params, params.seed + member).fit(rows), range(params.n_models), params.parallelism
        )


def train_one(train: DataFrame, params: TrainParams) -> RandomForestClassificationModel:
    """One forest with the settings' seed."""
    return forest(params, params.seed).fit(arranged(train, params.layout))


@dataclass(frozen=True)
class GridResult:
    """Mean fold score of each grid point, and the best one fitted on all rows."""

    scores: DataFrame
    best: TrainParams
    model: RandomForestClassificationModel


def grid_points(params: TrainParams) -> list[TrainParams]:
    return [
        replace(params, num_trees=trees, max_depth=depth)
        for trees in params.grid_num_trees
        for depth in params.grid_max_depth
    ]


def folded(train: DataFrame, key: str, params: TrainParams) -> DataFrame:
    """The training rows with their fold, written once for all folds."""
    return written(with_fold(train.select(key, LABEL, INDEX, FEATURES, PLACE), key, params.n_folds, params.seed), "folds")


def fold_scores(rows: DataFrame, params: TrainParams) -> DataFrame:
    """(fold, num_trees, max_depth, held_rows, f1) of every grid point on each fold's held-out rows.

    The folds run side by side and each trains its points in turn. All grid
    points of a fold are scored in one pass over its held-out rows, where one
    evaluator per point would read them once for each.
    """
    points = grid_points(params)
    names = pred_columns(points)

    def one(fold: int) -> list[tuple]:
        models = fit_points(rows.filter(F.col("fold") != fold), [replace(p, parallelism=1) for p in points])
        held_out = rows.filter(F.col("fold") == fold)
        patterns = vote_patterns(score_members(held_out, models), names)
        with kept(patterns):
            n = patterns.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
            found = {r.model: r.f1_score for r in pattern_scores(patterns, names).collect()}
        return [(fold, p.num_trees, p.max_depth, n, found[name]) for name, p in zip(names, points)]

    scored = together(one, range(params.n_folds), params.parallelism)
    return rows.sparkSession.createDataFrame(
        [r for fold in scored for r in fold], "fold int, num_trees int, max_depth int, held_rows long, f1 double"
    )


def mean_scores(scores: DataFrame) -> DataFrame:
    """(num_trees, max_depth, f1): the mean over the folds."""
    return scores.groupBy("num_trees", "max_depth").agg(F.avg("f1").alias("f1"))


def grid_search(train: DataFrame, key: str, params: TrainParams) -> GridResult:
    """k-fold cross validation of the tree-count and depth grid on weighted F1; the best point is fitted on all rows."""
    scores = mean_scores(fold_scores(folded(train, key, params), params))
    chosen = best_params(scores).first()
    best = replace(params, num_trees=chosen.num_trees, max_depth=chosen.max_depth)
    return GridResult(scores, best, train_one(train, best))


def fit_points(train: DataFrame, points: Sequence[TrainParams]) -> list[RandomForestClassificationModel]:
    """One forest per setting, all with the same seed."""
    rows = arranged(train, points[0].layout)
    with kept(rows):
        return together(lambda p: forest(p, p.seed).fit(rows), points, points[0].parallelism)


def best_params(scores: DataFrame) -> DataFrame:
    """The row with the best score; ties go to the shallower, then smaller forest."""
    rank = F.struct("f1", (-F.col("max_depth")).alias("d"), (-F.col("num_trees")).alias("t"))
    best = F.max_by(F.struct("num_trees", "max_depth", "f1"), rank)
    return scores.agg(best.alias("best")).select("best.*")


def test_scores(
    test: DataFrame, points: Sequence[TrainParams], models: Sequence[RandomForestClassificationModel]
) -> DataFrame:
    """(num_trees, max_depth, f1): score on the test rows of models fitted with these settings."""
    names = pred_columns(points)
    found = {r.model: r.f1_score for r in prediction_scores(score_members(test, models), names).collect()}
    rows = [(p.num_trees, p.max_depth, found[n]) for n, p in zip(names, points)]
    return test.sparkSession.createDataFrame(rows, "num_trees int, max_depth int, f1 double")


def score_gap(cv_scores: DataFrame, test_scores: DataFrame) -> DataFrame:
    """CV score against test score per setting; a large gap points to overfitting."""
    keys = ["num_trees", "max_depth"]
    return cv_scores.withColumnRenamed("f1", "cv_f1").join(
        test_scores.withColumnRenamed("f1", "test_f1"), keys
    ).withColumn("gap_points", (F.col("cv_f1") - F.col("test_f1")) * 100.0)


def pred_columns(models: Sequence) -> list[str]:
    return [f"pred_{i}" for i in range(len(models))]


def score_members(df: DataFrame, models: Sequence[RandomForestClassificationModel]) -> DataFrame:
    """Adds pred_0.. in one plan; raw scores and probabilities are never made."""
    for name, model in zip(pred_columns(models), models):
        silent = model.copy().setPredictionCol(name).setRawPredictionCol("").setProbabilityCol("")
        df = silent.transform(df)
    return df


def score_ensemble(df: DataFrame, models: Sequence[RandomForestClassificationModel]) -> DataFrame:
    """Adds the members' predictions and their majority vote, without a join."""
    return with_vote(score_members(df, models), pred_columns(models))


def prediction_export(df: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """Label, index, prediction and class probabilities as an array."""
    return model.transform(df).select(
        LABEL, INDEX, "prediction", vector_to_array(F.col("probability")).alias("probability")
    )


def mean_importance(models: Sequence[RandomForestClassificationModel], features: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance): mean over the members, largest first."""
    rows = [
        (name, float(value))
        for model in models
        for name, value in zip(features, model.featureImportances.toArray())
    ]
    per_member = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    mean = per_member.groupBy("feature").agg(F.avg("importance").alias("importance"))
    return mean.orderBy(F.desc("importance"), "feature")


def save_members(
    models: Sequence[RandomForestClassificationModel], indexer: StringIndexerModel, features: Sequence[str], path: str
) -> list[str]:
    """Save the members as model_0.. and, once for all, their index and assembler.

    The index is fitted once and saved with the members, so that every later
    scoring numbers the classes alike. A manifest, written last, holds how many
    members there are.
    """
    parts = {f"{path}/model_{i}": m for i, m in enumerate(models)}
    parts[f"{path}/{PREPARATION}"] = PipelineModel([for_scoring(indexer), assembler(features)])

    def save(target: str) -> str:
        parts[target].write().overwrite().save(target)
        return target

    saved = together(save, list(parts), FILES_AT_ONCE)
    manifest = SparkSession.active().createDataFrame([(len(models),)], "members int")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")
    return saved


def load_members(path: str) -> tuple[StringIndexerModel, VectorAssembler, list[RandomForestClassificationModel]]:
    """(indexer, assembler, forests) as saved by save_members; all members that its manifest counts."""
    members = SparkSession.active().read.schema("members int").json(f"{path}/{MANIFEST}").first()["members"]
    readers = [(PipelineModel, PREPARATION)]
    readers += [(RandomForestClassificationModel, f"model_{i}") for i in range(members)]
    (preparation, *models) = together(lambda r: r[0].load(f"{path}/{r[1]}"), readers, FILES_AT_ONCE)
    return preparation.stages[0], preparation.stages[1], models
