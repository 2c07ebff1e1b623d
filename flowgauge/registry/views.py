"""Flow views derived from the given tables.

`events` stands for the flow table: one row per event, a skewed class from its
value and type. Member predictions are a hash rule, so that every step after
the model has an exact SQL counterpart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowgauge.functions.hashing import hash_number
from flowgauge.operators.confusion import confusion_long, global_metrics, per_class_metrics
from flowgauge.operators.counting import class_table
from flowgauge.operators.voting import with_vote
from flowgauge.params import CleanParams, ReportParams, TrainParams
from flowgauge.sources.scratch import lookup
from flowgauge.sources.tables import read_report, read_table, report_dir, write_reports

BENIGN = "benign"
CLASSES = ("benign", "flood", "scan", "slow", "brute", "botnet")
CAPS = {"benign": 500, "flood": 500, "scan": 500}
SEED = 42
MEMBERS = 10
# Percent of flows a member gets wrong: the base, and more with each class index,
# so that rarer classes see split votes, ties and lost votes.
WRONG_BASE = 12
WRONG_STEP = 8
TEST_SHARE = 0.2
FOLDS = 5
KEY = "flow_id"
CHOICE = "slow"
REPORT = ReportParams(benign=BENIGN)
CLEAN = CleanParams(cast_columns=("value_txt",))
# Small trees keep a query short; the ensemble and the folds are the library's own.
TRAIN = TrainParams(
    grid_num_trees=(5, 10), grid_max_depth=(3, 5), num_trees=10, max_depth=5, layout=8, parallelism=4
)
FEATURES = ("value", "k", "hour", "user")
# Tasks of the costly stand-in rules; one given file is a single split. Larger flow tables have one for so many rows.
DEALT, DEALT_ROWS = 16, 500_000


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = (
        F.when(F.col("value") < 40, "benign")
        .when(F.col("value") < 80, "flood")
        .when(F.col("value") < 120, "scan")
        .when(F.col("event_type") == "error", "botnet")
        .when(F.col("event_type") == "signup", "brute")
        .otherwise("slow")
    )
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("flow_id"),
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").try_cast("double").alias("k"),
        label.alias("label"),
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows as they arrive: null markers, bad text, infinities, unused columns."""
    place = F.col("flow_id") % 97
    label = F.when(place == 0, "NULL").when(place != 1, F.col("label"))
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    text = (
        F.when(place == 2, "inf")
        .when(place == 3, "-inf")
        .when(place == 4, "NaN")
        .when(place == 5, "TCP")
        .when(place == 6, "")
        .when(place != 7, cents)
    )
    return flows(spark, sf_dir).select(
        "flow_id",
        F.concat(F.lit("10.0.0."), F.col("user_id")).alias("src_ip"),
        F.concat(F.lit("10.0.1."), F.col("user_id")).alias("dst_ip"),
        F.when(F.col("event_type").isin("click", "view"), "TCP").otherwise("UDP").alias("protocol"),
        (F.col("user_id") * 20).alias("total_header_bytes"),
        (F.col("value") / 2).alias("active_min"),
        "user_id",
        "value",
        text.alias("value_txt"),
        "k",
        label.alias("label"),
    )


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup(class_table(flows(spark, sf_dir).select("label")))


def members() -> list[str]:
    return [f"pred_{i}" for i in range(MEMBERS)]


def scored(spark: SparkSession, sf_dir: str, class_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flows with ten member predictions, wrong ones being one of the next two classes, and the kept columns."""
    names = class_rows.select(
        "label", "label_index", F.count(F.lit(1)).over(W.partitionBy()).cast("double").alias("n_classes")
    )
    tasks = max(DEALT, (class_rows.agg(F.sum("count")).first()[0] or 0) // DEALT_ROWS)
    indexed = flows(spark, sf_dir).select("flow_id", "label", *keep).repartition(tasks, KEY).join(names, "label")
    index = F.col("label_index")
    preds = []
    for i, name in enumerate(members()):
        draw = hash_number(F.md5(F.concat_ws("|", F.lit(str(i)), F.col("flow_id").cast("string")))) % 100
        wrong = (index + 1 + draw % 2) % F.col("n_classes")
        preds.append(F.when(draw < WRONG_BASE + WRONG_STEP * index, wrong).otherwise(index).alias(name))
    return indexed.select("flow_id", "label", "label_index", *keep, *preds)


def voted(spark: SparkSession, sf_dir: str, class_rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return with_vote(scored(spark, sf_dir, class_rows, keep), members())


class Report:
    """The report tables as a run writes them, read back from their folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        class_rows = classes(spark, sf_dir)
        confusion = lookup(confusion_long(voted(spark, sf_dir, class_rows)))
        self.base = report_dir(spark)
        tables = {
            "label_counts": class_rows,
            "conf_matrix": confusion,
            "per_class_metrics": per_class_metrics(confusion, class_rows),
            "metrics_wide": global_metrics(confusion),
            "feature_importance": importances(spark, sf_dir),
        }
        write_reports(tables, f"{self.base}/reports")
        self.classes, self.confusion, self.per_class, self.metrics, _ = (
            read_report(spark, f"{self.base}/reports", name) for name in tables
        )
        self.counts = self.classes.select("label", "count")


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for feature importances: summed prices per brand."""
    part = read_table(spark, sf_dir, "part")
    return part.groupBy(F.col("p_brand").alias("feature")).agg(
        (F.sum(F.round(F.col("p_retailprice") * 100).cast("bigint")) / 100.0).alias("importance")
    )


def briefings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents inside a marked-up report frame."""
    doc, text = F.col("doc_id").cast("string"), F.col("text")
    frame = F.concat(
        F.lit("# Report "), doc, F.lit("\n\n## Source **"), F.col("source"), F.lit("**\n### `"), F.col("lang"),
        F.lit("` summary\n| key | value | note |\n|-----|:---:|---|\n| length | "), F.col("n_chars").cast("string"),
        F.lit(" | |\n|  id | **"), doc, F.lit("** | a cell that is longer than thirty characters |\n---\n**Findings "),
        doc, F.lit("**\n- first *point*\n* second `point`\n1. step\n2) step – ✅ done\n   \n"), text,
        F.lit("\n|"), F.col("source"), F.lit("|"),
    )
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return documents.repartition(DEALT, "doc_id").select("doc_id", frame.alias("text"))
