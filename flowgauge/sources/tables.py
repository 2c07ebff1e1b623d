"""Parquet tables, report folders and the metrics record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from flowgauge.jobs import FILES_AT_ONCE, together
from flowgauge.sources.scratch import fresh_dir

REPORT_TABLES = (
    "feature_importance", "label_counts", "conf_matrix",
    "metrics", "detection_rates", "per_class_metrics",
)


class MissingReport(FileNotFoundError):
    """A report table has not been written."""


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet table and return a scan of what was written."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_reports(tables: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    """Write each report table as Parquet below base, replacing older ones."""
    paths = {name: f"{base}/{name}" for name in tables}

    def write(name: str) -> None:
        tables[name].write.mode("overwrite").parquet(paths[name])

    together(write, list(tables), FILES_AT_ONCE)
    return paths


def read_report(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One written report table; a missing one is an error, never sample data, and other faults stay what they are."""
    try:
        return spark.read.parquet(f"{base}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingReport(f"report table {name} not found below {base}; run the export first") from error


def write_metrics(metrics: DataFrame, path: str) -> DataFrame:
    """Store the one-row metrics record as JSON and read it back."""
    metrics.write.mode("overwrite").json(path)
    return metrics.sparkSession.read.schema(metrics.schema).json(path)


def report_dir(spark: SparkSession) -> str:
    """A fresh report folder for one run."""
    return fresh_dir(spark, "reports")
