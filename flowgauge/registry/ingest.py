"""Sources and sinks. Files are written from the whole flow view first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.operators import confusion as ops
from flowgauge.registry import views as v
from flowgauge.registry.entry import query
from flowgauge.registry.sql import with_views
from flowgauge.sources import contract, csv_files
from flowgauge.sources.scratch import fresh_dir, written
from flowgauge.sources.tables import read_table, replace_table, write_metrics

_TYPES = T.StructType(
    [
        T.StructField("flow_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("bytes_s", T.DoubleType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)
# Header spellings of three exporters; the second orders its columns otherwise,
# the third has no event type.
_BATCHES = {
    "a": {"flow_id": "flow_id", "user_id": "user_id", "bytes_s": "bytes_s", "event_type": "event_type", "label": "label"},
    "b": {"label": "Label", "bytes_s": "Bytes/s", "flow_id": "Flow ID", "event_type": "Event Type", "user_id": "USER ID"},
    "c": {"flow_id": "flow_id", "bytes_s": "bytes/s", "user_id": "user id", "label": "label"},
}


def _wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.flows(spark, sf_dir).select("flow_id", "user_id", F.col("value").alias("bytes_s"), "event_type", "label")


def _csv_batches(spark: SparkSession, sf_dir: str) -> str:
    """All flows as CSV, a third of them in each exporter's spelling."""
    base = fresh_dir(spark, "csv")
    rows = _wire(spark, sf_dir)
    for place, (batch, names) in enumerate(_BATCHES.items()):
        part = rows.filter(F.col("flow_id") % len(_BATCHES) == place)
        part.select(*[F.col(c).alias(n) for c, n in names.items()]).write.option("header", True).csv(f"{base}/{batch}")
    return base


_WIRE_SQL = "select flow_id, user_id, value as bytes_s, {} as event_type, label from flows"


@query("csv_scan", with_views(_WIRE_SQL.format("event_type"), "flows"))
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "csv")
    _wire(spark, sf_dir).write.option("header", True).csv(path)
    return csv_files.scan_csv(spark, path, _TYPES, strict_header=True)


@query(
    "csv_union_by_name",
    with_views(_WIRE_SQL.format("case when flow_id % 3 <> 2 then event_type end"), "flows"),
)
def csv_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_files.read_by_name(spark, _csv_batches(spark, sf_dir), _TYPES)


@query("normalise_columns", with_views(_WIRE_SQL.format("event_type"), "flows"))
def normalise_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = _wire(spark, sf_dir).select(*[F.col(c).alias(f" {n} ") for c, n in _BATCHES["b"].items()])
    return csv_files.normalise_columns(spelled)


@query(
    "rows_per_file",
    with_views(
        """select case flow_id % 3 when 0 then 'a' when 1 then 'b' else 'c' end as batch, count(*) as "rows"
           from flows group by all""",
        "flows",
    ),
)
def rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per file, summed by exporter, as Spark names its files at random."""
    base = _csv_batches(spark, sf_dir)
    scan = spark.read.option("header", True).option("recursiveFileLookup", True).csv(base)
    batch = F.regexp_extract("file", "/([^/]+)/[^/]+$", 1).alias("batch")
    return csv_files.rows_per_file(scan).groupBy(batch).agg(F.sum("rows").alias("rows"))


@query("parquet_scan", "select event_id, user_id, event_type, value from events")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


@query("parquet_roundtrip", with_views("select flow_id, user_id, value, k, label from flows", "flows"))
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = v.flows(spark, sf_dir).select("flow_id", "user_id", "value", "k", "label")
    return replace_table(rows, fresh_dir(spark, "flows"))


_EXPECTED = T.StructType(
    [
        T.StructField("flow_id", T.LongType()),
        T.StructField("value_txt", T.DoubleType()),
        T.StructField("protocol", T.DoubleType()),
        T.StructField("label", T.StringType()),
        T.StructField("window_bytes", T.DoubleType()),
    ]
)


def _schema_sql(whole: str) -> str:
    """Empty text is null in a CSV file."""
    parts = []
    filled = "nullif({}::varchar, '')"
    for name, kind, sql_type in (
        ("flow_id", "bigint", "bigint"), ("value_txt", "double", "double"),
        ("protocol", "double", "double"), ("label", "string", "varchar"),
    ):
        parts.append(
            f"""select '{name}' as "column", '{kind}' as expected, true as present,
                       count(*) filter (where {whole} and {filled.format(name)} is not null and try_cast({name} as {sql_type}) is null) as bad_values,
                       count(*) filter (where {whole} and {filled.format(name)} is null) as null_values from dirty"""
        )
    parts.append("select 'window_bytes', 'double', false, 0::bigint, count(*) filter (where " + whole + ") from dirty")
    return " union all ".join(parts)


_RAGGED = "flow_id % 41"
_SHAPE = f"""select '(row)' as "column", 'values as in the header' as expected, true as present,
    count(*) filter (where {_RAGGED} in (1, 2)) as bad_values, 0::bigint as null_values from dirty"""


@query("schema_report", with_views(f"{_schema_sql(f'{_RAGGED} not in (1, 2)')} union all {_SHAPE}", "dirty"))
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of CSV files some of whose rows have a value too many or too few."""
    path = fresh_dir(spark, "ragged")
    place = F.col("flow_id") % 41
    line = F.concat_ws(",", "flow_id", F.coalesce("value_txt", F.lit("")), "protocol", F.coalesce("label", F.lit("")))
    ragged = F.when(place == 1, F.concat(line, F.lit(",9"))).when(place == 2, F.col("flow_id").cast("string")).otherwise(line)
    # Whole lines under a whole header: with another separator, the writer leaves the commas alone.
    lines = v.dirty(spark, sf_dir).select(ragged.alias("flow_id,value_txt,protocol,label"))
    lines.write.option("header", True).option("sep", "\t").csv(path)
    text = written(csv_files.read_text_by_name(spark, path, corrupt="_corrupt"), "ragged-text")
    return contract.schema_report(text, _EXPECTED, "_corrupt")


@query("table_profile", """select count(*) as "rows", (select count(*) from (describe lineitem)) as "columns" from lineitem""")
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.table_profile(read_table(spark, sf_dir, "lineitem")).select("rows", "columns")


@query(
    "metrics_json",
    with_views(
        "select "
        + ", ".join(f'round("{m}", 4) as "{m}"' for m in ("accuracy", "f1_score", "precision", "recall"))
        + " from metrics",
        "metrics",
    ),
)
def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = ops.rounded_metrics(v.Report(spark, sf_dir).metrics)
    return write_metrics(record, fresh_dir(spark, "metrics"))
