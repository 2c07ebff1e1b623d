"""CSV directories, read by position or by column name."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.jobs import FILES_AT_ONCE, together

NAME_MARKS = (" ", "/")


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    strict_header: bool = False,
    doubled_quotes: bool = False,
    corrupt: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Directory scan with header lines; columns map by position.

    Without a schema the types are inferred, which reads the files once more.
    `strict_header` raises where a file's header differs from the schema. A quote
    inside a quoted value is escaped by a backslash, or by doubling it.
    """
    reader = spark.read.option("header", True).option("enforceSchema", not strict_header)
    reader = reader.option("escape", '"' if doubled_quotes else "\\").option("multiLine", multi_line)
    if corrupt is not None:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path if isinstance(path, str) else list(path))


def normalised_name(name: str) -> str:
    """Trimmed, lower case, with each space and slash as an underscore."""
    name = name.strip().lower()
    for mark in NAME_MARKS:
        name = name.replace(mark, "_")
    return name


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename all columns; two names that become equal are an error."""
    return df.toDF(*_unique_names(df.columns))


def _unique_names(columns: Iterable[str]) -> list[str]:
    names = [normalised_name(c) for c in columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names equal after normalising: {', '.join(clashes)}")
    return names


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[str, str]]:
    """(path, header line) of every CSV file below the paths.

    Files are listed and opened by Spark's own file system clients, with its
    credentials, so any store works that Spark reads. Only a first line is read
    of each file, by a few driver threads; the driver holds the file names, as
    it does for any scan. Names of files are taken as they are.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    files = []
    for root in [path] if isinstance(path, str) else path:
        top = hadoop.Path(root)
        store = top.getFileSystem(conf)
        starts = [top] if store.exists(top) else [found.getPath() for found in store.globStatus(top) or []]
        for start in starts:
            listed = store.listFiles(start, True)
            while listed.hasNext():
                file = listed.next().getPath()
                if file.getName().endswith(".csv") and not file.getName().startswith(("_", ".")):
                    files.append(file)

    def first_line(file) -> tuple[str, str]:
        stream = file.getFileSystem(conf).open(file)
        try:
            reader = spark._jvm.java.io.InputStreamReader(stream, "UTF-8")
            line = spark._jvm.java.io.BufferedReader(reader).readLine()
        finally:
            stream.close()
        return file.toString(), (line or "").removeprefix("\ufeff")

    return together(first_line, files, FILES_AT_ONCE) if files else []


def literal_path(path: str) -> str:
    """The path with the marks of path patterns escaped."""
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in path)


def read_text_by_name(
    spark: SparkSession, path: str | Sequence[str], corrupt: str | None = None, multi_line: bool = False
) -> DataFrame:
    """All CSV files under path, combined by normalised column name, as text.

    Columns a file lacks become null. Empty files are left out; a blank header
    line is an error. There is one scan per distinct header, not per file.
    `corrupt` names a column for the text of a row with more or fewer values
    than its header; without it such a row keeps what fits. `multi_line` lets
    quoted values hold line breaks, and makes each file one task.
    """
    groups: dict[str, list[str]] = {}
    for name, header in file_headers(spark, path):
        groups.setdefault(header, []).append(name)
    if not groups:
        raise FileNotFoundError(f"no CSV files under {path}")
    if "" in groups:
        empty = set(groups.pop(""))
        sizes = spark.read.format("binaryFile").load([literal_path(p) for p in sorted(empty)]).select("path", "length")
        filled = [r["path"] for r in sizes.where("length > 0").collect()]
        if filled:
            raise ValueError(f"no header line in {', '.join(sorted(filled))}")
        if not groups:
            raise FileNotFoundError(f"only empty CSV files under {path}")
    parts = []
    for header in sorted(groups):
        names = _unique_names(next(csv.reader([header])))
        if corrupt in names:
            raise ValueError(f"column {corrupt} is in the files")
        text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *([corrupt] if corrupt else [])]])
        files = [literal_path(p) for p in sorted(groups[header])]
        parts.append(scan_csv(spark, files, text, doubled_quotes=True, corrupt=corrupt, multi_line=multi_line))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_by_name(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """The combined CSV files with types.

    With a schema the result has exactly its columns, and text that does not
    parse becomes null; without one, types are found in one pass over all files,
    so that they do not depend on the file.
    """
    text = read_text_by_name(spark, path)
    return with_types(text, schema if schema is not None else infer_types(text))


def infer_types(df: DataFrame) -> T.StructType:
    """bigint, double or string per text column, from one pass over the rows."""
    tests = []
    for name in df.columns:
        shown = F.trim(F.col(f"`{name}`"))
        for kind in ("bigint", "double"):
            bad = (shown != "") & shown.try_cast(kind).isNull()
            tests.append(F.count_if(bad).alias(f"{name}:{kind}"))
    bad = df.agg(*tests).first()
    fields = []
    for name in df.columns:
        if bad[f"{name}:bigint"] == 0:
            kind: T.DataType = T.LongType()
        elif bad[f"{name}:double"] == 0:
            kind = T.DoubleType()
        else:
            kind = T.StringType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def with_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, cast; a missing column is null."""
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (
                F.col(f"`{present[f.name.lower()]}`").try_cast(f.dataType)
                if f.name.lower() in present
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows of each source file, in path order; df must come straight from a scan."""
    return (
        df.groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("file")
    )
