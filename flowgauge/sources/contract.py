"""Schema checks at ingest and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """A column is missing or holds text of the wrong type."""


ROW_SHAPE = "(row)"


def schema_report(df: DataFrame, expected: T.StructType, corrupt: str | None = None) -> DataFrame:
    """One row per expected column: present, empty values and unparsable values.

    `corrupt` names the column that holds the text of rows of the wrong shape;
    they are counted in a row of their own, and their values not at all.
    """
    present = {c.lower(): c for c in df.columns}
    measures = []
    whole = F.col(f"`{corrupt}`").isNull() if corrupt else F.lit(True)
    for field in expected.fields:
        name = present.get(field.name.lower())
        if name is None:
            measures.append((F.lit(0).cast("bigint"), F.count_if(whole)))
            continue
        value = F.col(f"`{name}`")
        bad = value.isNotNull() & value.try_cast(field.dataType).isNull()
        measures.append((F.count_if(whole & bad), F.count_if(whole & value.isNull())))
    rows = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("expected"),
            F.lit(field.name.lower() in present).alias("present"),
            bad.alias("bad_values"),
            empty.alias("null_values"),
        )
        for field, (bad, empty) in zip(expected.fields, measures)
    ]
    if corrupt:
        shape = (F.lit(ROW_SHAPE), F.lit("values as in the header"), F.lit(True), F.count_if(~whole), F.lit(0).cast("bigint"))
        rows.append(F.struct(*[c.alias(n) for c, n in zip(shape, ("column", "expected", "present", "bad_values", "null_values"))]))
    return df.agg(F.array(*rows).alias("report")).select(F.inline("report"))


def require_schema(df: DataFrame, expected: T.StructType, corrupt: str | None = None) -> DataFrame:
    """df itself, or SchemaMismatch naming every column at fault."""
    faults = schema_report(df, expected, corrupt).where("not present or bad_values > 0").collect()
    if faults:
        raise SchemaMismatch(
            "; ".join(
                f"{r['column']}: " + (f"{r['bad_values']} values are not {r['expected']}" if r["present"] else "missing")
                for r in faults
            )
        )
    return df


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, partitions and the spread of rows over partitions."""
    per_partition = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    return per_partition.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.count(F.lit(1)).alias("filled_partitions"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
    )


def column_types(df: DataFrame) -> DataFrame:
    """(position, column, type) of the table."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")
