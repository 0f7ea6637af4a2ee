"""Conform a DataFrame to an explicit target schema (select + cast)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def cast_to(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast with text parsing rules: text timestamps/dates are parsed, text
    booleans accept 'True'/'False' in any case; unparsable text becomes NULL
    instead of failing the job (``check_conform`` counts such values, in
    nullable columns too)."""
    if source == target:
        return col
    if isinstance(source, T.StringType):
        return F.trim(col).try_cast(target)
    return col.cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names and order, target types;
    absent columns become typed NULLs."""
    present = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (cast_to(F.col(f.name), present[f.name], f.dataType) if f.name in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def check_conform(df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """(table_name, column_name, n_lost): values of each text column that are
    present in ``df`` and would be NULL under ``schema``, in one scan."""
    texts = [f for f in schema.fields if f.name in df.columns and isinstance(df.schema[f.name].dataType, T.StringType)
             and not isinstance(f.dataType, T.StringType)]
    lost = [F.struct(F.lit(f.name).alias("column_name"), F.count_if(
        F.col(f.name).isNotNull() & cast_to(F.col(f.name), T.StringType(), f.dataType).isNull()).alias("n_lost")) for f in texts]
    if not lost:
        return df.sparkSession.createDataFrame([], "table_name string, column_name string, n_lost bigint")
    return df.agg(F.array(*lost).alias("_rows")).select(F.inline("_rows")).select(
        F.lit(table).alias("table_name"), "column_name", "n_lost")


def as_text(df: DataFrame) -> DataFrame:
    """Every column rendered as text, the way a CSV stage stores it."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
