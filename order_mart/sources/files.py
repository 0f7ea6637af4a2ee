"""CSV sources (explicit schema; never inferred) and literal tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..sinks.conform import check_conform


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema.  Inference would turn a
    nullable integer column into a float and timestamps into text; with a
    schema, values keep their types and malformed fields become NULL."""
    return (spark.read.schema(schema)
            .option("header", header)
            .option("mode", "PERMISSIVE")
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
            .csv(path))


def read_sources_csv(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The four source tables stored as headed CSV under ``{base}/{name}``."""
    return {name: read_csv(spark, f"{base}/{name}", schema) for name, schema in schemas.SOURCES.items()}


def check_csv(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """(table_name, column_name, n_lost): malformed values of each column,
    which ``read_csv`` turns into NULL."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return check_conform(read_csv(spark, path, text), table, schema)


def lost_values(spark: SparkSession, base: str) -> DataFrame:
    """Gate rows (check, table_name, column_name, n_violations) for the values
    of ``read_sources_csv`` that do not parse, nullable columns included."""
    counts = [check_csv(spark, f"{base}/{name}", name, schema) for name, schema in schemas.SOURCES.items()]
    return reduce(DataFrame.unionByName, counts).filter("n_lost > 0").select(
        F.lit("lost_value").alias("check"), "table_name", "column_name", F.col("n_lost").alias("n_violations"))


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal table (lookups, fixtures) with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def csv_round_trip(df: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Write ``df`` as headed CSV and read it back under ``schema`` (the
    CSV staging step of the original pipeline, minus its type drift)."""
    from ..sinks.writers import write_csv
    write_csv(df, path)
    return read_csv(df.sparkSession, path, schema)
