"""Database and table definitions for the targets (and the sources)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .. import schemas


def ddl_columns(schema: T.StructType, varchar: dict[str, int] | None = None) -> str:
    cols = []
    for f in schema.fields:
        typ = f"VARCHAR({varchar[f.name]})" if varchar and f.name in varchar else f.dataType.simpleString()
        cols.append(f"{f.name} {typ}{'' if f.nullable else ' NOT NULL'}")
    return ", ".join(cols)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, replace: bool = False,
                 varchar: dict[str, int] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS ... USING parquet.  ``replace`` drops an
    existing table first (Parquet tables have no CREATE OR REPLACE).  NOT NULL
    and VARCHAR(n) are declared; the quality checks are what enforce them."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns(schema, varchar)}) USING parquet")


def create_targets(spark: SparkSession, database: str, location: str | None = None,
                   replace: bool = False) -> list[str]:
    create_database(spark, database, location)
    names = []
    for table, schema in schemas.TARGETS.items():
        name = f"{database}.{table}"
        create_table(spark, name, schema, replace)
        names.append(name)
    return names


def create_sources(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    create_database(spark, database, location)
    names = []
    for table, schema in schemas.SOURCES.items():
        limits = {c: n for (t, c), n in schemas.VARCHAR_LIMITS.items() if t == table}
        create_table(spark, f"{database}.{table}", schema, varchar=limits)
        names.append(f"{database}.{table}")
    return names
