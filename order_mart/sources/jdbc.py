"""Relational sources over JDBC.

Reads are split into ``num_partitions`` parallel range queries on a numeric
(or date) column, so a large table is never pulled through one connection.
Filters and projections applied to the result are pushed into the SQL that
Spark sends to the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..sinks.conform import conform


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower_bound: int | str | None = None, upper_bound: int | str | None = None,
              num_partitions: int = 8, fetch_size: int = 10_000,
              properties: dict[str, str] | None = None, quote: str = '"') -> DataFrame:
    """Read ``table`` (or a ``(subquery) alias``).  Connection options such as
    user/password/driver come in ``properties``; nothing is hard-coded."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size).option("preferTimestampNTZ", "true"))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            bounds = _bounds(spark, url, table, f"{quote}{partition_column}{quote}", properties)
            lower_bound = bounds[0] if lower_bound is None else lower_bound
            upper_bound = bounds[1] if upper_bound is None else upper_bound
        if lower_bound is not None and upper_bound is not None:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                      .option("numPartitions", num_partitions))
    return reader.load()


def _bounds(spark, url, table, column, properties):
    """min/max of the partition column, computed by the database (one row)."""
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", q)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    row = reader.load().first()
    return (row[0], row[1]) if row is not None else (None, None)


def key_histogram(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, bins: int,
                  properties: dict[str, str] | None = None, where: str = "1 = 1") -> list[tuple[int, int, int]]:
    """(first key, last key, rows) of equally wide bins of low..high that hold
    rows, counted by the database; ``bins`` rows at most come back."""
    width = -(-(high - low + 1) // bins)
    q = (f"(SELECT ({column} - {low}) / {width} AS b, COUNT(*) AS n FROM {table} "
         f"WHERE {column} BETWEEN {low} AND {high} AND {where} GROUP BY ({column} - {low}) / {width}) h")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", q)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    rows = [(int(r[0]), int(r[1])) for r in reader.load().collect()]
    return [(low + b * width, min(high, low + (b + 1) * width - 1), n) for b, n in sorted(rows)]


def balanced_ranges(spark: SparkSession, url: str, table: str, column: str, num_partitions: int,
                    properties: dict[str, str] | None = None, quote: str = '"', where: str = "1 = 1",
                    bins: int = 1000) -> list[tuple[int, int]]:
    """Key ranges of about equal numbers of rows, whatever the keys' spread.

    The database counts rows in equally wide bins; a bin with more rows than a
    range should have is counted again in narrower ones, down to a single key.
    A key that alone exceeds a share is a range of its own.  Queries and the
    driver's rows are bounded by ``bins`` for every level of a crowded range.
    """
    col = f"{quote}{column}{quote}"
    low, high = _bounds(spark, url, f"(SELECT {col} FROM {table} WHERE {where}) s", col, properties)
    if low is None:
        return []
    found = key_histogram(spark, url, table, col, int(low), int(high), bins, properties, where)
    share = -(-sum(n for _, _, n in found) // num_partitions)
    while any(n > share and first < last for first, last, n in found):
        finer = []
        for first, last, n in found:
            finer += (key_histogram(spark, url, table, col, first, last, bins, properties, where)
                      if n > share and first < last else [(first, last, n)])
        found = finer
    ranges, start, held = [], found[0][0], 0
    for (first, last, n), following in zip(found, [*found[1:], None], strict=True):
        held += n
        if following is None or held + following[2] > share:
            ranges.append((start, last))
            if following is not None:
                start, held = following[0], 0
    return ranges


def read_jdbc_balanced(spark: SparkSession, url: str, table: str, column: str, num_partitions: int = 8,
                       properties: dict[str, str] | None = None, quote: str = '"', where: str = "1 = 1",
                       snapshot_sql: str | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Read a table over ``balanced_ranges`` of an integer key, one task each;
    rows without a key are one more range.

    Range queries run at different moments.  So that they see one state,
    ``where`` is added to each (for tables that only grow: a bound on the key
    or time, read before), or ``snapshot_sql`` is run by every connection
    before its query, where the database can share a snapshot.
    """
    col = f"{quote}{column}{quote}"
    ranges = balanced_ranges(spark, url, table, column, num_partitions, properties, quote, where)
    predicates = [f"{col} BETWEEN {a} AND {b} AND {where}" for a, b in ranges] + [f"{col} IS NULL AND {where}"]
    options = {"fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **(properties or {})}
    if snapshot_sql:
        options["sessionInitStatement"] = snapshot_sql
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def read_sources_jdbc(spark: SparkSession, url: str, properties: dict[str, str] | None = None,
                      num_partitions: int = 8) -> dict[str, DataFrame]:
    """The four order sources from a relational database, each split on its
    key and conformed to its declared schema.  ``num_partitions`` connections
    read a table at once; raise it with the table's size and what the database
    admits."""
    split = {"customer_master": "customerid", "product_master": "productid",
             "order_details": "orderid", "order_items": "orderid"}
    return {t: conform(_named(read_jdbc(spark, url, t, partition_column=c, num_partitions=num_partitions,
                                        properties=properties), schemas.SOURCES[t].names), schemas.SOURCES[t])
            for t, c in split.items()}


def _named(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns under the declared spelling, whatever case the database uses."""
    own = {c.lower(): c for c in df.columns}
    return df.select(*[df[own[n.lower()]].alias(n) for n in names])
