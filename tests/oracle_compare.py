"""Result comparison used by the tests and tools/check_oracle.py: a Spark
DataFrame against DuckDB SQL over the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def normalized_rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = normalized_rows(s_cols, spark_df.collect())
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = normalized_rows(d_cols, cur.fetchall())
    return {
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols, "oracle_columns": d_cols,
        "spark_rows": sum(s_rows.values()), "oracle_rows": sum(d_rows.values()),
        "values_match": s_rows == d_rows,
        "only_spark": list((s_rows - d_rows).elements())[:3],
        "only_oracle": list((d_rows - s_rows).elements())[:3],
    }
