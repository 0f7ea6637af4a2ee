"""Every registered query against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as E
from order_mart.plans.registry import REGISTRY
from oracle_compare import compare, duckdb_connection

from conftest import SF0001

NAMES = sorted(REGISTRY)
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF0001)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SF0001), con, SQL[name])
    assert res["columns_match"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 493
    assert df.columns == [f.name for f in __import__("order_mart.schemas", fromlist=["x"]).FACT_DAILY_ORDERS]


@pytest.mark.parametrize("name", ["incremental_status", "continue_keys", "refresh_fact", "delivery_seconds",
                                  "fact_daily_orders", "fact_daily_orders_pipeline", "dim_customer",
                                  "date_spine", "conform_timestamps"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        res = compare(E.queries()[name](spark, SF0001), con, SQL[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["values_match"], res
