"""Mergeable per-order state.

An order's state is all that the order fact needs of its history: customer,
earliest Received, latest Delivered, and the sums of its item lines.  A status
row and an item line are states of their own, and states of the same order
merge by min, max and sum, in any grouping and order.  So an increment is
folded to one row per order on its own and merged with the stored state; the
history behind that state is not read again.

Status events and item lines merge likewise, as distinct rows with a count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import is_status, whole_seconds_between
from ..sinks.conform import conform
from .lifecycle import TS, delivered_only
from .totals import line_amount

_L, _TS = T.LongType(), T.TimestampNTZType()
ORDER_STATE = T.StructType([
    T.StructField("orderid", _L, False), T.StructField("customerid", _L), T.StructField("customerid_most", _L),
    T.StructField("n_status", _L), T.StructField("n_no_customer", _L),
    T.StructField("order_received_timestamp", _TS), T.StructField("order_delivery_timestamp", _TS),
    T.StructField("order_amount", _L), T.StructField("item_count", _L)])
ORDER_EVENTS = T.StructType([*schemas.DIM_ORDER.fields, T.StructField("n", _L, False)])
ORDER_LINES = T.StructType([
    T.StructField("orderid", _L, False), T.StructField("productid", _L), T.StructField("quantity", T.IntegerType()),
    T.StructField("n", _L, False)])

_MERGE = {"customerid": F.min, "customerid_most": F.max, "n_status": F.sum, "n_no_customer": F.sum,
          "order_received_timestamp": F.min, "order_delivery_timestamp": F.max, "order_amount": F.sum, "item_count": F.sum}


def status_states(order_details: DataFrame) -> DataFrame:
    """Every status row with an order key as a state.  Rows without a customer
    count, but their times do not (as in ``fact_daily_orders``)."""
    known = F.col("customerid").isNotNull()
    when = lambda status: F.when(known & is_status(status), F.col(TS))
    rows = order_details.filter(F.col("orderid").isNotNull()).select(
        "orderid", "customerid", F.col("customerid").alias("customerid_most"), F.lit(1).alias("n_status"),
        F.when(known, 0).otherwise(1).alias("n_no_customer"),
        when(schemas.STATUS_RECEIVED).alias("order_received_timestamp"),
        when(schemas.STATUS_DELIVERED).alias("order_delivery_timestamp"))
    return conform(rows, ORDER_STATE)


def item_states(order_items: DataFrame, product_master: DataFrame) -> DataFrame:
    """Every item line of a known product as a state, at the product's rate now."""
    lines = line_amount(order_items.filter(F.col("orderid").isNotNull()), product_master)
    rows = lines.select("orderid", F.col("line_amount").alias("order_amount"), F.col("quantity").alias("item_count"),
                        F.lit(0).alias("n_status"), F.lit(0).alias("n_no_customer"))
    return conform(rows, ORDER_STATE)


def merge_states(*states: DataFrame) -> DataFrame:
    """One state per order: a hash aggregate whose partial step runs before
    the exchange, so a hot order is one row per task."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy("orderid").agg(*[f(c).alias(c) for c, f in _MERGE.items()])


def order_state(order_details: DataFrame, order_items: DataFrame, product_master: DataFrame) -> DataFrame:
    """State of all orders that the rows name, in one exchange."""
    return merge_states(status_states(order_details), item_states(order_items, product_master))


def fact_of_states(state: DataFrame, customer_master: DataFrame) -> DataFrame:
    """``fact_daily_orders`` from states: one row per delivered order of a known customer."""
    known = delivered_only(state.filter(F.col("customerid").isNotNull()))
    fact = known.join(customer_master.select("customerid", "pincode"), "customerid").select(
        "customerid", "orderid", "order_received_timestamp", "order_delivery_timestamp", "pincode",
        F.coalesce("order_amount", F.lit(0)).alias("order_amount"), F.coalesce("item_count", F.lit(0)).alias("item_count"),
        whole_seconds_between("order_received_timestamp", "order_delivery_timestamp").alias("order_delivery_time_seconds"))
    return conform(fact, schemas.FACT_DAILY_ORDERS)


def states_of_several_customers(state: DataFrame) -> DataFrame:
    """Orders whose status rows, of any batch, disagree on the customer."""
    return state.filter((F.col("customerid") != F.col("customerid_most"))
                        | ((F.col("n_no_customer") > 0) & F.col("customerid").isNotNull()))


# --- events and lines as counted rows ---------------------------------------
#: Rows of a source that one task should count.
TASK_ROWS = 500_000


def count_partitions(rows: DataFrame) -> int:
    """Partitions for the counts of ``rows`` (which are counted when this is
    called): the session's number, or more if a task had over ``TASK_ROWS``."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))


def event_counts(order_details: DataFrame, partitions: int | None = None) -> DataFrame:
    """Distinct (order, time, status) with the number of status rows."""
    return _counts(order_details, ["orderid", TS, "order_status"], partitions)


def line_counts(order_items: DataFrame, partitions: int | None = None) -> DataFrame:
    """Distinct (order, product, quantity) with the number of item lines."""
    return _counts(order_items, ["orderid", "productid", "quantity"], partitions)


def _counts(source: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    """With ``partitions``, rows are dealt by the keys into as many tasks, which
    are not joined at run time, however well the rows compress: counts of
    several batches dealt alike are merged in place, by tasks that hold
    several aggregates.  All keys deal them, so a hot order is spread."""
    rows = source.filter(F.col("orderid").isNotNull())
    if partitions:
        rows = rows.select(*keys).repartition(partitions, *keys)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def key_rows_schema(key: str) -> T.StructType:
    return T.StructType([T.StructField(key, _L, False), T.StructField("n", _L, False)])


def key_rows(rows: DataFrame, key: str) -> DataFrame:
    """Number of rows of every key (NULL keys are not checked)."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def merge_counts(*counted: DataFrame) -> DataFrame:
    keys = [c for c in counted[0].columns if c != "n"]
    return reduce(DataFrame.unionByName, counted).groupBy(*keys).agg(F.sum("n").alias("n"))


def dim_order_of(events: DataFrame) -> DataFrame:
    return conform(events.drop("n"), schemas.DIM_ORDER)


def f_order_details_of(events: DataFrame, lines: DataFrame) -> DataFrame:
    """Item lines of delivered orders, a row for each line and Delivered row.
    Copies stay counts through the join and are spread out after it."""
    delivered = events.filter(is_status(schemas.STATUS_DELIVERED)).select(
        "orderid", F.col(TS).alias("order_delivery_timestamp"), F.col("n").alias("_times"))
    rows = lines.join(delivered, "orderid").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("n") * F.col("_times"))))
    return conform(rows, schemas.F_ORDER_DETAILS)
