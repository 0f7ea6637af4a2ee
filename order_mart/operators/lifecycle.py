"""Order and customer lifecycles: status history folded to one row per key.

A filter / group-first / merge-back chain over the status history collapses
to a single conditional aggregate, i.e. one hash aggregate with a map-side
partial step.  The partial step also makes a hot key harmless: each map task
sends at most one row per key to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions import is_not_status_keep_null, is_status, is_status_exact

TS = "order_status_update_timestamp"


def _pred(status: str, exact: bool):
    return is_status_exact(status) if exact else is_status(status)


def order_lifecycle(order_details: DataFrame, keys: tuple[str, ...] = ("orderid", "customerid"),
                    exact: bool = False, delivered_agg: str = "max",
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """Per order: earliest Received time and the Delivered time (latest by
    default; ``delivered_agg='min'`` gives the first).  ``exact`` compares the
    raw status text instead of the normalised spelling.  ``carry`` columns
    are functionally dependent on the keys and ride along as ``min``: grouping
    by the order key alone leaves the result hash-partitioned on it, so a
    following join on the order key needs no second shuffle."""
    agg = F.max if delivered_agg == "max" else F.min
    return order_details.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in carry],
        F.min(F.when(_pred(schemas.STATUS_RECEIVED, exact), F.col(TS))).alias("order_received_timestamp"),
        agg(F.when(_pred(schemas.STATUS_DELIVERED, exact), F.col(TS))).alias("order_delivery_timestamp"))


def orders_with_several_customers(order_details: DataFrame) -> DataFrame:
    """Orders whose status rows name more than one customer (the order-grain
    fact assumes one customer per order; this check gates the publish)."""
    return (order_details.filter(F.col("orderid").isNotNull())
            .groupBy("orderid")
            .agg(F.min("customerid").alias("min_customerid"), F.max("customerid").alias("max_customerid"),
                 F.count_if(F.col("customerid").isNull()).alias("n_null_customer"))
            .filter((F.col("min_customerid") != F.col("max_customerid"))
                    | ((F.col("n_null_customer") > 0) & F.col("min_customerid").isNotNull())))


def delivered_only(lifecycle: DataFrame) -> DataFrame:
    """Orders that have both a Received and a Delivered time."""
    return lifecycle.filter(F.col("order_received_timestamp").isNotNull()
                            & F.col("order_delivery_timestamp").isNotNull())


def customer_status_history(customer_master: DataFrame, order_details: DataFrame) -> DataFrame:
    """customers LEFT JOIN status history on customerid (row grain)."""
    from .joins import left_join_split
    return left_join_split(customer_master.select("customerid", "name"),
                           order_details.select("customerid", TS, "order_status"), "customerid")


def customer_first_events(customer_master: DataFrame, order_details: DataFrame) -> DataFrame:
    """Per (customerid, name): first Received and first Delivered time over all
    of the customer's orders, with the pandas rules made explicit:

    * rows whose status is exactly 'In_progress' are removed first (NULL
      status kept), so a customer whose only rows carry that status vanishes;
    * a NULL name is a NULL group key: such customers keep NULL dates;
    * customers without orders are kept with NULL dates.

    The status history is pre-aggregated to customer grain before the join, so
    the join moves one row per customer instead of the whole history.
    """
    keep = is_not_status_keep_null(schemas.PIPELINE_IN_PROGRESS_LITERAL)
    per_customer = (order_details.filter(F.col("customerid").isNotNull())
                    .groupBy("customerid").agg(
                        F.count_if(keep).alias("_kept"),
                        F.min(F.when(keep & is_status_exact(schemas.STATUS_RECEIVED), F.col(TS))).alias("_first_received"),
                        F.min(F.when(keep & is_status_exact(schemas.STATUS_DELIVERED), F.col(TS))).alias("_first_delivered")))
    joined = customer_master.select("customerid", "name").join(per_customer, "customerid", "left")
    named = F.col("name").isNotNull()
    return (joined.filter(F.col("_kept").isNull() | (F.col("_kept") > 0))
            .select("customerid", "name",
                    F.when(named, F.col("_first_received")).alias("first_received_timestamp"),
                    F.when(named, F.col("_first_delivered")).alias("first_delivered_timestamp"))
            .distinct())
