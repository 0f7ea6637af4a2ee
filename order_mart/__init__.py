"""order_mart: a Spark-native batch engine for an order-processing star schema.

Four source tables (customer_master, product_master, order_details,
order_items) become six targets (dim_order, dim_customer, dim_address,
dim_product, fact_daily_orders, f_order_details).  Every transform is a
DataFrame expression; Catalyst and AQE choose the physical plan.
"""

__all__ = ["config", "schemas"]
