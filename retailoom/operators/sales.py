"""Completed sales at order x product grain: the common base of the product rollups and reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.functions import columns as C


def completed_sales(fact_order_detail: DataFrame) -> DataFrame:
    """Lines of completed orders, one row per order and product.

    An order has one row per product here, so counting rows of a product counts its orders and the
    costlier COUNT(DISTINCT order_id) is not needed above product grain. Repeated lines, and the many
    lines a single order may have, are combined before the exchange.
    """
    return (
        fact_order_detail.filter(C.is_completed())
        .groupBy("order_id", "date_key", "platform", "store_key", "user_key", "traffic_source", "product_key")
        .agg(
            C.units("quantity").alias("quantity"),
            C.total("amount").alias("amount"),
            C.total("cost_amount").alias("cost_amount"),
            C.total("profit_amount").alias("profit_amount"),
        )
    )


def sales_measures() -> list[Column]:
    return [
        C.units("quantity").alias("sales_quantity"),
        C.total("amount").alias("sales_amount"),
        C.total("cost_amount").alias("cost_amount"),
        C.total("profit_amount").alias("profit_amount"),
    ]
