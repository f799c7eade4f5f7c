"""Rollups of the facts.

``order_id`` is unique in ``fact_order`` (the quality job checks it), so orders are counted as rows and
each rollup has at most one DISTINCT. Spark then first combines by (group, distinct value) on the map
side and spreads a hot group over its distinct values, which keeps a store or product with a large
share of all rows from ending up in one task. Attributes of a dimension are joined after aggregating.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.functions import columns as C
from retailoom.operators.sales import sales_measures


def order_measures() -> list[Column]:
    """Measures over completed orders."""
    return [
        F.count("order_id").alias("order_count"),
        F.count_distinct("user_key").alias("user_count"),
        C.total("final_amount").alias("sales_amount"),
        C.total("total_cost").alias("cost_amount"),
        C.total("profit_amount").alias("profit_amount"),
    ]


def profit_rate(sales: str = "sales_amount") -> Column:
    return C.percent(F.col("profit_amount"), F.col(sales)).alias("profit_rate")


def completed(fact_order: DataFrame) -> DataFrame:
    return fact_order.filter(C.is_completed())


def trade_order_1d(fact_order: DataFrame) -> DataFrame:
    """All orders and completed orders per day, store and platform."""

    def paid(column: str) -> Column:
        return C.money(F.sum(F.when(C.is_completed(), F.col(column)).otherwise(0)))

    return fact_order.groupBy("date_key", "store_key", "platform").agg(
        F.count("order_id").alias("order_count"),
        F.count_distinct("user_key").alias("order_user_count"),
        C.total("final_amount").alias("order_amount"),
        F.count(F.when(C.is_completed(), F.col("order_id"))).alias("payment_count"),
        paid("final_amount").alias("payment_amount"),
        paid("total_cost").alias("cost_amount"),
        paid("profit_amount").alias("profit_amount"),
        C.average(F.when(C.is_completed(), F.col("final_amount"))).alias("avg_order_amount"),
    )


def trade_product_1d(sales: DataFrame) -> DataFrame:
    return sales.groupBy("date_key", "product_key").agg(
        F.count("*").alias("order_count"), *sales_measures(), F.count_distinct("user_key").alias("buyer_count")
    )


def store_daily(fact_order: DataFrame) -> DataFrame:
    return completed(fact_order).groupBy("date_key", "store_key").agg(*order_measures()).select("*", profit_rate())


def store_total(fact_order: DataFrame, dim_store: DataFrame) -> DataFrame:
    totals = (
        completed(fact_order)
        .groupBy("store_key")
        .agg(*order_measures(), C.average(F.col("final_amount")).alias("avg_order_amount"))
        .select("*", profit_rate())
    )
    return totals.join(dim_store.select("store_key", "store_id", "store_name", "platform"), "store_key", "left")


def product_total(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    totals = (
        sales.groupBy("product_key").agg(F.count("*").alias("order_count"), *sales_measures()).select("*", profit_rate())
    )
    attributes = dim_product.select("product_key", "product_id", "product_name", "category_l1", "category_l2")
    return totals.join(attributes, "product_key", "left")


def category_rollup(sales: DataFrame, dim_product: DataFrame, *grain: str) -> DataFrame:
    """Sales by product category and ``grain``; an order with several products of a category counts once."""
    return (
        sales.join(dim_product.select("product_key", "category_l1", "category_l2"), "product_key", "left")
        .groupBy(*grain)
        .agg(F.count_distinct("order_id").alias("order_count"), *sales_measures())
        .select("*", profit_rate())
        .drop("cost_amount")
    )


def category_total(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    return category_rollup(sales, dim_product, "category_l1", "category_l2", "platform")


def user_total(fact_order: DataFrame, dim_user: DataFrame) -> DataFrame:
    totals = (
        completed(fact_order)
        .groupBy("user_key")
        .agg(
            F.count("order_id").alias("order_count"),
            C.total("final_amount").alias("total_amount"),
            C.average(F.col("final_amount")).alias("avg_order_amount"),
            F.min("order_time").alias("first_order_date"),
            F.max("order_time").alias("last_order_date"),
        )
        .withColumn("user_level", C.user_level(F.col("total_amount")))
    )
    attributes = dim_user.select("user_key", "user_id", "gender", "age", "age_group", "city")
    return totals.join(attributes, "user_key", "left")


def promotion_daily(fact_promotion: DataFrame) -> DataFrame:
    sums = fact_promotion.groupBy("date_key", "channel", "platform").agg(
        C.total("cost").alias("cost"), C.units("impressions").alias("impressions"), C.units("clicks").alias("clicks")
    )
    return sums.select(
        "*",
        C.percent(F.col("clicks"), F.col("impressions")).alias("click_rate"),
        C.ratio(F.col("cost"), F.col("clicks")).alias("avg_click_cost"),
    )


def traffic_daily(fact_traffic: DataFrame, fact_order: DataFrame) -> DataFrame:
    orders = completed(fact_order).groupBy("date_key", "store_key").agg(F.count("order_id").alias("order_cnt"))
    return fact_traffic.join(orders, ["date_key", "store_key"], "left").select(
        "date_key",
        "store_key",
        "platform",
        "visitors",
        "page_views",
        "avg_stay_time",
        "bounce_rate",
        C.percent(F.coalesce("order_cnt", F.lit(0)), F.col("visitors")).alias("conversion_rate"),
    )
