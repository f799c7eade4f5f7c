"""Fact tables of the star schema.

Facts carry no numbered key of their own: nothing reads one, and numbering a fact table would sort it.
Whether a dimension is broadcast is left to Spark's size check.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom import config
from retailoom.functions import columns as C


def stamped(facts: DataFrame, as_of: dt.datetime | None) -> DataFrame:
    """Add the load date and time when ``as_of`` is given."""
    if as_of is None:
        return facts
    return facts.withColumns({"etl_date": F.lit(as_of.date()), "etl_time": F.lit(as_of)})


def fact_order(
    orders: DataFrame, dim_user: DataFrame, dim_store: DataFrame, as_of: dt.datetime | None = None
) -> DataFrame:
    """Orders of known users and stores; the others are left out. A repeated order id keeps its smallest row."""
    cost = F.coalesce("total_cost", F.lit(0))
    others = [c for c in orders.columns if c != "order_id"]
    single = (
        orders.filter("order_id is not null")
        .groupBy("order_id")
        .agg(F.min(F.struct(*others)).alias("_row"))
        .select("order_id", *[F.col(f"_row.`{c}`").alias(c) for c in others])
    )
    facts = (
        single
        .join(dim_user.select("user_id", "user_key"), "user_id")
        .join(dim_store.select("store_id", "store_key"), "store_id")
        .select(
            "order_id",
            "user_id",
            "store_id",
            "user_key",
            "store_key",
            C.date_key(F.col("order_time")).alias("date_key"),
            "order_status",
            "payment_method",
            "traffic_source",
            "platform",
            "order_time",
            "total_amount",
            F.coalesce("discount_amount", F.lit(0)).cast("decimal(12,2)").alias("discount_amount"),
            F.coalesce("shipping_fee", F.lit(0)).cast("decimal(12,2)").alias("shipping_fee"),
            "final_amount",
            cost.cast("decimal(12,2)").alias("total_cost"),
            (F.col("final_amount") - cost).cast("decimal(13,2)").alias("profit_amount"),
        )
    )
    return stamped(facts, as_of)


def order_orphans(orders: DataFrame, dim_user: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Orders that ``fact_order`` leaves out as their user or store is not known (yet), with their day."""
    known = (
        orders.filter("order_id is not null")
        .join(dim_user.select("user_id", "user_key"), "user_id", "left")
        .join(dim_store.select("store_id", "store_key"), "store_id", "left")
    )
    missing = known.filter("user_key is null or store_key is null")
    return missing.select("order_id", "user_id", "store_id", C.date_key(F.col("order_time")).alias("date_key")).distinct()


def fact_order_detail(
    details: DataFrame,
    fact_order: DataFrame,
    dim_product: DataFrame,
    as_of: dt.datetime | None = None,
    products_first: bool = False,
) -> DataFrame:
    """Lines of the orders in ``fact_order``, with the cost of their SKU (0 if unknown).

    The status, platform and traffic source of the order are stored with the line, so that no later
    step has to join lines to orders again. With ``products_first`` lines meet the products before the orders: the
    columns of the order are not moved to the products, and the rows lie by order for the steps after. That is for whole
    tables; for the orders of a few days few lines should be left when they meet the products.
    """
    amount, quantity = F.col("amount"), F.col("quantity")
    unit_cost = F.coalesce("cost", F.lit(0)).cast("decimal(10,2)")
    cost_amount = (unit_cost * quantity).cast(C.MONEY)
    profit = (amount - cost_amount).cast(C.MONEY)
    order_columns = ["store_id", "user_key", "store_key", "date_key", "order_status", "platform", "traffic_source"]
    orders, products = fact_order.select("order_id", *order_columns), dim_product.select("sku_id", "product_key", "cost")
    if products_first:
        joined = details.join(products, "sku_id", "left").join(orders, "order_id")
    else:
        joined = details.join(orders, "order_id").join(products, "sku_id", "left")
    facts = (
        joined.select(
            "order_detail_id",
            "order_id",
            "product_id",
            *order_columns,
            "product_key",
            "quantity",
            "price",
            "amount",
            unit_cost.alias("cost"),
            cost_amount.alias("cost_amount"),
            profit.alias("profit_amount"),
            C.percent(profit, amount).alias("profit_margin"),
        )
    )
    return stamped(facts, as_of)


def fact_promotion(
    promotion: DataFrame, dim_store: DataFrame, dim_product: DataFrame, as_of: dt.datetime | None = None
) -> DataFrame:
    """Promotion spend per row; unknown stores and SKUs keep a NULL key."""
    facts = (
        promotion.filter("promotion_id is not null")
        .join(dim_store.select("store_id", "store_key"), "store_id", "left")
        .join(dim_product.select("sku_id", "product_key"), "sku_id", "left")
        .select(
            "promotion_id",
            C.date_key(F.col("date")).alias("date_key"),
            "store_key",
            "product_key",
            "channel",
            "platform",
            "cost",
            "impressions",
            "clicks",
            C.percent(F.col("clicks"), F.col("impressions")).alias("ctr"),
            C.ratio(F.col("cost"), F.col("clicks")).alias("cpc"),
        )
    )
    return stamped(facts, as_of)


def fact_traffic(traffic: DataFrame, dim_store: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Store traffic per day, each row with the key of its own store."""
    facts = (
        traffic.filter("date is not null")
        .join(dim_store.select("store_id", "store_key"), "store_id", "left")
        .select(
            C.date_key(F.col("date")).alias("date_key"),
            "store_key",
            "platform",
            "visitors",
            "page_views",
            "search_traffic",
            "recommend_traffic",
            "direct_traffic",
            "other_traffic",
            "avg_stay_time",
            "bounce_rate",
        )
    )
    return stamped(facts, as_of)


def fact_inventory(
    inventory: DataFrame, dim_product: DataFrame, dim_store: DataFrame, as_of: dt.datetime | None = None
) -> DataFrame:
    """Stock movements, split into quantity in and quantity out."""

    def moved(kind: str) -> Column:
        return F.when(F.col("change_type") == kind, F.col("change_quantity")).otherwise(0)

    facts = (
        inventory.filter("inventory_id is not null")
        .join(dim_product.select("sku_id", "product_key"), "sku_id", "left")
        .join(dim_store.select("store_id", "store_key"), "store_id", "left")
        .select(
            "inventory_id",
            C.date_key(F.col("date")).alias("date_key"),
            "product_key",
            "store_key",
            "stock_quantity",
            moved(config.STOCK_IN).alias("in_quantity"),
            moved(config.STOCK_OUT).alias("out_quantity"),
        )
    )
    return stamped(facts, as_of)
