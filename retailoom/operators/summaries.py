"""Further rollups and reports: tables that are declared with their columns only, and summary queries.

The declared tables have no formulas; each one here follows the filled table next to it, over completed
orders. Where a summary query would join two facts row by row and so count amounts several times, both
sides are aggregated before the join.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailoom import config
from retailoom.functions import columns as C
from retailoom.functions.numbering import rank_rows
from retailoom.operators.rollups import category_rollup, completed, order_measures, profit_rate, trade_product_1d
from retailoom.operators.sales import sales_measures


def _avg_order() -> Column:
    return C.ratio(F.col("sales_amount"), F.col("order_count")).alias("avg_order_amount")


# --- declared rollups ----------------------------------------------------------------------------


def sales_daily(fact_order: DataFrame) -> DataFrame:
    sums = completed(fact_order).groupBy("date_key", "platform").agg(*order_measures())
    return sums.select("*", profit_rate(), _avg_order())


def sales_monthly(fact_order: DataFrame) -> DataFrame:
    month = C.month_of_key(F.col("date_key")).alias("year_month")
    sums = completed(fact_order).groupBy(month, "platform").agg(*order_measures())
    return sums.select("*", profit_rate(), _avg_order())


def monthly_trend(sales_monthly: DataFrame) -> DataFrame:
    return sales_monthly.drop("cost_amount")


def product_daily(sales: DataFrame) -> DataFrame:
    return trade_product_1d(sales).drop("buyer_count").select("*", profit_rate())


def category_daily(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    return category_rollup(sales, dim_product, "date_key", "category_l1", "category_l2", "platform")


def user_daily(fact_order: DataFrame) -> DataFrame:
    return (
        completed(fact_order)
        .groupBy("date_key", "user_key")
        .agg(F.count("order_id").alias("order_count"), C.total("final_amount").alias("sales_amount"))
    )


def promotion_product(fact_promotion: DataFrame, sales: DataFrame) -> DataFrame:
    """Promotion per product and channel, next to all sales of the product."""
    spent = fact_promotion.groupBy("product_key", "channel").agg(
        C.total("cost").alias("cost"), C.units("impressions").alias("impressions"), C.units("clicks").alias("clicks")
    )
    sold = sales.groupBy("product_key").agg(C.total("amount").alias("sales_amount"))
    amount = C.money(F.coalesce("sales_amount", F.lit(0)))
    return (
        spent.join(sold, "product_key", "left")
        .withColumn("sales_amount", amount)
        .select("*", C.ratio(F.col("sales_amount"), F.col("cost")).alias("roi"))
    )


def platform_report(fact_order: DataFrame) -> DataFrame:
    """Platforms with their share of all sales. The window sees one row per platform."""
    # combined per store and user first: the two DISTINCTs below then run over far fewer rows
    pairs = (
        completed(fact_order)
        .groupBy("platform", "store_key", "user_key")
        .agg(
            F.count("order_id").alias("orders"),
            C.total("final_amount").alias("sales"),
            C.total("profit_amount").alias("profit"),
        )
    )
    sums = pairs.groupBy("platform").agg(
        F.count_distinct("store_key").alias("store_count"),
        C.units("orders").alias("order_count"),
        F.count_distinct("user_key").alias("user_count"),
        C.total("sales").alias("sales_amount"),
        C.total("profit").alias("profit_amount"),
    )
    return sums.select(
        "*",
        C.ratio(F.col("sales_amount"), F.col("store_count")).alias("avg_store_sales"),
        profit_rate(),
        _avg_order(),
        share_of_all("sales_amount").alias("sales_ratio"),
    )


def share_of_all(measure: str) -> Column:
    """Per cent of the total. Only for tables that are already a few rows."""
    return C.percent(F.col(measure), F.sum(measure).over(Window.partitionBy()))


def top_products(product_total: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` products by sales, by quantity and by profit.

    Spark keeps the first ``k`` rows per rank type in every task before the exchange.
    """
    ranked_by = {"sales": "sales_amount", "quantity": "sales_quantity", "profit": "profit_amount"}
    scores = F.array(
        *[
            F.struct(F.lit(kind).alias("rank_type"), F.col(measure).cast(C.MONEY).alias("score"))
            for kind, measure in ranked_by.items()
        ]
    )
    rank = F.row_number().over(Window.partitionBy("rank_type").orderBy(F.desc("score"), "product_key"))
    return (
        product_total.filter("product_key is not null")
        .withColumn("ranked", F.explode(scores))
        .select("*", "ranked.rank_type", "ranked.score")
        .withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .drop("ranked", "score")
    )


def category_analysis(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    sums = category_rollup(sales, dim_product, "category_l1")
    return sums.select("*", share_of_all("sales_amount").alias("sales_ratio"))


def user_level_analysis(user_total: DataFrame) -> DataFrame:
    sums = user_total.groupBy("user_level").agg(
        F.count("*").alias("user_count"),
        C.total("total_amount").alias("total_amount"),
        C.units("order_count").alias("order_count"),
    )
    return sums.select(
        "*",
        C.ratio(F.col("total_amount"), F.col("user_count")).alias("avg_amount_per_user"),
        share_of_all("user_count").alias("user_ratio"),
        share_of_all("total_amount").alias("sales_ratio"),
    )


def store_leaderboard(store_total: DataFrame) -> DataFrame:
    """Stores by sales, over all and within their platform."""
    stores = store_total.select(
        "store_id",
        "store_name",
        "platform",
        "order_count",
        "user_count",
        "sales_amount",
        "profit_amount",
        "avg_order_amount",
        "profit_rate",
    )
    overall = rank_rows(stores, "sales_amount", "overall_rank", ["store_id"])
    return rank_rows(overall, "sales_amount", "platform_rank", ["store_id"], within="platform")


# --- summary queries -----------------------------------------------------------------------------


def order_wide(orders: DataFrame, details: DataFrame, users: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Every order with its user, its store and the cost and profit of its lines."""
    cost = C.money(F.coalesce("cost", F.lit(0)) * F.col("quantity"))
    lines = (
        details.groupBy("order_id", "sku_id")
        .agg(C.units("quantity").alias("quantity"), C.total("amount").alias("amount"))
        .join(products.select("sku_id", "cost"), "sku_id", "left")
        .groupBy("order_id")
        .agg(C.money(F.sum(cost)).alias("line_cost"), C.money(F.sum(F.col("amount") - cost)).alias("line_profit"))
    )
    people = users.select("user_id", "gender", "age", C.age_group(F.col("age")).alias("age_group"), "city")
    moment = F.col("order_time")
    return (
        orders.join(lines, "order_id", "left")
        .join(people, "user_id", "left")
        .join(stores.select("store_id", "store_name"), "store_id", "left")
        .select(
            "order_id",
            "user_id",
            "store_id",
            "platform",
            "order_time",
            "order_status",
            "final_amount",
            "gender",
            "age",
            "age_group",
            "city",
            "store_name",
            moment.cast("date").alias("order_date"),
            F.year(moment).alias("year"),
            F.month(moment).alias("month"),
            "line_cost",
            "line_profit",
        )
    )


def detail_wide(details: DataFrame, products: DataFrame) -> DataFrame:
    """Every line with its product, cost and profit; NULL where the SKU is unknown."""
    amount = F.col("amount")
    cost = C.money(F.col("cost") * F.col("quantity"))
    attributes = products.select("sku_id", "product_name", "category_l1", "category_l2", "cost")
    return details.join(attributes, "sku_id", "left").select(
        "order_detail_id",
        "order_id",
        "sku_id",
        "product_id",
        "quantity",
        "price",
        "amount",
        "product_name",
        "category_l1",
        "category_l2",
        "cost",
        cost.alias("cost_amount"),
        C.money(amount - cost).alias("profit_amount"),
        C.quotient((amount - cost) * 100, amount).alias("profit_margin"),
    )


def sales_summary(fact_order_detail: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Completed sales per day, platform, store and category. ``order_count`` counts lines, not orders."""
    by_key = (
        fact_order_detail.filter(C.is_completed())
        .groupBy("date_key", "platform", "store_key", "product_key", "user_key")
        .agg(
            F.count("order_id").alias("lines"),
            C.total("amount").alias("amount"),
            C.total("cost_amount").alias("cost_amount"),
            C.total("profit_amount").alias("profit_amount"),
        )
    )
    sums = (
        by_key.join(dim_product.select("product_key", "category_l1", "category_l2"), "product_key", "left")
        .groupBy("date_key", "platform", "store_key", "category_l1", "category_l2")
        .agg(
            C.units("lines").alias("order_count"),
            F.count_distinct("user_key").alias("customer_count"),
            C.total("amount").alias("sales_amount"),
            C.total("cost_amount").alias("cost_amount"),
            C.total("profit_amount").alias("profit_amount"),
        )
    )
    return sums.join(dim_store.select("store_key", "store_id", "store_name"), "store_key", "left").select(
        "date_key",
        C.month_of_key(F.col("date_key")).alias("year_month"),
        "platform",
        "store_id",
        "store_name",
        "category_l1",
        "category_l2",
        "order_count",
        "customer_count",
        "sales_amount",
        "cost_amount",
        "profit_amount",
        profit_rate(),
        _avg_order(),
    )


def inventory_summary(
    inventory: DataFrame, products: DataFrame, days: int = 30, as_of: dt.date | None = None
) -> DataFrame:
    """Stock and its value per SKU, and the quantities moved in the ``days`` days up to ``as_of``.

    The stock is that of the latest record. ``as_of`` is the last day in the inventory if not given.
    """
    last = F.lit(as_of) if as_of else inventory.select(F.max("date")).scalar()
    recent = F.col("date").between(F.date_sub(last, days - 1), last)

    def moved(kind: str) -> Column:
        return F.sum(F.when(recent & (F.col("change_type") == kind), F.col("change_quantity")).otherwise(0)).cast("bigint")

    history = inventory.filter(F.col("date") <= last)
    latest = F.max(F.struct("date", "inventory_id", "stock_quantity"))
    moves = history.groupBy("sku_id").agg(
        latest["stock_quantity"].cast("bigint").alias("stock_now"),
        moved(config.STOCK_IN).alias("in_quantity"),
        moved(config.STOCK_OUT).alias("out_quantity"),
    )
    attributes = products.select("sku_id", "product_id", "product_name", "category_l1", "category_l2", "price", "cost")
    none = F.lit(0).cast("bigint")
    return attributes.join(moves, "sku_id", "left").select(
        "sku_id",
        "product_id",
        "product_name",
        "category_l1",
        "category_l2",
        "stock_now",
        C.money(F.col("cost") * F.col("stock_now")).alias("value_at_cost"),
        C.money(F.col("price") * F.col("stock_now")).alias("value_at_price"),
        F.coalesce("in_quantity", none).alias("in_quantity"),
        F.coalesce("out_quantity", none).alias("out_quantity"),
    )


def promotion_summary(fact_promotion: DataFrame, sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Promotion per day, platform, store, product and channel, with the sales of that product that day."""
    key = ["date_key", "platform", "store_key", "product_key"]
    spent = fact_promotion.groupBy(*key, "channel").agg(
        C.total("cost").alias("cost"), C.units("impressions").alias("impressions"), C.units("clicks").alias("clicks")
    )
    sold = sales.groupBy(*key).agg(F.count("*").alias("order_count"), C.total("amount").alias("sales_amount"))
    attributes = dim_product.select("product_key", "product_name", "category_l1", "category_l2")
    return (
        spent.join(sold, key, "left")
        .join(attributes, "product_key", "left")
        .select(
            *key,
            "channel",
            "product_name",
            "category_l1",
            "category_l2",
            "cost",
            "impressions",
            "clicks",
            C.percent(F.col("clicks"), F.col("impressions")).alias("click_rate"),
            F.coalesce("order_count", F.lit(0)).alias("order_count"),
            C.money(F.coalesce("sales_amount", F.lit(0))).alias("sales_amount"),
            C.ratio(F.coalesce("sales_amount", F.lit(0)), F.col("cost")).alias("roi"),
        )
    )


def traffic_summary(fact_traffic: DataFrame, fact_order: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Traffic of a store and day next to its completed orders and customers."""
    sold = (
        completed(fact_order)
        .groupBy("date_key", "store_key")
        .agg(
            F.count("order_id").alias("order_count"),
            C.total("final_amount").alias("sales_amount"),
            F.count_distinct("user_key").alias("customer_count"),
        )
    )
    customers = F.coalesce("customer_count", F.lit(0))
    return (
        fact_traffic.join(sold, ["date_key", "store_key"], "left")
        .join(dim_store.select("store_key", "store_name"), "store_key", "left")
        .select(
            "date_key",
            "store_key",
            "platform",
            "store_name",
            "visitors",
            "page_views",
            "search_traffic",
            "recommend_traffic",
            "direct_traffic",
            F.coalesce("order_count", F.lit(0)).alias("order_count"),
            C.money(F.coalesce("sales_amount", F.lit(0))).alias("sales_amount"),
            customers.alias("customer_count"),
            C.percent(customers, F.col("visitors")).alias("visit_conversion"),
            C.ratio(F.col("page_views"), F.col("visitors")).alias("pages_per_visitor"),
        )
    )
