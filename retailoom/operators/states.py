"""Daily states that add up: totals of any span of days are merged from them without reading facts again.

Sums and counts are added. Distinct users can't be added, so a state holds the set of them as an exact bitmap over the
surrogate key (one row per 32,768 keys), and sets are united before they are counted.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.functions import columns as C
from retailoom.operators.rollups import category_rollup, completed, profit_rate


def order_state_1d(fact_order: DataFrame) -> DataFrame:
    """Completed orders per day, store and platform: counts and sums."""
    return completed(fact_order).groupBy("date_key", "store_key", "platform").agg(
        F.count("order_id").alias("order_count"),
        F.count("final_amount").alias("amounts"),
        C.total("final_amount").alias("sales_amount"),
        C.total("total_cost").alias("cost_amount"),
        C.total("profit_amount").alias("profit_amount"),
    )


def user_bitmap_1d(fact_order: DataFrame) -> DataFrame:
    """Users of completed orders per day, store and platform, as bitmaps of their keys."""
    users = completed(fact_order).filter("user_key is not null")
    bucket = F.bitmap_bucket_number("user_key").alias("bucket")
    return users.groupBy("date_key", "store_key", "platform", bucket).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_key")).alias("users")
    )


def user_state_1d(fact_order: DataFrame) -> DataFrame:
    """Completed orders per day and user."""
    return completed(fact_order).groupBy("date_key", "user_key").agg(
        F.count("order_id").alias("order_count"),
        F.count("final_amount").alias("amounts"),
        C.total("final_amount").alias("total_amount"),
        F.min("order_time").alias("first_order_date"),
        F.max("order_time").alias("last_order_date"),
    )


def category_state_1d(sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales per day, category and platform; an order has one day, so its count adds up over days."""
    rollup = category_rollup(sales, dim_product, "date_key", "category_l1", "category_l2", "platform")
    return rollup.withColumn("cost_amount", C.money(F.col("sales_amount") - F.col("profit_amount"))).drop("profit_rate")


# --- merging -------------------------------------------------------------------------------------


def _sums(*names: str) -> list[Column]:
    return [C.total(name).alias(name) for name in names]


def _units(*names: str) -> list[Column]:
    return [C.units(name).alias(name) for name in names]


def user_counts(user_bitmap: DataFrame, *keys: str | Column) -> DataFrame:
    """Distinct users by ``keys``: bitmaps of a bucket are united, then counted."""
    names = [key if isinstance(key, str) else f"_{n}" for n, key in enumerate(keys)]
    grouped = [F.col(key).alias(name) if isinstance(key, str) else key.alias(name) for key, name in zip(keys, names, strict=True)]
    united = user_bitmap.groupBy(*grouped, "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return united.groupBy(*names).agg(F.sum(F.bitmap_count("users")).alias("user_count"))


def _with_users(sums: DataFrame, users: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = users.toDF(*[f"_{key}" for key in keys], "user_count")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    joined = sums.join(counts, same, "left").drop(*[f"_{key}" for key in keys])
    return joined.withColumn("user_count", F.coalesce("user_count", F.lit(0)))


def store_total(order_state: DataFrame, user_bitmap: DataFrame, dim_store: DataFrame) -> DataFrame:
    sums = order_state.groupBy("store_key").agg(
        *_units("order_count"),
        *_sums("sales_amount", "cost_amount", "profit_amount"),
        C.quotient(F.sum("sales_amount"), F.sum("amounts")).alias("avg_order_amount"),
    )
    totals = _with_users(sums, user_counts(user_bitmap, "store_key"), ["store_key"]).select("*", profit_rate())
    return totals.join(dim_store.select("store_key", "store_id", "store_name", "platform"), "store_key", "left")


def product_total(trade_product_1d: DataFrame, dim_product: DataFrame) -> DataFrame:
    sums = trade_product_1d.groupBy("product_key").agg(
        *_units("order_count", "sales_quantity"), *_sums("sales_amount", "cost_amount", "profit_amount")
    )
    attributes = dim_product.select("product_key", "product_id", "product_name", "category_l1", "category_l2")
    return sums.select("*", profit_rate()).join(attributes, "product_key", "left")


def category_total(category_state: DataFrame) -> DataFrame:
    sums = category_state.groupBy("category_l1", "category_l2", "platform").agg(
        *_units("order_count", "sales_quantity"), *_sums("sales_amount", "profit_amount")
    )
    return sums.select("*", profit_rate())


def user_total(user_state: DataFrame, dim_user: DataFrame) -> DataFrame:
    totals = (
        user_state.groupBy("user_key")
        .agg(
            *_units("order_count"),
            *_sums("total_amount"),
            C.quotient(F.sum("total_amount"), F.sum("amounts")).alias("avg_order_amount"),
            F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
        )
        .withColumn("user_level", C.user_level(F.col("total_amount")))
    )
    attributes = dim_user.select("user_key", "user_id", "gender", "age", "age_group", "city")
    return totals.join(attributes, "user_key", "left")


def sales_monthly(order_state: DataFrame, user_bitmap: DataFrame) -> DataFrame:
    month = C.month_of_key(F.col("date_key")).alias("year_month")
    sums = order_state.groupBy(month, "platform").agg(
        *_units("order_count"), *_sums("sales_amount", "cost_amount", "profit_amount")
    )
    users = user_counts(user_bitmap, C.month_of_key(F.col("date_key")), "platform")
    average = C.ratio(F.col("sales_amount"), F.col("order_count")).alias("avg_order_amount")
    return _with_users(sums, users, ["year_month", "platform"]).select("*", profit_rate(), average)
