"""Dimensions of the star schema."""

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailoom import config
from retailoom.functions import columns as C
from retailoom.functions.numbering import surrogate_key


def dim_date(spark: SparkSession, end: dt.date | None = None, days: int = config.DATE_DIM_DAYS) -> DataFrame:
    """Calendar of the ``days`` days up to ``end`` (today if not given)."""
    last = end or dt.date.today()
    first = last - dt.timedelta(days=days - 1)
    bounds = spark.range(1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))
    return _calendar(bounds)


def dim_date_over(tables: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Calendar from the first to the last day found in the tables (rows, their day); absurd days don't count."""

    def bounds(rows: DataFrame, day: str) -> DataFrame:
        moment = F.col(day).cast("date")
        some = moment.between(F.lit(config.CALENDAR_FIRST_DAY).cast("date"), F.lit(config.CALENDAR_LAST_DAY).cast("date"))
        return rows.where(some).agg(F.min(moment).alias("first_day"), F.max(moment).alias("last_day"))

    every = reduce(DataFrame.unionByName, [bounds(rows, day) for rows, day in tables])
    return _calendar(every.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")))


def _calendar(bounds: DataFrame) -> DataFrame:
    day = F.col("date_value")
    week = C.week_from_monday(day)
    names = F.array(*[F.lit(name) for name in config.WEEKDAY_NAMES])
    days = bounds.filter("first_day is not null").select(
        F.explode(F.sequence("first_day", "last_day")).alias("date_value")
    )
    return days.select(
        C.date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        week.alias("week"),
        F.dayofmonth(day).alias("day"),
        (F.weekday(day) + 1).alias("weekday"),
        F.element_at(names, F.weekday(day) + 1).alias("weekday_name"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.format_string("%d-W%02d", F.year(day), week).alias("year_week"),
    )


def dim_user(users: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = users.filter("user_id is not null").select(
        "user_id",
        "user_name",
        "gender",
        "age",
        C.age_group(F.col("age")).alias("age_group"),
        "city",
        "register_date",
    )
    return surrogate_key(rows, "user_id", "user_key", existing)


def dim_product(products: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    price, cost = F.col("price"), F.col("cost")
    rows = products.filter("sku_id is not null").select(
        "sku_id",
        "product_id",
        "store_id",
        "product_name",
        "spec",
        "category_l1",
        "category_l2",
        "price",
        "cost",
        C.percent(price - cost, price).alias("profit_margin"),
        "stock",
        "platform",
    )
    return surrogate_key(rows, "sku_id", "product_key", existing)


def dim_store(stores: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = stores.filter("store_id is not null").select(
        "store_id",
        "store_name",
        "platform",
        C.store_type(F.col("store_name")).alias("store_type"),
        "open_date",
    )
    return surrogate_key(rows, "store_id", "store_key", existing)


def dim_category(dim_product: DataFrame) -> DataFrame:
    """The category pairs in use, with an id made of their names."""
    pairs = dim_product.select("category_l1", "category_l2").distinct()
    return pairs.select(F.concat_ws("/", "category_l1", "category_l2").alias("category_id"), "category_l1", "category_l2")
