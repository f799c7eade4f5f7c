"""Checks across the layers. Every check fails when something is missing; nothing is skipped in silence."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailoom import config
from retailoom.functions import columns as C

LAYERS = ("CSV", "ODS", "DWD", "DWS", "ADS")
METRICS = ("orders", "sales", "cost", "freight", "promo", "quantity")

# Pairs of layers and what must agree between them. Raw files have no quantities of their own, and the
# reports count an order once per SKU, so orders are not compared with them.
PAIRS = (
    ("CSV", "ODS", ("orders", "sales", "promo")),
    ("ODS", "DWD", ("orders", "sales", "promo", "quantity")),
    ("DWD", "DWS", ("orders", "sales", "promo", "quantity")),
    ("DWS", "ADS", ("sales", "promo", "quantity")),
)


def _long(layer: str, totals: DataFrame) -> DataFrame:
    """One row of totals as rows (layer, metric, value)."""
    pairs = ", ".join(f"'{name}', cast(coalesce({name}, 0) as {C.MONEY})" for name in totals.columns)
    return totals.select(F.lit(layer).alias("layer"), F.expr(f"stack({len(totals.columns)}, {pairs}) as (metric, value)"))


def _none(name: str) -> Column:
    return F.lit(0).alias(name)


def _order_totals(orders: DataFrame) -> DataFrame:
    return orders.filter(C.is_completed()).agg(
        F.count("*").alias("orders"),
        F.sum("final_amount").alias("sales"),
        F.sum("total_cost").alias("cost"),
        F.sum("shipping_fee").alias("freight"),
    )


def raw_metrics(layer: str, orders: DataFrame, promotion: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Metrics of the raw files or raw tables; the quantity is 0 without ``details``."""
    parts = [_order_totals(orders), promotion.agg(F.sum("cost").alias("promo"))]
    if details is None:
        parts.append(promotion.limit(0).agg(F.count("*").alias("quantity")))
    else:
        done = orders.filter(C.is_completed()).select("order_id")
        parts.append(details.join(done, "order_id", "left_semi").agg(F.sum("quantity").alias("quantity")))
    return _union([_long(layer, part) for part in parts])


def dwd_metrics(fact_order: DataFrame, fact_order_detail: DataFrame, fact_promotion: DataFrame) -> DataFrame:
    lines = fact_order_detail.filter(C.is_completed()).agg(F.sum("quantity").alias("quantity"))
    parts = [_order_totals(fact_order), fact_promotion.agg(F.sum("cost").alias("promo")), lines]
    return _union([_long("DWD", part) for part in parts])


def dws_metrics(sales_daily: DataFrame, trade_product_1d: DataFrame, promotion_daily: DataFrame) -> DataFrame:
    """The rollups keep no freight."""
    orders = sales_daily.agg(
        F.sum("order_count").alias("orders"),
        F.sum("sales_amount").alias("sales"),
        F.sum("cost_amount").alias("cost"),
        _none("freight"),
    )
    quantity = trade_product_1d.agg(F.sum("sales_quantity").alias("quantity"))
    promo = promotion_daily.agg(F.sum("cost").alias("promo"))
    return _union([_long("DWS", part) for part in (orders, promo, quantity)])


def ads_metrics(daily_report: DataFrame) -> DataFrame:
    """Cost and freight are not compared at this layer."""
    totals = daily_report.agg(
        F.sum("order_count").alias("orders"),
        F.sum("sales_amount").alias("sales"),
        _none("cost"),
        _none("freight"),
        F.sum("promo_cost").alias("promo"),
        F.sum("quantity").alias("quantity"),
    )
    return _long("ADS", totals)


def layer_metrics(*layers: DataFrame) -> DataFrame:
    """Rows (layer, metric, value) of all layers."""
    return _union(layers)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _wide(metrics: DataFrame, by: str, names: Sequence[str]) -> DataFrame:
    """A handful of rows: one per layer or one per metric."""
    rest = "layer" if by == "metric" else "metric"
    return metrics.groupBy(rest).pivot(by, list(names)).agg(F.max("value"))


def layer_pnl(metrics: DataFrame) -> DataFrame:
    """Profit and loss per layer."""
    sales, promo = F.col("sales"), F.col("promo")
    fees = sum(
        (sales * F.lit(rate).cast("decimal(2,2)") for rate in (config.PLATFORM_FEE, config.MANAGEMENT_FEE)),
        sales * F.lit(config.AFTER_SALE_FEE).cast("decimal(2,2)"),
    )
    gross = C.money(sales - F.col("cost") - F.col("freight"))
    net = (gross - promo - fees).cast("decimal(22,4)")
    return _wide(metrics, "metric", METRICS).select(
        "layer",
        gross.alias("gross_profit"),
        C.percent(gross, sales).alias("gross_rate"),
        "promo",
        C.percent(promo, sales).alias("promo_rate"),
        C.money(F.round(net, 2)).alias("net_profit"),
        C.percent(net, sales).alias("net_rate"),
    )


def consistency_check(
    metrics: DataFrame, layers: Sequence[str] = LAYERS, tolerance: str = config.CONSISTENCY_TOLERANCE
) -> DataFrame:
    """Differences between neighbouring layers, one row per compared metric.

    ``layers`` are the layers that must be there: a missing one makes its rows fail.
    """
    compared = [(left, right, fields) for left, right, fields in PAIRS if left in layers and right in layers]
    pairs = F.array(
        *[
            F.struct(
                F.lit(f"{left}-{right}").alias("pair"),
                F.abs(F.col(left) - F.col(right)).alias("difference"),
                F.col("metric").isin(*fields).alias("compared"),
            )
            for left, right, fields in compared
        ]
    )
    within = F.col("difference") < F.lit(tolerance).cast("decimal(9,2)")
    return (
        _wide(metrics, "layer", layers)
        .select("metric", F.inline(pairs))
        .filter("compared")
        .select("pair", "metric", C.money(F.col("difference")).alias("diff"), F.coalesce(within, F.lit(False)).alias("ok"))
    )


def all_consistent(check: DataFrame) -> bool:
    """Whether something was compared and all of it agreed."""
    row = check.agg(F.count("*").alias("compared"), F.bool_and("ok").alias("ok")).first()
    return row["compared"] > 0 and bool(row["ok"])


def row_counts(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per table; 0 for a table that is missing."""

    def count_of(name: str, table: DataFrame | None) -> DataFrame:
        if table is None:
            return spark.range(1).select(F.lit(name).alias("table_name"), F.lit(0).cast("bigint").alias("row_count"))
        return table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    return _union([count_of(name, table) for name, table in tables.items()])


def calendar_coverage(calendar: DataFrame, tables: Mapping[str, DataFrame], days: Mapping[str, str]) -> DataFrame:
    """Rows with a day per table, and how many of them have their day in the calendar."""

    def covered(name: str, rows: DataFrame) -> DataFrame:
        by_day = rows.groupBy(F.col(days[name]).cast("date").alias("date_value")).agg(F.count("*").alias("rows"))
        known = calendar.select("date_value", F.lit(1).alias("known"))
        return (
            by_day.filter("date_value is not null")
            .join(known, "date_value", "left")
            .agg(
                C.units("rows").alias("row_count"),
                F.coalesce(F.sum(F.when(F.col("known") == 1, F.col("rows"))), F.lit(0)).cast("bigint").alias("covered_count"),
            )
            .select(F.lit(name).alias("table_name"), "row_count", "covered_count")
        )

    return _union([covered(name, rows) for name, rows in tables.items()])


def duplicate_keys(table: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, or are NULL, in a table where they should be unique."""
    return (
        table.groupBy(*key)
        .agg(F.count("*").alias("occurrences"))
        .filter((F.col("occurrences") > 1) | C.any_null(key))
    )
