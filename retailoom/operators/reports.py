"""Report tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailoom import config
from retailoom.functions import columns as C
from retailoom.functions.numbering import rank_rows

SALE_KEY = ["date_key", "store_key", "product_key"]


def promo_cost_by_sku(fact_promotion: DataFrame) -> DataFrame:
    return fact_promotion.groupBy(*SALE_KEY).agg(C.total("cost").alias("promo_cost"))


def _sales_and_promotion(sales: DataFrame, fact_promotion: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales with the promotion cost of their key, and promotion cost of keys without sales.

    Sales and promotion rows are aggregated together, so each fact is read once. A key
    (date, store, product) with sales gives its whole promotion cost to each of its sales rows; a key
    without sales keeps its promotion rows. A NULL in the key matches nothing, hence ``loose``.

    The rows are shuffled to the products first, never the products sent to all tasks: they lie by product then, so that
    grouping, window and the later join with the products' names move nothing. Adaptive execution splits hot products.
    """
    keys = [*SALE_KEY, "platform"]
    sold = sales.select(
        *keys,
        F.lit(False).alias("loose"),
        F.when(F.col("order_id").isNotNull(), 1).alias("orders"),
        "user_key",
        "quantity",
        "amount",
        "cost_amount",
    )
    spent = fact_promotion.select(*keys, C.any_null(SALE_KEY).alias("loose"), F.col("cost").alias("promo"))
    known = dim_product.select("product_key", F.lit(True).alias("known")).hint("merge")
    grouped = (
        sold.unionByName(spent, allowMissingColumns=True)
        .join(known, "product_key", "left")
        .groupBy(*keys, "loose", "known")
        .agg(
            F.count("orders").alias("order_count"),
            F.count_distinct("user_key").alias("customer_count"),
            C.units("quantity").alias("quantity"),
            C.total("amount").alias("amount"),
            C.total("cost_amount").alias("cost_amount"),
            C.total("promo").alias("promo"),
        )
    )
    # a key has one row per platform here
    same_key = Window.partitionBy(*SALE_KEY, "loose")
    has_sales = F.col("order_count") > 0
    return (
        grouped.withColumn("key_promo", C.money(F.sum("promo").over(same_key)))
        .withColumn("key_sold", F.max(has_sales).over(same_key))
        .filter(has_sales | ~F.col("key_sold"))
        .select(
            *keys,
            "order_count",
            "customer_count",
            "quantity",
            "amount",
            "cost_amount",
            F.when(has_sales, F.col("key_promo")).otherwise(F.col("promo")).alias("promo_cost"),
        )
    )


def _profit_and_loss(rows: DataFrame) -> DataFrame:
    """Fees, profit and rates from quantity, amount, cost_amount, promo_cost and the category."""

    def of_sales(rate: str) -> Column:
        return F.col("amount") * F.lit(rate).cast("decimal(2,2)")

    fees = of_sales(config.AFTER_SALE_FEE) + of_sales(config.PLATFORM_FEE) + of_sales(config.MANAGEMENT_FEE)
    filled = rows.na.fill(0, ["quantity"]).withColumns(
        {name: C.money(F.coalesce(name, F.lit(0))) for name in ("amount", "cost_amount", "promo_cost")}
    )
    sums = filled.withColumn("freight", C.money(F.col("quantity") * C.unit_freight(F.col("category_l1")))).withColumn(
        "gross_profit", C.money(F.col("amount") - F.col("cost_amount") - F.col("freight"))
    )
    net = (F.col("gross_profit") - F.col("promo_cost") - fees).cast("decimal(22,4)")
    return sums.select(
        C.day_of_key(F.col("date_key")).alias("date"),
        "platform",
        "store_name",
        "product_id",
        "sku_id",
        "product_name",
        "spec",
        "category_l1",
        "category_l2",
        "order_count",
        "customer_count",
        "quantity",
        F.col("amount").alias("sales_amount"),
        "cost_amount",
        "freight",
        "gross_profit",
        C.percent(F.col("gross_profit"), F.col("amount")).alias("gross_rate"),
        "promo_cost",
        C.money(F.round(of_sales(config.AFTER_SALE_FEE), 2)).alias("after_sale_fee"),
        C.money(F.round(of_sales(config.PLATFORM_FEE), 2)).alias("platform_fee"),
        C.money(F.round(of_sales(config.MANAGEMENT_FEE), 2)).alias("management_fee"),
        C.money(F.round(net, 2)).alias("net_profit"),
        C.percent(net, F.col("amount")).alias("net_rate"),
        C.ratio(F.col("amount"), F.col("order_count")).alias("avg_order_value"),
    )


def daily_report(
    sales: DataFrame,
    fact_promotion: DataFrame,
    dim_store: DataFrame,
    dim_product: DataFrame,
    lay_out: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Daily profit and loss per platform, store and SKU, with promotion spend that sold nothing.

    The order count is per SKU and day: adding it up over SKUs counts an order once per SKU. ``lay_out`` may move the rows
    to where they are to be stored, before the columns that are worked out from others make them wide.
    """
    product = dim_product.select(
        "product_key", "product_id", "sku_id", "product_name", "spec", "category_l1", "category_l2"
    )
    rows = (
        _sales_and_promotion(sales, fact_promotion, dim_product)
        .join(product, "product_key", "left")
        .join(dim_store.select("store_key", "store_name"), "store_key", "left")
    )
    return _profit_and_loss(rows if lay_out is None else lay_out(rows.drop("store_key", "product_key")))


def daily_report_sales(report: DataFrame) -> DataFrame:
    """Rows of the daily report with sales."""
    return report.filter("order_count > 0")


def daily_report_promo_only(report: DataFrame) -> DataFrame:
    """Rows of the daily report with promotion spend but no sales."""
    return report.filter("order_count = 0")


def newest_first(report: DataFrame) -> DataFrame:
    """The order in which the report is shown; not needed for storing it."""
    return report.orderBy(F.desc("date"), "platform", "store_name")


def platform_summary(report: DataFrame) -> DataFrame:
    sums = report.groupBy("platform").agg(
        F.count_distinct("store_name").alias("store_count"),
        C.units("order_count").alias("order_count"),
        C.units("customer_count").alias("customer_count"),
        *[
            C.total(name).alias(name)
            for name in ("sales_amount", "cost_amount", "gross_profit", "promo_cost", "net_profit")
        ],
    )
    return sums.select(
        "*",
        C.percent(F.col("net_profit"), F.col("sales_amount")).alias("net_rate"),
        C.quotient(F.col("sales_amount"), F.col("order_count")).alias("avg_order_value"),
    )


def store_ranking(report: DataFrame) -> DataFrame:
    """Stores by sales and by net profit."""
    sums = report.groupBy("platform", "store_name").agg(
        C.units("order_count").alias("order_count"),
        C.total("sales_amount").alias("sales_amount"),
        C.total("net_profit").alias("net_profit"),
    )
    rated = sums.select("*", C.percent(F.col("net_profit"), F.col("sales_amount")).alias("net_rate"))
    by_sales = rank_rows(rated, "sales_amount", "sales_rank", ["platform", "store_name"])
    return rank_rows(by_sales, "net_profit", "profit_rank", ["platform", "store_name"])


# --- traffic report ------------------------------------------------------------------------------

SPU_NAMES = ["product_id", "category_l1", "category_l2"]
SPU = ["date", "platform", "store_name", *SPU_NAMES]
# sales are told apart by these; rows lie by them from the first grouping by SPU to the end
SPU_DAY = ["date", "platform", "store_name", "product_id"]


def _with_spu(rows: DataFrame, dim_product: DataFrame, product: str) -> DataFrame:
    """Name the SPU of each row; rows of unknown products are left out.

    The rows are shuffled for that, never the products sent to all tasks: they lie by product then, so combining them by
    product and more moves nothing. Adaptive execution splits hot products.
    """
    return rows.join(dim_product.select(product, *SPU_NAMES).hint("merge"), product)


def _to_spu(by_key: DataFrame, dim_store: DataFrame, store: str) -> DataFrame:
    """Name the store of each row, and put rows of an SPU, store and day together; rows of unknown stores are left out.

    The rows are combined by store and product before, so none of these groups is large.
    """
    return by_key.join(dim_store.select(store, "store_name"), store).drop(store).repartition(*SPU_DAY)


def paid_traffic_by_channel(fact_promotion: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    named = _with_spu(fact_promotion.where("date_key is not null"), dim_product, "product_key")
    by_key = named.groupBy("date_key", "platform", "store_key", "product_key", *SPU_NAMES, "channel").agg(
        C.units("impressions").alias("impressions"), C.units("clicks").alias("clicks"), C.total("cost").alias("cost")
    )
    dated = by_key.withColumn("date", C.day_of_key(F.col("date_key"))).drop("date_key", "product_key")
    sums = (
        _to_spu(dated, dim_store, "store_key")
        .groupBy(*SPU, "channel")
        .agg(
            C.units("impressions").alias("impressions"),
            C.units("clicks").alias("clicks"),
            C.total("cost").alias("cost"),
        )
    )
    return sums.select("*", C.ratio(F.col("cost"), F.col("clicks")).alias("avg_click_cost"))


def natural_traffic_by_channel(product_traffic: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    counts = ["impressions", "clicks", "favorites", "add_to_cart"]
    key = ["date", "platform", "store_id", "sku_id", "channel"]
    named = _with_spu(product_traffic.select(*key, *counts), dim_product, "sku_id")
    by_key = named.groupBy(*key, *SPU_NAMES).agg(*[C.units(c).alias(c) for c in counts])
    return (
        _to_spu(by_key.drop("sku_id"), dim_store, "store_id")
        .groupBy(*SPU, "channel")
        .agg(*[C.units(c).alias(c) for c in counts])
    )


def spu_sales(sales: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Sales per SPU, store and day, apart for paid and natural traffic.

    Orders without a traffic source belong to neither.
    """
    some = sales.where("traffic_source is not null and date_key is not null")
    is_paid = (F.col("traffic_source") == config.PAID_SOURCE).alias("is_paid")
    facts = some.select("date_key", "platform", "store_key", "product_key", is_paid, "quantity", "amount")
    named = _with_spu(facts, dim_product, "product_key")
    by_key = named.groupBy("date_key", "platform", "store_key", "product_key", "product_id", "is_paid").agg(
        C.units("quantity").alias("quantity"), C.total("amount").alias("amount")
    )
    dated = by_key.withColumn("date", C.day_of_key(F.col("date_key"))).drop("date_key", "product_key")
    return (
        _to_spu(dated, dim_store, "store_key")
        .groupBy(*SPU_DAY, F.when(F.col("is_paid"), config.FLOW_PAID).otherwise(config.FLOW_NATURAL).alias("flow_type"))
        .agg(C.units("quantity").alias("sales_quantity"), C.total("amount").alias("sales_amount"))
    )


def traffic_report(paid_by_channel: DataFrame, natural_by_channel: DataFrame, spu_sales: DataFrame) -> DataFrame:
    """Paid and natural traffic per SPU, store and day, with the sales each kind led to."""
    # the cost per channel is rounded before it is added up
    paid = paid_by_channel.select(
        *SPU,
        F.lit(config.FLOW_PAID).alias("flow_type"),
        "impressions",
        "clicks",
        F.lit(0).cast("bigint").alias("favorites"),
        F.lit(0).cast("bigint").alias("add_to_cart"),
        C.money(F.round("cost", 2)).alias("cost"),
    )
    natural = natural_by_channel.select(
        *SPU,
        F.lit(config.FLOW_NATURAL).alias("flow_type"),
        "impressions",
        "clicks",
        "favorites",
        "add_to_cart",
        F.lit(0).cast(C.MONEY).alias("cost"),
    )
    # Rows of all three lie by SPU_DAY, so sums and joins move nothing; a union in between would lose that. Both kinds read
    # the same sales, which Spark works out once as long as neither narrows them down: hence columns instead of filters.
    kinds = {config.FLOW_PAID: ("paid_quantity", "paid_amount"), config.FLOW_NATURAL: ("natural_quantity", "natural_amount")}
    sold = spu_sales.groupBy(*SPU_DAY).agg(
        *[
            F.sum(F.when(F.col("flow_type") == kind, F.col(measure))).cast(as_type).alias(name)
            for kind, names in kinds.items()
            for name, measure, as_type in zip(names, ("sales_quantity", "sales_amount"), ("bigint", C.MONEY))
        ]
    )
    clicks, quantity, amount = F.col("clicks"), F.col("sales_quantity"), F.col("sales_amount")
    is_paid = F.col("flow_type") == config.FLOW_PAID
    no_rate = F.lit(0).cast(C.RATE)

    def with_sales(rows: DataFrame, kind: str) -> DataFrame:
        traffic = rows.groupBy(*SPU, "flow_type").agg(
            *[C.units(c).alias(c) for c in ("impressions", "clicks", "favorites", "add_to_cart")],
            C.total("cost").alias("cost"),
        )
        named = dict(zip(("sales_quantity", "sales_amount"), kinds[kind]))
        theirs = sold.select(*SPU_DAY, *[F.col(name).alias(measure) for measure, name in named.items()])
        return traffic.join(theirs, SPU_DAY, "left")

    return (
        with_sales(paid, config.FLOW_PAID)
        .unionByName(with_sales(natural, config.FLOW_NATURAL))
        .withColumns(
            {
                "sales_quantity": F.coalesce(quantity, F.lit(0)),
                "sales_amount": C.money(F.coalesce(amount, F.lit(0))),
            }
        )
        .select(
            *SPU,
            "flow_type",
            "impressions",
            "clicks",
            C.percent(clicks, F.col("impressions")).alias("click_rate"),
            "favorites",
            "add_to_cart",
            "sales_quantity",
            "sales_amount",
            C.percent(quantity, clicks).alias("conversion_rate"),
            "cost",
            F.when(is_paid, C.ratio(F.col("cost"), clicks)).otherwise(no_rate).alias("avg_click_cost"),
            F.when(is_paid, C.ratio(amount, F.col("cost"))).otherwise(no_rate).alias("roi"),
        )
    )
