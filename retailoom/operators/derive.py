"""Raw tables derived from a traffic log, from products and from order lines."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailoom import config
from retailoom.functions import columns as C
from retailoom.functions.numbering import hash_bucket, number_by_hash

# ids handed out by one generated array, so that many copies of a row never make a huge array
ID_CHUNK = 10_000

# 65,536 buckets for numbering rows of a log
ROW_HASH_DIGITS = 4


def split_paid(traffic: DataFrame) -> DataFrame:
    """Paid rows of the traffic log as promotion rows, numbered ``PM00000001`` onwards.

    Copies of a row are counted first and get a run of numbers, so a large group of copies is one row
    while the numbers are worked out.
    """
    content = ["date", "store_id", "platform", "sku_id", "product_id", "channel", "cost", "impressions", "clicks"]
    distinct = (
        traffic.filter(F.col("flow_type") == config.FLOW_PAID)
        .groupBy(*content)
        .agg(F.count("*").alias("copies"))
        .withColumn("bucket", hash_bucket(*content, digits=ROW_HASH_DIGITS))
    )
    sizes = distinct.groupBy("bucket").agg(F.sum("copies").alias("rows"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    order = [F.col(c).asc_nulls_first() for c in content]
    within = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        distinct.withColumn("before", F.coalesce(F.sum("copies").over(within), F.lit(0)))
        .join(offsets, "bucket")  # one row per hash prefix
        .withColumn("first", F.col("offset") + F.col("before") + 1)
        .withColumn("last", F.col("first") + F.col("copies") - 1)
    )
    # a long run is cut, and its parts are dealt to other tasks before they become rows
    long = runs.filter(F.col("copies") > ID_CHUNK)
    parts = long.withColumn("part", F.explode(F.sequence("first", "last", F.lit(ID_CHUNK).cast("bigint"))))
    parts = (
        parts.withColumn("last", F.least(F.col("last"), F.col("part") + ID_CHUNK - 1))
        .withColumn("first", F.col("part"))
        .drop("part")
        .repartition("first")
    )
    numbered = runs.filter(F.col("copies") <= ID_CHUNK).unionByName(parts)
    return numbered.withColumn("number", F.explode(F.sequence("first", "last"))).select(
        F.format_string("PM%08d", "number").alias("promotion_id"),
        *content,
        C.percent(F.col("clicks"), F.col("impressions")).alias("ctr"),
    )


def split_natural(traffic: DataFrame) -> DataFrame:
    """Natural rows of the traffic log as product traffic rows."""
    return traffic.filter(F.col("flow_type") == config.FLOW_NATURAL).select(
        "date", "store_id", "platform", "sku_id", "product_id", "channel", "impressions", "clicks"
    )


def store_traffic_rollup(traffic: DataFrame) -> DataFrame:
    """Store traffic per day. Visitors, views and their parts are shares of the clicks, rounded down."""

    def tenths(column: str, share: int) -> Column:
        return F.floor(F.col(column) * share / 10).cast("bigint")

    sums = traffic.groupBy("date", "store_id", "platform").agg(
        C.units("impressions").alias("impressions"), C.units("clicks").alias("clicks")
    )
    return sums.withColumn("visitors", tenths("clicks", 8)).select(
        "date",
        "store_id",
        "platform",
        "impressions",
        "clicks",
        "visitors",
        tenths("clicks", 15).alias("page_views"),
        tenths("visitors", 4).alias("search_traffic"),
        tenths("visitors", 3).alias("recommend_traffic"),
        tenths("visitors", 2).alias("direct_traffic"),
        tenths("visitors", 1).alias("other_traffic"),
    )


def sku_store_daily_clicks(traffic: DataFrame) -> DataFrame:
    """Clicks per day, SKU and store; paid if any of the rows is."""
    paid = F.bool_or(F.col("flow_type") == config.FLOW_PAID)
    return (
        traffic.filter("date is not null and sku_id is not null and store_id is not null")
        .groupBy("date", "sku_id", "store_id")
        .agg(
            C.units("clicks").alias("clicks"),
            F.when(paid, config.FLOW_PAID).otherwise(config.FLOW_NATURAL).alias("flow_type"),
            F.min("platform").alias("platform"),
            F.min("product_id").alias("product_id"),
            F.min("product_tier").alias("product_tier"),
        )
    )


def allocate_orders(clicks: DataFrame, per_day: int) -> DataFrame:
    """Share out ``per_day`` orders of each day by clicks x conversion rate of the tier.

    Every row gets the whole part of its share; the orders left over go to the largest remainders, ties
    by hash. No day is sorted: the remainders of a day fall into ``REMAINDER_RANGES`` ranges, and their
    row counts tell the one range where the left-over orders run out. Ranges above it get one order per
    row, those below none; only rows of that range are ranked, in buckets of equal remainder and hash
    prefix. Weights are integers, so that every engine gets the same remainders.
    """
    weighted = clicks.withColumn("weight", F.col("clicks") * C.conversion_rate(F.col("product_tier"))).filter(
        "weight > 0"
    )
    days = weighted.groupBy("date").agg(F.sum("weight").alias("day_weight"))
    whole = F.floor(F.expr(f"({per_day} * weight) div day_weight")).cast("bigint")
    shares = (
        weighted.join(days, "date")
        .withColumn("whole", whole)
        .withColumn("remainder", F.expr(f"({per_day} * weight) % day_weight"))
        .withColumn("range", F.expr(f"(cast(remainder as decimal(38,0)) * {config.REMAINDER_RANGES}) div day_weight"))
        .withColumn("tie", hash_bucket("sku_id", "store_id"))
    )
    ranges = shares.groupBy("date", "range").agg(F.count("*").alias("rows"), F.sum("whole").alias("given"))
    day = Window.partitionBy("date")
    above = day.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    # orders that are left for a range and those below it: at most REMAINDER_RANGES rows a day
    rests = ranges.select(
        "date",
        "range",
        "rows",
        (per_day - F.sum("given").over(day) - F.coalesce(F.sum("rows").over(above), F.lit(0))).alias("rest"),
    )
    dealt = shares.join(rests, ["date", "range"])
    clear = dealt.filter("rest <= 0 or rest >= rows").withColumn("extra", F.when(F.col("rest") > 0, 1).otherwise(0))
    edge = dealt.filter("rest > 0 and rest < rows")
    bucket = ["date", "remainder", "tie"]
    sizes = edge.groupBy(*bucket).agg(F.count("*").alias("size"))
    largest_first = day.orderBy(F.desc("remainder"), "tie").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*bucket, F.coalesce(F.sum("size").over(largest_first), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy(*bucket).orderBy("sku_id", "store_id")) + F.col("before")
    ranked = edge.join(offsets, bucket).withColumn("extra", F.when(place <= F.col("rest"), 1).otherwise(0))
    return clear.unionByName(ranked.drop("before")).select(
        "date",
        "sku_id",
        "store_id",
        "platform",
        "product_id",
        "flow_type",
        "weight",
        (F.col("whole") + F.col("extra")).alias("orders"),
    )


def initial_inventory(products: DataFrame, users: DataFrame) -> DataFrame:
    """One stock-in row per SKU, dated at the first registration of a user."""
    first_day = users.select(F.min("register_date")).scalar()
    numbered = number_by_hash(products.filter("sku_id is not null"), "sku_id", "number")
    return numbered.select(
        F.format_string("INV%08d", "number").alias("inventory_id"),
        first_day.alias("date"),
        "sku_id",
        "store_id",
        F.lit(config.STOCK_IN).alias("change_type"),
        F.col("stock").alias("change_quantity"),
        F.col("stock").alias("stock_quantity"),
        F.lit(config.INITIAL_STOCK_REMARK).alias("remark"),
    )


def product_stats(products: DataFrame) -> DataFrame:
    counts = products.agg(
        F.count("*").alias("sku_count"),
        F.count_distinct("product_id").alias("product_count"),
        F.count_distinct("product_code").alias("product_code_count"),
    )
    per_product = C.ratio(F.col("sku_count"), F.col("product_count")).alias("skus_per_product")
    return counts.select("*", per_product)


def order_line_rollup(details: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Amount, cost and freight of each order from its lines, at the price and cost of the product.

    Lines of unknown SKUs keep their own amount; they cost nothing and have the freight of other goods. The order counts as paid, and as having a cost, only once it is finished.
    """
    quantity = F.col("quantity")
    lines = (
        details.groupBy("order_id", "sku_id")
        .agg(C.units("quantity").alias("quantity"), F.sum("amount").alias("amount"))
        .join(products.select("sku_id", "price", "cost", "category_l1"), "sku_id", "left")
    )
    sums = lines.groupBy("order_id").agg(
        C.money(F.sum(F.coalesce(F.col("price") * quantity, F.col("amount")))).alias("total_amount"),
        C.money(F.sum(F.coalesce(F.col("cost"), F.lit(0)) * quantity)).alias("item_cost"),
        C.money(F.sum(C.unit_freight(F.col("category_l1")) * quantity)).alias("shipping_fee"),
    )
    finished = F.col("order_status") == config.ORDER_FINISHED

    def if_finished(column: str) -> Column:
        return F.when(finished, F.col(column)).otherwise(F.lit(0).cast(C.MONEY))

    return sums.join(orders.select("order_id", "order_status"), "order_id").select(
        "order_id",
        "total_amount",
        "shipping_fee",
        if_finished("total_amount").alias("final_amount"),
        if_finished("item_cost").alias("total_cost"),
    )
