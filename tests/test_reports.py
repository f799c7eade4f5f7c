import datetime as dt
from decimal import Decimal

import pytest
from conftest import records

from retailoom.operators import quality, reports, summaries

D = Decimal
DAY, KEY = dt.date(2024, 3, 5), 20240305


@pytest.fixture(scope="module")
def dim_store(spark):
    return spark.createDataFrame([(1, "一店"), (2, "二店")], "store_key bigint, store_name string")


@pytest.fixture(scope="module")
def dim_product(spark):
    rows = [(1, "P1", "K1", "n", "s", "整车-品牌", "c"), (2, "P1", "K2", "n", "s", "骑行装备", "c")]
    return spark.createDataFrame(
        rows,
        "product_key bigint, product_id string, sku_id string, product_name string, spec string, category_l1 string, "
        "category_l2 string",
    )


def make_sales(spark, *rows):
    """(order, date, platform, store, user, source, product, quantity, amount, cost)"""
    return spark.createDataFrame(
        [(*r[:8], D(r[8]), D(r[9]), D(r[8]) - D(r[9])) for r in rows],
        "order_id string, date_key int, platform string, store_key bigint, user_key bigint, traffic_source string, "
        "product_key bigint, quantity bigint, amount decimal(18,2), cost_amount decimal(18,2), "
        "profit_amount decimal(18,2)",
    )


def make_promotion(spark, *rows):
    """(date, platform, store, product, channel, cost, impressions, clicks)"""
    return spark.createDataFrame(
        [(*r[:5], D(r[5]), *r[6:]) for r in rows],
        "date_key int, platform string, store_key bigint, product_key bigint, channel string, cost decimal(10,2), "
        "impressions int, clicks int",
    )


def daily(spark, dim_store, dim_product, sales, promotion):
    return reports.daily_report(sales, promotion, dim_store, dim_product)


def test_profit_and_loss(spark, dim_store, dim_product):
    sales = make_sales(
        spark,
        ("O1", KEY, "甲", 1, 7, "搜索", 1, 2, "200.00", "120.00"),
        ("O2", KEY, "甲", 1, 7, "搜索", 1, 1, "100.05", "60.00"),
    )
    promotion = make_promotion(spark, (KEY, "甲", 1, 1, "a", "5.00", 10, 1), (KEY, "甲", 1, 1, "b", "2.50", 10, 1))
    (row,) = daily(spark, dim_store, dim_product, sales, promotion).collect()
    assert (row["order_count"], row["customer_count"], row["quantity"]) == (2, 1, 3)
    assert (row["sales_amount"], row["freight"]) == (D("300.05"), D("90.00"))
    assert (row["gross_profit"], row["gross_rate"]) == (D("30.05"), D("10.01"))
    assert (row["promo_cost"], row["after_sale_fee"]) == (D("7.50"), D("6.00"))
    assert (row["platform_fee"], row["management_fee"]) == (D("15.00"), D("30.01"))
    assert (row["net_profit"], row["net_rate"]) == (D("-28.46"), D("-9.48"))
    assert row["avg_order_value"] == D("150.03")


def test_promotion_without_sales_and_null_keys(spark, dim_store, dim_product):
    sales = make_sales(
        spark,
        ("O1", KEY, "甲", 1, 7, "搜索", 1, 1, "10", "1"),
        ("O2", KEY, "甲", 1, 8, "搜索", None, 1, "20", "0"),
    )
    promotion = make_promotion(
        spark,
        (KEY, "甲", 1, 1, "a", "1", 1, 1),  # sold: goes to the sales row
        (KEY, "甲", 1, 2, "a", "2", 1, 1),  # not sold
        (KEY, "甲", 1, None, "a", "3", 1, 1),  # unknown product: matches nothing, not even the unknown sale
        (KEY, "甲", None, 1, "a", "4", 1, 1),  # unknown store
        (20240304, "甲", 1, 1, "a", "5", 1, 1),  # sold on another day only
        (20240101, "甲", 1, 2, "a", "6", 1, 1),  # long before the first sale
    )
    report = daily(spark, dim_store, dim_product, sales, promotion)
    found = [(r["date"], r["store_name"], r["sku_id"], r["order_count"], r["promo_cost"]) for r in report.collect()]
    assert sorted(found, key=repr) == sorted(
        [
            (DAY, "一店", "K1", 1, D("1.00")),
            (DAY, "一店", None, 1, D("0.00")),
            (DAY, "一店", "K2", 0, D("2.00")),
            (DAY, "一店", None, 0, D("3.00")),
            (DAY, None, "K1", 0, D("4.00")),
            (dt.date(2024, 3, 4), "一店", "K1", 0, D("5.00")),
            (dt.date(2024, 1, 1), "一店", "K2", 0, D("6.00")),
        ],
        key=repr,
    )
    only = reports.daily_report_promo_only(report).collect()
    assert all(r["net_profit"] == -r["promo_cost"] and r["net_rate"] == 0 and r["freight"] == 0 for r in only)
    assert reports.daily_report_sales(report).count() == 2


def test_one_key_on_two_platforms(spark, dim_store, dim_product):
    """Each sales row of a key carries all promotion cost of the key; a platform without sales adds no row."""
    sales = make_sales(
        spark,
        ("O1", KEY, "甲", 1, 7, "搜索", 1, 1, "10", "1"),
        ("O2", KEY, "乙", 1, 7, "搜索", 1, 1, "10", "1"),
    )
    promotion = make_promotion(spark, (KEY, "甲", 1, 1, "a", "1", 1, 1), (KEY, "丙", 1, 1, "a", "2", 1, 1))
    found = records(daily(spark, dim_store, dim_product, sales, promotion), "platform")
    assert {k[0]: r["promo_cost"] for k, r in found.items()} == {"甲": D("3.00"), "乙": D("3.00")}


def test_summary_of_a_platform_that_sold_nothing(spark, dim_store, dim_product):
    promotion = make_promotion(spark, (KEY, "甲", 1, 1, "a", "1", 1, 1))
    report = daily(spark, dim_store, dim_product, make_sales(spark).limit(0), promotion)
    (row,) = reports.platform_summary(report).collect()
    assert (row["store_count"], row["order_count"], row["net_rate"], row["avg_order_value"]) == (1, 0, D("0.00"), None)


def test_ranking_ties(spark, dim_store, dim_product):
    sales = make_sales(
        spark,
        ("O1", KEY, "乙", 1, 7, "搜索", 1, 1, "10", "1"),
        ("O2", KEY, "甲", 1, 7, "搜索", 1, 1, "10", "1"),
        ("O3", KEY, "甲", 2, 7, "搜索", 1, 1, "20", "30"),
    )
    report = daily(spark, dim_store, dim_product, sales, make_promotion(spark).limit(0))
    found = records(reports.store_ranking(report), "platform", "store_name")
    assert {k: (r["sales_rank"], r["profit_rank"]) for k, r in found.items()} == {
        ("甲", "二店"): (1, 3),
        ("乙", "一店"): (2, 1),
        ("甲", "一店"): (3, 2),
    }
    assert [r["store_name"] for r in reports.newest_first(report).collect()] == ["一店", "一店", "二店"]


def test_traffic_report(spark, dim_store, dim_product):
    promotion = make_promotion(
        spark,
        (KEY, "甲", 1, 1, "a", "5.00", 100, 2),
        (KEY, "甲", 1, 2, "b", "5.70", 0, 2),
        (20240101, "甲", 1, 2, "b", "1", 1, 1),  # long before the first sale
        (KEY, "甲", 1, None, "b", "1", 1, 1),
    )
    natural = spark.createDataFrame(
        [(DAY, "甲", "S1", "K1", "x", 10, 0, 1, 2), (dt.date(2024, 1, 1), "甲", "S1", "K1", "x", 10, 4, 1, 2)],
        "date date, platform string, store_id string, sku_id string, channel string, impressions int, clicks int, "
        "favorites int, add_to_cart int",
    )
    sales = make_sales(
        spark,
        ("O1", KEY, "甲", 1, 7, "付费推广", 1, 1, "10", "1"),
        ("O2", KEY, "甲", 1, 7, "付费推广", 2, 2, "20", "1"),
        ("O3", KEY, "甲", 1, 7, "搜索", 2, 4, "40", "1"),
        ("O4", KEY, "甲", 1, 7, None, 2, 8, "80", "1"),  # neither paid nor natural
    )
    # both SKUs are of one SPU, and here of one category
    products = dim_product.withColumn("category_l1", dim_product["category_l2"])
    stores = spark.createDataFrame([(1, "S1", "一店")], "store_key bigint, store_id string, store_name string")
    report = reports.traffic_report(
        reports.paid_traffic_by_channel(promotion, stores, products),
        reports.natural_traffic_by_channel(natural, stores, products),
        reports.spu_sales(sales, stores, products),
    )
    found = records(report, "flow_type", "date")
    assert set(found) == {(flow, day) for flow in ("付费", "自然") for day in (DAY, dt.date(2024, 1, 1))}
    paid = found[("付费", DAY)]
    assert (paid["impressions"], paid["clicks"], paid["click_rate"]) == (100, 4, D("4.00"))
    assert (paid["sales_quantity"], paid["sales_amount"], paid["conversion_rate"]) == (3, D("30.00"), D("75.00"))
    assert (paid["cost"], paid["avg_click_cost"], paid["roi"]) == (D("10.70"), D("2.68"), D("2.80"))
    assert (paid["favorites"], paid["add_to_cart"]) == (0, 0)
    free = found[("自然", DAY)]
    assert (free["sales_quantity"], free["conversion_rate"], free["cost"], free["roi"]) == (4, D("0.00"), 0, 0)
    assert found[("自然", dt.date(2024, 1, 1))]["sales_quantity"] == 0


def test_top_products(spark):
    rows = [(n, 1, n % 4, D(100 - n), D(1), D(n), D("1.00")) for n in range(1, 31)] + [(None, 1, 99, D(999), D(1), D(9), D(1))]
    totals = spark.createDataFrame(
        rows,
        "product_key bigint, order_count bigint, sales_quantity bigint, sales_amount decimal(18,2), "
        "cost_amount decimal(18,2), profit_amount decimal(18,2), profit_rate decimal(18,2)",
    )
    found = summaries.top_products(totals, 3).collect()
    best = {(r["rank_type"], r["rank"]): r["product_key"] for r in found}
    assert best == {
        ("sales", 1): 1, ("sales", 2): 2, ("sales", 3): 3,
        ("quantity", 1): 3, ("quantity", 2): 7, ("quantity", 3): 11,
        ("profit", 1): 30, ("profit", 2): 29, ("profit", 3): 28,
    }


def test_metrics_agree_or_fail(spark):
    layers = ("ODS", "DWD")
    rows = [(layer, metric, D("10.00")) for layer in layers for metric in quality.METRICS]
    schema = "layer string, metric string, value decimal(18,2)"
    good = spark.createDataFrame(rows, schema)
    assert quality.all_consistent(quality.consistency_check(good, layers))
    near = spark.createDataFrame([(a, b, v + D("0.99") * (a == "DWD")) for a, b, v in rows], schema)
    assert quality.all_consistent(quality.consistency_check(near, layers))
    off = spark.createDataFrame([(a, b, v + (a == "DWD")) for a, b, v in rows], schema)
    assert not quality.all_consistent(quality.consistency_check(off, layers))
    missing = good.filter("layer = 'ODS'")
    assert not quality.all_consistent(quality.consistency_check(missing, layers))
    assert not quality.all_consistent(quality.consistency_check(good.limit(0), layers))


def test_counts_and_duplicates(spark):
    table = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    counts = quality.row_counts(spark, {"a": table, "b": None})
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {"a": 4, "b": 0}
    assert {(r["k"], r["occurrences"]) for r in quality.duplicate_keys(table, "k").collect()} == {(1, 2), (None, 1)}
