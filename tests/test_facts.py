import datetime as dt
from decimal import Decimal

import pytest
from conftest import records

from retailoom.operators import dims, facts

D = Decimal
ORDER = (
    "order_id string, user_id string, store_id string, platform string, order_time timestamp, order_status string, "
    "payment_method string, traffic_source string, total_amount decimal(12,2), discount_amount decimal(12,2), "
    "shipping_fee decimal(12,2), final_amount decimal(12,2), total_cost decimal(12,2)"
)
NOON = dt.datetime(2024, 3, 5, 12)


@pytest.fixture(scope="module")
def users(spark):
    return dims.dim_user(
        spark.createDataFrame(
            [("U1", "a", "男", 30, "x", dt.date(2020, 1, 1)), (None, "b", "女", 20, "x", dt.date(2020, 1, 1))],
            "user_id string, user_name string, gender string, age int, city string, register_date date",
        )
    )


@pytest.fixture(scope="module")
def stores(spark):
    return dims.dim_store(
        spark.createDataFrame(
            [("S1", "【甲】旗舰店", "甲", dt.date(2019, 1, 1)), (None, "x", "甲", dt.date(2019, 1, 1))],
            "store_id string, store_name string, platform string, open_date date",
        )
    )


@pytest.fixture(scope="module")
def products(spark):
    return dims.dim_product(
        spark.createDataFrame(
            [
                ("K1", "P1", "S1", "n", "s", "整车-品牌", "c", D("100"), D("60"), 5, "甲"),
                ("K2", "P1", "S1", "n", "s", "骑行装备", "c", D("0"), D("60"), 5, "甲"),
                ("K3", "P2", "S1", "n", "s", "骑行装备", "c", D("0.01"), D("2000"), 5, "甲"),
                (None, "P3", "S1", "n", "s", "骑行装备", "c", D("1"), D("1"), 5, "甲"),
            ],
            "sku_id string, product_id string, store_id string, product_name string, spec string, category_l1 string, "
            "category_l2 string, price decimal(10,2), cost decimal(10,2), stock int, platform string",
        )
    )


@pytest.fixture(scope="module")
def orders(spark, users, stores):
    rows = [
        ("O1", "U1", "S1", "甲", NOON, "已完成", "微信", None, D("9"), None, None, D("8"), None),
        ("O2", "U1", "S1", "甲", NOON, "已取消", "微信", "搜索", D("9"), D("1"), D("3"), D("0"), D("5")),
        ("O3", "U9", "S1", "甲", NOON, "已完成", "微信", "搜索", D("9"), D("1"), D("3"), D("8"), D("5")),
        ("O4", "U1", "S9", "甲", NOON, "已完成", "微信", "搜索", D("9"), D("1"), D("3"), D("8"), D("5")),
        (None, "U1", "S1", "甲", NOON, "已完成", "微信", "搜索", D("9"), D("1"), D("3"), D("8"), D("5")),
    ]
    return facts.fact_order(spark.createDataFrame(rows, ORDER), users, stores)


def test_margins_and_null_ids(products):
    margin = {row["sku_id"]: row["profit_margin"] for row in products.collect()}
    assert margin == {"K1": D("40.00"), "K2": D("0.00"), "K3": D("-19999900.00")}


def test_orders_without_user_or_store_are_left_out(orders):
    found = records(orders, "order_id")
    assert set(found) == {("O1",), ("O2",)}
    first = found[("O1",)]
    assert (first["discount_amount"], first["shipping_fee"], first["total_cost"]) == (0, 0, 0)
    assert (first["profit_amount"], first["date_key"]) == (D("8.00"), 20240305)
    assert found[("O2",)]["profit_amount"] == D("-5.00")


def test_a_repeated_order_counts_once(spark, orders, users, stores):
    again = orders.select("order_id", "user_id", "store_id", "platform", "order_time", "order_status", "total_amount", "discount_amount",
                          "shipping_fee", "final_amount", "total_cost", "payment_method", "traffic_source")
    assert facts.fact_order(again.union(again), users, stores).count() == orders.count()


def test_lines(spark, orders, products):
    rows = [
        ("D1", "O1", "K1", "P1", 2, D("50"), D("100")),
        ("D2", "O1", "K9", "P9", 1, D("7"), D("7")),
        ("D3", "O1", None, "P9", 1, D("0"), D("0")),
        ("D4", "O3", "K1", "P1", 1, D("7"), D("7")),
    ]
    schema = (
        "order_detail_id string, order_id string, sku_id string, product_id string, quantity int, "
        "price decimal(10,2), amount decimal(12,2)"
    )
    found = records(facts.fact_order_detail(spark.createDataFrame(rows, schema), orders, products), "order_detail_id")
    assert set(found) == {("D1",), ("D2",), ("D3",)}
    line = found[("D1",)]
    assert (line["cost_amount"], line["profit_amount"], line["profit_margin"]) == (D("120"), D("-20"), D("-20.00"))
    assert line["product_key"] is not None and line["order_status"] == "已完成" and line["date_key"] == 20240305
    assert found[("D2",)]["product_key"] is None and found[("D2",)]["profit_margin"] == 100
    assert found[("D3",)]["profit_margin"] == 0


def test_promotion_guards(spark, stores, products):
    day = dt.date(2024, 3, 5)
    rows = [
        ("M1", day, "S1", "甲", "K1", "a", D("5.35"), 8, 2),
        ("M2", day, "S9", "甲", "K9", "a", D("5"), 0, 0),
        (None, day, "S1", "甲", "K1", "a", D("5"), 1, 1),
    ]
    schema = (
        "promotion_id string, date date, store_id string, platform string, sku_id string, channel string, "
        "cost decimal(10,2), impressions int, clicks int"
    )
    found = records(facts.fact_promotion(spark.createDataFrame(rows, schema), stores, products), "promotion_id")
    assert set(found) == {("M1",), ("M2",)}
    assert (found[("M1",)]["ctr"], found[("M1",)]["cpc"]) == (D("25.00"), D("2.68"))
    second = found[("M2",)]
    assert (second["ctr"], second["cpc"], second["store_key"], second["product_key"]) == (0, 0, None, None)


def test_inventory_and_traffic(spark, stores, products):
    day = dt.date(2024, 3, 5)
    moves = spark.createDataFrame(
        [("I1", day, "K1", "S1", "入库", 5, 5), ("I2", day, "K9", "S9", "出库", 2, 3), ("I3", day, "K1", "S1", "盘点", 9, 3)],
        "inventory_id string, date date, sku_id string, store_id string, change_type string, change_quantity int, "
        "stock_quantity int",
    )
    found = records(facts.fact_inventory(moves, products, stores), "inventory_id")
    assert {k[0]: (r["in_quantity"], r["out_quantity"]) for k, r in found.items()} == {
        "I1": (5, 0),
        "I2": (0, 2),
        "I3": (0, 0),
    }
    traffic = spark.createDataFrame(
        [(day, "S1", "甲", 1), (day, "S9", "甲", 2), (None, "S1", "甲", 3)],
        "date date, store_id string, platform string, visitors int",
    ).selectExpr(
        "*", "0 page_views", "0 search_traffic", "0 recommend_traffic", "0 direct_traffic", "0 other_traffic",
        "0 avg_stay_time", "0 bounce_rate",
    )
    keys = {row["visitors"]: row["store_key"] for row in facts.fact_traffic(traffic, stores).collect()}
    assert keys == {1: 1, 2: None}


def test_load_stamp(orders):
    stamped = facts.stamped(orders, NOON).first()
    assert (stamped["etl_date"], stamped["etl_time"]) == (NOON.date(), NOON)
