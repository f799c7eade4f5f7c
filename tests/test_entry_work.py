"""Registered queries do the work of their own result: they neither write nor read raw tables that it does not need."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows_of

import __spark_entry__ as registry
from retailoom.plans.star import Star
from retailoom.sources.tables import TableStore

STORES = "store_id string, store_name string, platform string, open_date date"
ORDERS = (
    "order_id string, user_id string, store_id string, platform string, order_time timestamp, order_status string, payment_method string, "
    "traffic_source string, total_amount decimal(12,2), discount_amount decimal(12,2), shipping_fee decimal(12,2), "
    "final_amount decimal(12,2), total_cost decimal(12,2)"
)


@pytest.fixture
def frames(spark):
    def order(number, day, user, status="已完成"):
        ten = Decimal("10.00")
        return (f"O{number}", user, "S1", "P", dt.datetime(2024, 1, day), status, "微信", "搜索", ten, None, None, ten, Decimal("6.50"))

    orders = [order(1, 1, "U1"), order(2, 1, "U2"), order(3, 2, "U1"), order(4, 2, "U2", "已取消"), order(5, 2, None), order(5, 2, "U2")]
    return {
        "ods_stores": spark.createDataFrame([("S1", "One, 旗舰店", "P", dt.date(2023, 1, 1)), (None, None, "P", None)], STORES),
        "ods_orders": spark.createDataFrame(orders, ORDERS),
    }


@pytest.mark.parametrize("name", ["csv_stores", "csv_orders", "csv_tolerant_orders"])
def test_csv_queries_need_their_own_table_only(spark, frames, name):
    table = "ods_stores" if name == "csv_stores" else "ods_orders"
    raw = {table: frames[table]}  # no other table is there to be written
    found = registry.CHECKS[name](Star(raw), spark)
    assert rows_of(found.select(frames[table].columns)) == rows_of(frames[table])


@pytest.fixture
def users(spark):
    rows = [("U1", "a", "男", 30, "X", dt.date(2023, 5, 1)), ("U2", "b", "女", None, "Y", dt.date(2023, 5, 2)), (None, "c", None, None, None, None)]
    return spark.createDataFrame(rows, "user_id string, user_name string, gender string, age int, city string, register_date date")


def test_merged_orders_need_orders_only(spark, frames):
    raw = {"ods_orders": frames["ods_orders"]}
    found = registry.CHECKS["merged_orders"](Star(raw), spark)
    assert rows_of(found.select(raw["ods_orders"].columns)) == rows_of(raw["ods_orders"])


@pytest.mark.parametrize("name", ["user_total", "store_total", "sales_monthly"])
def test_refreshed_totals_of_orders_need_no_lines(spark, frames, users, name):
    raw = frames | {"ods_users": users}
    found, expected = registry.CHECKS[f"refreshed_{name}"](Star(raw), spark), Star(raw).plan(name)
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows_of(found.select(expected.columns)) == rows_of(expected)
    assert found.count() > 0


def test_facts_of_one_use_are_not_stored_and_rows_move_for_no_month(spark):
    star = registry.star(spark, "/root/testdata/sf0.001")
    star.plan("product_total"), star.plan("daily_report"), star["fact_order_detail"]
    files = star["fact_order_detail"].inputFiles()
    assert files and not any("/fact_order_detail/" in file for file in files)
    assert not any("month_key=" in file for name in ("sales", "fact_promotion") for file in star[name].inputFiles())
    assert any("month_key=" in file for file in star["fact_order"].inputFiles())


def test_lines_are_not_moved_to_the_orders_of_a_day(spark, frames, tmp_path):
    days = [(f"O{n}", "U1", "S1", "P", dt.datetime(2024, 1, 1 + (n == 1999)), "已完成", *[None] * 2, *[Decimal(1)] * 5) for n in range(2000)]
    lines = spark.createDataFrame([(f"D{n}", f"O{n % 2000}") for n in range(4000)] + [("D", None)], "order_detail_id string, order_id string")
    raw = {"ods_orders": spark.createDataFrame(days, ORDERS), "ods_order_details": lines}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")  # one order is below it, all orders and lines are not
    try:
        first, then = registry._deliveries(Star(raw), list(raw), TableStore(spark, str(tmp_path)))
        assert "Exchange hashpartitioning" not in first["ods_order_details"]._jdf.queryExecution().executedPlan().toString()
        assert all(frame.inputFiles() for frame in then.values())
        assert {r.order_detail_id for r in then["ods_order_details"].collect()} == {"D1999", "D3999"}
        assert first["ods_order_details"].count() == 3999
        assert (first["ods_orders"].count(), then["ods_orders"].count()) == (1999, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
