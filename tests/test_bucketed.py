"""Tables in buckets: the same join without a shuffle, hot keys apart."""

import pytest
from conftest import rows_of

from retailoom.operators import facts
from retailoom.sources.bucketed import BucketStore, pairs

ORDER = "order_id string, store_id string, user_key bigint, store_key bigint, date_key int, order_status string, platform string, traffic_source string"
LINE = "order_detail_id string, order_id string, product_id string, sku_id string, quantity int, price decimal(10,2), amount decimal(12,2)"


@pytest.fixture
def tables(spark):
    orders = spark.range(300).selectExpr(
        "concat('O', id) order_id", "'S1' store_id", "id user_key", "1L store_key", "20240301 date_key",
        "'已完成' order_status", "'京东' platform", "'自然' traffic_source",
    )
    # a third of the lines belong to one order, some to none that is there, some to no order at all
    lines = spark.range(3000).selectExpr(
        "concat('D', id) order_detail_id",
        "case when id % 3 = 0 then 'O7' when id % 50 = 1 then null else concat('O', id % 320) end order_id",
        "'P1' product_id", "concat('SK', id % 5) sku_id", "cast(id % 4 as int) quantity",
        "cast(2 as decimal(10,2)) price", "cast(id as decimal(12,2)) amount",
    )
    products = spark.createDataFrame([("SK1", 1, 1)], "sku_id string, product_key bigint, cost int")
    return orders, lines, products.selectExpr("sku_id", "product_key", "cast(cost as decimal(10,2)) cost")


def test_join_without_a_shuffle(spark, tables, tmp_path):
    orders, lines, products = tables
    store = BucketStore(spark, str(tmp_path), "order_id", 8)
    left, right = store.write("lines", lines, least_hot=100), store.write("orders", orders, least_hot=100)
    assert rows_of(left.hot) == [("O7",)] and right.hot.isEmpty()
    assert rows_of(left.everything()) == rows_of(lines)
    assert left.rows.filter("order_id = 'O7' or order_id is null").isEmpty()

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        join = left.rows.join(right.rows, "order_id").groupBy("order_id").count()
        plan = join._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        parts = pairs(left, right)
        assert len(parts) == 2
        found = [row for pair in parts for row in facts.fact_order_detail(*pair, products).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    expected = facts.fact_order_detail(lines, orders, products)
    assert sorted(map(tuple, found), key=repr) == rows_of(expected)


def test_hot_on_the_other_side(spark, tables, tmp_path):
    orders, lines, _ = tables
    store = BucketStore(spark, str(tmp_path), "order_id", 4)
    left, right = store.write("orders", orders, least_hot=100), store.write("lines", lines, least_hot=100)
    found = [tuple(row) for a, b in pairs(left, right) for row in a.join(b, "order_id").select("order_id", "order_detail_id").collect()]
    assert sorted(found) == rows_of(orders.join(lines, "order_id").select("order_id", "order_detail_id"))


def test_another_session_reads_the_buckets(spark, tables, tmp_path):
    orders, lines, _ = tables
    store = BucketStore(spark, str(tmp_path), "order_id", 4)
    written = store.write("lines", lines)
    assert written.hot.isEmpty()
    spark.sql(f"drop table {store._table('lines')}")  # as a new session finds it: files, but no table
    again = store.read("lines")
    assert rows_of(again.everything()) == rows_of(lines)
    plan = again.rows.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_no_rows(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path), "order_id", 4)
    orders = store.write("orders", spark.createDataFrame([], ORDER))
    lines = store.write("lines", spark.createDataFrame([], LINE))
    assert lines.everything().isEmpty()
    assert [a.join(b, "order_id").count() for a, b in pairs(lines, orders)] == [0]
