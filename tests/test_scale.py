"""Plans that must hold at scale: no quadratic joins, pruned scans, hot keys split, results whole."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F
from test_oracle import SF_DIR, normal

import __spark_entry__ as registry
from oracle.sql import statement
from retailoom.operators import derive
from retailoom.plans.star import DIMENSIONS, FACTS, Star
from retailoom.session import SETTINGS, shuffle_partitions_for
from retailoom.sources.tables import TableStore
from retailoom.sources.tpch import RawTables

# One task sees all rows of these only after they are aggregated: to one row per calendar, per hash
# bucket, per platform, category or user level, per store, or to a single row of totals.
ONE_TASK = {
    "dim_date", "dim_user", "dim_product", "dim_store", "split_paid", "initial_inventory",
    "platform_report", "category_analysis", "user_level_analysis", "store_ranking", "store_leaderboard",
    "product_stats", "inventory_summary", "layer_metrics", "layer_pnl", "consistency_check", "row_counts",
    "csv_consistency", "calendar_coverage",
}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", (*registry.PLANS, *registry.CHECKS))
def test_plan(spark, name):
    plan = plan_of(registry.queries()[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert unwanted not in plan
    assert "SinglePartition" not in plan or name in ONE_TASK


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    stored = TableStore(spark, str(tmp_path))
    facts = registry.star(spark, SF_DIR)["fact_order"].filter("date_key between 19960301 and 19960305")
    stored.replace("fact_order", facts, by_date=True)
    star = Star({}, given={"fact_order": stored.read_dates("fact_order", [19960302])})
    one_day = star.plan("store_daily")
    (scan,) = [line for line in plan_of(one_day).splitlines() if "FileScan parquet" in line]
    read = {column.split("#")[0] for column in re.search(r"FileScan parquet \[(.*?)\]", scan).group(1).split(",")}
    assert read == {"order_id", "user_key", "store_key", "order_status", "final_amount", "total_cost", "profit_amount", "date_key", "month_key"}
    assert re.search(r"PartitionFilters: \[[^\]]*month_key[^\]]*= 199603", scan), scan
    assert re.search(r"PushedFilters: \[.*EqualTo\(date_key,19960302\)", scan), scan
    assert re.search(r"PushedFilters: \[[^\]]*order_status", scan) or "In(order_status" in scan, scan


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Raw tables in which one user, store, SKU, order, day and group of copies each hold a third of the rows."""
    raw = RawTables(spark, SF_DIR)
    store = TableStore(spark, str(tmp_path_factory.mktemp("hot")))
    third = lambda column: F.abs(F.hash(column)) % 3 == 0
    put = lambda column, test, value: F.when(test, F.lit(value)).otherwise(F.col(column))
    frames = {name: raw[name] for name in ("ods_stores", "ods_products", "ods_users")}
    day = F.lit("1996-03-02")
    frames["ods_orders"] = (
        raw["ods_orders"]
        .withColumn("user_id", put("user_id", third("order_id"), "U00000001"))
        .withColumn("store_id", put("store_id", third(F.concat("order_id", F.lit("s"))), "S0001"))
        .withColumn("order_time", F.when(third("order_id"), day.cast("timestamp")).otherwise(F.col("order_time")))
    )
    line = F.concat("order_detail_id", "sku_id")
    frames["ods_order_details"] = (
        raw["ods_order_details"]
        .withColumn("sku_id", put("sku_id", third(line), "SK00000007"))
        .withColumn("order_id", put("order_id", third(F.concat(line, F.lit("o"))), "O00000001"))
    )
    traffic = F.concat("sku_id", "store_id", F.col("clicks").cast("string"))
    for name in ("ods_promotion", "ods_product_traffic"):
        frames[name] = (
            raw[name]
            .withColumn("date", F.when(third(traffic), day.cast("date")).otherwise(F.col("date")))
            .withColumn("sku_id", put("sku_id", third(traffic), "SK00000007"))
            .withColumn("store_id", put("store_id", third(traffic), "S0001"))
        )
    frames["ods_traffic"] = raw["ods_traffic"]
    log = raw["traffic_log"]
    same = third(F.concat(traffic, F.lit("c")))
    sample = log.filter("flow_type = '付费'").orderBy(*log.columns).first()
    frames["traffic_log"] = log.select(*[F.when(same, F.lit(sample[c])).otherwise(F.col(c)).alias(c) for c in log.columns])
    # in several files, as adaptive execution can't split what a single map task wrote
    return {name: store.replace(name, frame.repartition(8)) for name, frame in frames.items()}, store


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, and partitions that count as skewed at a few KB."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "24KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


HOT = (
    "fact_order", "fact_order_detail", "fact_promotion", "sales", "trade_order_1d", "trade_product_1d", "store_total",
    "product_total", "category_total", "user_total", "daily_report", "traffic_report", "traffic_daily",
    "promotion_summary", "sales_summary", "platform_report", "order_line_rollup", "split_paid",
    "sku_store_daily_clicks",
)


@pytest.fixture(scope="module")
def duck(hot):
    frames, store = hot
    connection = duckdb.connect()
    for name in frames:
        connection.execute(f"create view {name} as select * from '{store.path(name)}/*.parquet'")
    return connection


def against_sql(frame, duck, name, given):
    expected = duck.sql(statement(name, frozenset(given)))
    assert normal(frame.columns, frame.collect()) == normal(expected.columns, expected.fetchall())


@pytest.fixture(scope="module")
def hot_star(hot):
    """Facts are stored when first asked for, which is under the settings of ``shuffled``."""
    frames, store = hot
    return Star(frames, lambda name, plan: store.settle(name, plan) if name in (*DIMENSIONS, *FACTS) else plan)


@pytest.mark.parametrize("name", HOT)
def test_hot_keys(spark, hot_star, duck, shuffled, name):
    against_sql(hot_star.plan(name), duck, name, hot_star.raw)


def test_allocation_on_a_hot_day(spark, hot_star, duck, shuffled):
    clicks = hot_star["sku_store_daily_clicks"]
    against_sql(derive.allocate_orders(clicks, registry.ORDERS_PER_DAY), duck, "allocate_orders", hot_star.raw)


def test_adaptive_execution_splits_the_hot_join(spark, hot, shuffled):
    frames, _ = hot
    details = Star(frames).plan("fact_order_detail")
    details.collect()
    assert "skew=true" in plan_of(details)


def test_settings(spark):
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())
    assert shuffle_partitions_for(100 * 2**40, 8000) == 819_200
    assert shuffle_partitions_for(1, 8) == 8
