"""Full and partial refreshes of the stored warehouse, from CSV files to reports."""

import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from retailoom.operators.quality import all_consistent
from retailoom.plans.star import FACTS
from retailoom.plans.warehouse import DATED, Warehouse
from retailoom.schemas import RAW_COLUMNS, REPORT_LABELS
from retailoom.sources import csv_files
from retailoom.sources.tables import TableStore
from retailoom.sources.tpch import RawTables

FIRST, LAST = dt.datetime(1996, 3, 1), dt.datetime(1996, 3, 6)
# of each kind: facts, daily tables, totals and reports
COMPARED = (
    *FACTS, "trade_order_1d", "traffic_daily", "promotion_summary", "user_total", "daily_report", "platform_summary",
    "traffic_report",
)


def some_days(spark):
    """The raw tables of a few days, where each line amount is part of its order's amount."""
    raw = RawTables(spark, "/root/testdata/sf0.01")
    orders = raw["ods_orders"].filter((F.col("order_time") >= FIRST) & (F.col("order_time") < LAST))
    details = raw["ods_order_details"].join(orders.select("order_id"), "order_id", "left_semi")
    sold = details.groupBy("order_id").agg(F.sum("amount").cast("decimal(12,2)").alias("sold"))
    done = F.col("order_status").isin("已完成", "已发货")
    orders = (
        orders.join(sold, "order_id", "left")
        .withColumn("final_amount", F.when(done, F.coalesce("sold", F.lit(0))).otherwise(0).cast("decimal(12,2)"))
        .drop("sold")
    )
    frames = {name: raw[name] for name in ("ods_stores", "ods_products", "ods_users")}
    frames |= {"ods_orders": orders, "ods_order_details": details}
    for name in ("ods_promotion", "ods_traffic", "ods_product_traffic", "ods_inventory"):
        frames[name] = raw[name].filter((F.col("date") >= FIRST) & (F.col("date") < LAST))
    # the stores take their traffic from the log, so any day has some
    return frames


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """The raw tables as CSV files with their own headers."""
    folder = tmp_path_factory.mktemp("csv")
    for name, frame in some_days(spark).items():
        headers = {column: header for header, column, _ in RAW_COLUMNS[name]}
        csv_files.write_csv(frame.withColumnsRenamed(headers), f"{folder}/{name}.csv")
    return str(folder)


@pytest.fixture(scope="module")
def loaded(spark, files, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("ods")))
    outcome = csv_files.load_layer(spark, files, store)
    assert set(outcome) == set(RAW_COLUMNS) and not any(outcome.values())
    return store


def raw_from(store, **changed):
    return {name: changed.get(name, store.read(name)) for name in RAW_COLUMNS}


def content(warehouse, name):
    frame = warehouse.store.read(name)
    return rows_of(frame.select(sorted(frame.columns)))


@pytest.fixture(scope="module")
def full(spark, loaded, tmp_path_factory):
    warehouse = Warehouse.over_store(spark, loaded, str(tmp_path_factory.mktemp("full")))
    warehouse.refresh()
    return warehouse


def test_layers_agree_from_files_to_reports(spark, files, full):
    read = {name: csv_files.read_raw_csv(spark, f"{files}/{name}.csv", name) for name in ("ods_orders", "ods_promotion")}
    check = full.check(read)
    assert check.count() == 3 + 4 + 4 + 3
    assert all_consistent(check), check.collect()
    assert all(frame.isEmpty() for frame in full.duplicates().values())


def test_check_turns_red(spark, full, tmp_path):
    promotion = full.store.read("promotion_daily")
    kept = full.store.root
    broken = Warehouse(spark, full.raw, kept)
    copies = TableStore(spark, str(tmp_path))
    read = broken.store.read
    broken.store.read = lambda name: (
        copies.replace(name, promotion.filter("channel != '渠道1'")) if name == "promotion_daily" else read(name)
    )
    failed = {(r["pair"], r["metric"]) for r in broken.check().collect() if not r["ok"]}
    assert failed == {("DWD-DWS", "promo"), ("DWS-ADS", "promo")}


def test_a_report_is_handed_out_under_its_labels(spark, full, tmp_path):
    full.export_report("store_ranking", str(tmp_path / "out"))
    out = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert [c.removeprefix("\ufeff") for c in out.columns] == list(REPORT_LABELS["store_ranking"].values())
    assert out.count() == full.store.read("store_ranking").count()


def test_sums_agree(full):
    def one(name, expression, where="true"):
        return full.store.read(name).filter(where).agg(F.expr(expression)).first()[0]

    assert one("daily_report", "sum(promo_cost)") == one("fact_promotion", "sum(cost)")
    done = "order_status in ('已完成', '已发货')"
    assert one("daily_report", "sum(sales_amount)") == one("fact_order_detail", "sum(amount)", done)
    assert one("store_daily", "sum(sales_amount)") == one("store_total", "sum(sales_amount)")
    assert one("traffic_report", "sum(cost)") == one("fact_promotion", "sum(cost)", "product_key is not null")


def test_refreshed_dates_equal_a_full_refresh(spark, loaded, full, tmp_path):
    """Changed orders, a day that loses all its rows and new users: the dates are as if built anew."""
    changed, emptied = 19960302, 19960304
    orders = loaded.read("ods_orders")
    day = F.date_format("order_time", "yyyyMMdd").cast("int")
    new_orders = orders.filter(day != emptied).withColumn(
        "order_status", F.when((day == changed) & (F.col("order_status") == "已发货"), "已取消").otherwise(F.col("order_status"))
    )
    on_day = F.date_format("date", "yyyyMMdd").cast("int")
    without = {
        name: loaded.read(name).filter(on_day != emptied)
        for name in ("ods_promotion", "ods_traffic", "ods_product_traffic", "ods_inventory")
    }
    after = raw_from(loaded, ods_orders=new_orders, **without)

    partial = Warehouse(spark, full.raw, str(tmp_path / "partial"))
    partial.refresh(COMPARED)
    for name in ("trade_order_1d", "daily_report"):
        assert content(partial, name) == content(full, name)
    before = content(partial, "daily_report")
    partial.raw = after
    partial.refresh_dates([changed, emptied], COMPARED)

    anew = Warehouse(spark, after, str(tmp_path / "anew"))
    anew.refresh(COMPARED)
    for name in COMPARED:
        assert content(partial, name) == content(anew, name), name
    assert content(partial, "daily_report") != before
    assert partial.store.read("fact_order").filter(F.col("date_key") == emptied).isEmpty()


def test_new_users_do_not_disturb_old_keys(spark, loaded, full, tmp_path):
    users = loaded.read("ods_users")
    some = users.filter("hash(user_id) % 3 != 0")
    warehouse = Warehouse(spark, raw_from(loaded, ods_users=some), str(tmp_path / "keys"))
    warehouse.refresh(["daily_report"])
    old = dict(warehouse.store.read("dim_user").select("user_id", "user_key").collect())
    warehouse.raw = raw_from(loaded)
    days = [row[0] for row in full.store.read("fact_order").select("date_key").distinct().collect()]
    warehouse.refresh_dates(days, ["fact_order", "daily_report"])
    new = dict(warehouse.store.read("dim_user").select("user_id", "user_key").collect())
    assert all(new[user] == key for user, key in old.items())
    assert sorted(new.values()) == list(range(1, users.count() + 1))
    plain = [c for c in full.store.read("fact_order").columns if c != "user_key"]
    for name, columns in (("fact_order", plain), ("daily_report", REPORT_LABELS["daily_report"])):
        columns = list(columns)
        assert rows_of(warehouse.store.read(name).select(columns)) == rows_of(full.store.read(name).select(columns))


def test_tables_by_date(full):
    for name in DATED:
        assert "date_key" in full.store.read(name).columns
