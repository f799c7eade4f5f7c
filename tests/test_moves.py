"""Reports over facts that are too large to move often: how often rows are moved and stored, and what comes out."""

import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

import __spark_entry__ as registry
from retailoom.operators import reports
from retailoom.plans.star import FACTS, Star
from retailoom.plans.warehouse import Warehouse

DAY = 20240102
PRODUCTS = (
    "sku_id string, product_id string, store_id string, product_code string, product_name string, spec string, category_l1 string, "
    "category_l2 string, product_tier string, price decimal(10,2), cost decimal(10,2), stock int, platform string"
)
LINES = "order_detail_id string, order_id string, sku_id string, product_id string, quantity int, price decimal(10,2), amount decimal(12,2)"
ORDERS = (
    "order_id string, user_id string, store_id string, platform string, order_time timestamp, order_status string, payment_method string, "
    "traffic_source string, total_amount decimal(12,2), discount_amount decimal(12,2), shipping_fee decimal(12,2), "
    "final_amount decimal(12,2), total_cost decimal(12,2)"
)
PROMOTION = (
    "promotion_id string, date date, store_id string, platform string, sku_id string, product_id string, channel string, "
    "cost decimal(10,2), impressions int, clicks int"
)
NATURAL = (
    "date date, store_id string, platform string, sku_id string, product_id string, channel string, impressions int, clicks int, "
    "favorites int, add_to_cart int"
)


@pytest.fixture
def raw(spark):
    """Two stores of one name, two SKUs of one SPU, an unknown SKU, and days and channels of each."""
    day = lambda n: dt.date(2024, 1, 1 + n % 3)
    store, sku = lambda n: f"S{n % 3}", lambda n: f"K{n % 5}"
    status, source = ("已完成", "已发货", "已取消"), ("付费推广", "搜索", None, "付费推广")
    ten = D("10.00")
    frames = {
        "ods_stores": ([(f"S{n}", f"店{n // 2}", "P", day(0)) for n in range(3)], "store_id string, store_name string, platform string, open_date date"),
        "ods_users": ([(f"U{n}", "a", "男", 30, "X", day(0)) for n in range(4)], "user_id string, user_name string, gender string, age int, city string, register_date date"),
        "ods_products": ([(f"K{n}", f"P{n // 2}", "S0", "c", f"n{n}", "s", "整车-品牌" if n < 2 else None, f"C{n // 2}", "t", ten, D("6.00"), 1, "P") for n in range(4)], PRODUCTS),
        "ods_orders": (
            [(f"O{n}", f"U{n % 4}", store(n), f"P{n % 2}", dt.datetime(2024, 1, 1 + n % 3), status[n % 3 if n % 5 else 0], "微信", source[n % 4], ten, None, None, ten, D(6)) for n in range(40)],
            ORDERS,
        ),
        "ods_order_details": ([(f"D{n}", f"O{n % 41}", sku(n), None, n % 4, ten, D(n)) for n in range(160)], LINES),
        "ods_promotion": ([(f"M{n}", day(n), store(n // 3), f"P{n % 2}", sku(n), None, f"c{n % 2}", D("1.25"), n, n % 3) for n in range(60)], PROMOTION),
        "ods_product_traffic": ([(day(n), store(n // 3), f"P{n % 2}", sku(n), None, f"c{n % 2}", n, n % 3, 1, 2) for n in range(60)], NATURAL),
    }
    return {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in frames.items()}


@pytest.fixture
def moves(spark):
    """The exchanges in the plan of a frame if products are too many to be sent to all tasks; stores are few."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    yield lambda frame: [line for line in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def stored(spark, raw, tmp_path):
    """The tables that the reports are made from, as files."""
    star = Star(raw)
    found = {}
    for name in ("sales", "fact_promotion", "ods_product_traffic", "dim_store", "dim_product"):
        star[name].write.parquet(str(tmp_path / name))
        found[name] = spark.read.parquet(str(tmp_path / name))
    return found


def test_rows_of_the_daily_report_move_once(stored, moves):
    report = reports.daily_report(stored["sales"], stored["fact_promotion"], F.broadcast(stored["dim_store"]), stored["dim_product"])
    assert len(moves(report)) == 3  # the rows, and the products twice: their keys, their names


def test_rows_of_the_traffic_report_move_twice(stored, moves):
    s = stored | {"dim_store": F.broadcast(stored["dim_store"])}
    report = reports.traffic_report(
        reports.paid_traffic_by_channel(s["fact_promotion"], s["dim_store"], s["dim_product"]),
        reports.natural_traffic_by_channel(s["ods_product_traffic"], s["dim_store"], s["dim_product"]),
        reports.spu_sales(s["sales"], s["dim_store"], s["dim_product"]),
    )
    found = moves(report)
    reused = [line for line in found if "ReusedExchange" in line]
    # to their products and to their SPU, store and day, for each of three kinds of rows; and the products to each kind
    assert len(found) - len(reused) == 9
    assert len(reused) == 1  # sales are worked out once for both kinds of traffic


def test_traffic_report_by_brute_force(raw):
    """Sums per name of store and SPU, worked out row by row."""
    names = {r.store_id: r.store_name for r in raw["ods_stores"].collect()}
    spus = {r.sku_id: (r.product_id, r.category_l1, r.category_l2) for r in raw["ods_products"].collect()}
    orders = {r.order_id: r for r in raw["ods_orders"].collect()}
    sold, seen = {}, {}
    for line in raw["ods_order_details"].collect():
        order = orders.get(line.order_id)
        if order and line.sku_id in spus and order.traffic_source and order.order_status in ("已完成", "已发货"):
            flow = "付费" if order.traffic_source == "付费推广" else "自然"
            key = order.order_time.date(), order.platform, names[order.store_id], spus[line.sku_id][0], flow
            quantity, amount = sold.get(key, (0, 0))
            sold[key] = quantity + line.quantity, amount + line.amount
    for name, flow in (("ods_promotion", "付费"), ("ods_product_traffic", "自然")):
        for r in (r.asDict() for r in raw[name].collect()):
            if r["sku_id"] in spus:
                key = r["date"], r["platform"], names[r["store_id"]], *spus[r["sku_id"]], flow
                sums = seen.setdefault(key, [0, 0, 0, 0, D(0)])
                for i, c in enumerate(("impressions", "clicks", "favorites", "add_to_cart", "cost")):
                    sums[i] += r.get(c, 0)
    keys = ["date", "platform", "store_name", "product_id", "category_l1", "category_l2", "flow_type"]
    expected = {k: (*v, *sold.get((*k[:4], k[6]), (0, 0))) for k, v in seen.items()}
    measures = ["impressions", "clicks", "favorites", "add_to_cart", "cost", "sales_quantity", "sales_amount"]
    found = Star(raw).plan("traffic_report").select(*keys, *measures).collect()
    assert len(found) == len(expected) and any(v[-2] for v in expected.values()) and not all(v[-2] for v in expected.values())
    assert {tuple(r[: len(keys)]): tuple(r[len(keys) :]) for r in found} == expected


def test_a_refresh_of_one_table_stores_no_facts_of_one_use(spark, raw, tmp_path):
    one, all_facts = Warehouse(spark, raw, str(tmp_path / "one")), Warehouse(spark, raw, str(tmp_path / "all"))
    one.refresh(["daily_report"])
    all_facts.refresh(["daily_report", "product_total"])
    for name in ("sales", "fact_order_detail", "fact_promotion"):
        assert not one.store.folders(name) and all_facts.store.folders(name)
    assert one.store.folders("fact_order")
    later = raw | {"ods_promotion": raw["ods_promotion"].withColumn("cost", F.when(F.col("date") == "2024-01-02", D("7.50")).otherwise(F.col("cost")))}
    for warehouse in (one, all_facts):
        before = rows_of(warehouse.store.read("daily_report"))
        warehouse.raw = later
        warehouse.refresh_dates([DAY], ["daily_report"])
        after = rows_of(warehouse.store.read("daily_report").drop("date_key"))
        assert after == rows_of(Star(later).plan("daily_report")) and len(after) == len(before) and after != before
    files = [f for f in one.store.read("daily_report").inputFiles() if "_version=2" not in f]
    assert all("month_key=202401" in f for f in files)


def test_the_traffic_report_stores_no_facts(spark, monkeypatch):
    registry.forget()
    written = []
    replace = registry.TableStore.replace
    monkeypatch.setattr(registry.TableStore, "replace", lambda self, name, *a, **k: written.append(name) or replace(self, name, *a, **k))
    found = registry.queries()["traffic_report"](spark, "/root/testdata/sf0.001")
    assert {*written} == {"ods_orders", "dim_user", "dim_store", "dim_product"} and not {*written} & {*FACTS}
    star = registry.star(spark, "/root/testdata/sf0.001")
    assert rows_of(found) == rows_of(star.plan("traffic_report"))
    assert {"sales", "fact_order", "fact_promotion"} <= {*written}  # others still store them
