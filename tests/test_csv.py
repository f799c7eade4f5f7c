import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows_of

from retailoom.schemas import RAW_COLUMNS, REPORT_LABELS, raw_schema
from retailoom.sources import csv_files
from retailoom.sources.tables import TableStore

D = Decimal
USERS = "\ufeff用户ID,用户名,性别,年龄,城市,注册日期,备用\n"


def put(folder, name, text):
    (folder / f"{name}.csv").write_text(text, encoding="utf-8")


def test_users_with_mark_gaps_and_an_extra_column(spark, tmp_path):
    put(
        tmp_path,
        "ods_users",
        USERS + 'U1,"李,四",男,18.0,NaN,2024-01-02,1\nU2,,女,,京,2024-01-02 10:00:00,NULL\n"U3","说""好""",女,7,京,,x\n',
    )
    frame = csv_files.read_raw_csv(spark, str(tmp_path / "ods_users.csv"), "ods_users")
    assert frame.columns == ["user_id", "user_name", "gender", "age", "city", "register_date", "备用"]
    assert [kind for _, kind in frame.dtypes] == ["string", "string", "string", "int", "string", "date", "string"]
    day = dt.date(2024, 1, 2)
    assert rows_of(frame) == [
        ("U1", "李,四", "男", 18, None, day, "1"),
        ("U2", None, "女", None, "京", day, None),
        ("U3", '说"好"', "女", 7, "京", None, "x"),
    ]


def test_english_headers_in_any_order(spark, tmp_path):
    put(tmp_path, "ods_promotion", "cost,promotion_id,date\n1.5,M1,2024-03-05\n")
    frame = csv_files.read_raw_csv(spark, str(tmp_path / "ods_promotion.csv"), "ods_promotion")
    assert frame.dtypes == [("cost", "decimal(10,2)"), ("promotion_id", "string"), ("date", "date")]
    assert frame.first()["cost"] == D("1.50")


@pytest.mark.parametrize(
    "lines",
    ["U1,a,男,18,京,2024-01-02,1,more\n", "U1,a,男\n", 'U1,"a\nb",男,18,京,2024-01-02,1\n'],
    ids=["long", "short", "line break"],
)
def test_lines_that_do_not_fit_fail(spark, tmp_path, lines):
    put(tmp_path, "ods_users", USERS + lines)
    with pytest.raises(Exception, match="does not fit the header"):
        csv_files.read_raw_csv(spark, str(tmp_path / "ods_users.csv"), "ods_users").collect()


def test_line_breaks_in_fields(spark, tmp_path):
    put(tmp_path, "ods_users", USERS + 'U1,"a\nb",男,18,京,2024-01-02,1\n')
    store = TableStore(spark, str(tmp_path / "ods"))
    assert csv_files.load_layer(spark, str(tmp_path), store, multi_line=True) == {"ods_users": None}
    assert store.read("ods_users").first()["user_name"] == "a\nb"


def test_files_with_different_headers_fail(spark, tmp_path):
    folder = tmp_path / "ods_users.csv"
    folder.mkdir()
    (folder / "part-1.csv").write_text("user_id,user_name\nU1,a\n", encoding="utf-8")
    (folder / "part-2.csv").write_text("user_name,user_id\nbob,U2\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.read_raw_csv(spark, str(folder), "ods_users").collect()


def test_append_adds_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "ods"))
    for user in ("U1", "U2"):
        put(tmp_path, "ods_users", USERS + f"{user},a,男,18,京,2024-01-02,1\n")
        assert csv_files.load_layer(spark, str(tmp_path), store, mode="append") == {"ods_users": None}
    assert sorted(r["user_id"] for r in store.read("ods_users").collect()) == ["U1", "U2"]
    with pytest.raises(ValueError):
        csv_files.load_layer(spark, str(tmp_path), store, mode="other")


def test_round_trip_under_raw_headers(spark, tmp_path):
    schema = raw_schema("ods_orders")
    rows = [
        ("O1", "U1", "S1", "甲", dt.datetime(2024, 3, 5, 12, 30), "已完成", D("9.90"), None, D("3.00"), D("9.90"), D("5.00"))
        + ('微信,"x"', None, dt.datetime(2024, 3, 5), None)
    ] * 3
    orders = spark.createDataFrame(rows, schema)
    headers = {name: header for header, name, _ in RAW_COLUMNS["ods_orders"]}
    path = str(tmp_path / "ods_orders.csv")
    csv_files.write_csv(orders.withColumnsRenamed(headers), path)
    parts = list((tmp_path / "ods_orders.csv").glob("part-*.csv"))
    assert parts and all(part.read_bytes().startswith(b"\xef\xbb\xbf") for part in parts)
    back = csv_files.read_raw_csv(spark, path, "ods_orders")
    assert back.columns == orders.columns
    assert rows_of(back) == rows_of(orders)


def test_load_layer_reports_what_failed(spark, tmp_path):
    source, store = tmp_path / "csv", TableStore(spark, str(tmp_path / "ods"))
    source.mkdir()
    put(source, "ods_users", USERS + "U1,a,男,18,京,2024-01-02,1\n")
    put(source, "ods_stores", "店铺ID,店铺名称\n")
    put(source, "ods_order_details", "订单ID,数量\nO1,many\n")
    (source / "notes.txt").write_text("x")
    outcome = csv_files.load_layer(spark, str(source), store)
    assert outcome["ods_users"] is None and outcome["ods_stores"] == "no rows"
    assert "CAST_INVALID_INPUT" in outcome["ods_order_details"]
    assert set(outcome) == {"ods_users", "ods_stores", "ods_order_details"}
    assert store.read("ods_users").count() == 1
    assert store.find("ods_stores") is None
    put(source, "ods_users", USERS + "U2,a,男,18,京,2024-01-02,1\n")  # a second load replaces
    csv_files.load_layer(spark, str(source), store)
    assert [r["user_id"] for r in store.read("ods_users").collect()] == ["U2"]


def test_load_frames(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "ods"))
    frame = spark.createDataFrame([("S1", float("nan")), ("NaN", 2.0)], "`店铺ID` string, weight double")
    csv_files.load_frames({"ods_stores": frame}, store)
    assert rows_of(store.read("ods_stores")) == [("NaN", 2.0), ("S1", None)]  # text in memory is meant as it is


def test_preview(spark, tmp_path):
    for name in ("d", "a", "c", "b"):
        put(tmp_path, name, "x,y\n" + "".join(f"{n},{n}\n" for n in range(25)))
    shown = csv_files.preview(spark, str(tmp_path))
    assert list(shown) == ["a", "b", "c"]
    assert all(frame.count() == 10 for frame in shown.values())


def test_has_rows(spark):
    assert csv_files.has_rows(spark.range(1))
    assert not csv_files.has_rows(spark.range(0))
    assert not csv_files.has_rows(None)


@pytest.mark.parametrize("table", list(RAW_COLUMNS))
def test_schemas_are_valid(table):
    assert len(raw_schema(table)) == len(RAW_COLUMNS[table]) == len({c[0] for c in RAW_COLUMNS[table]})


def test_labels_are_distinct():
    assert all(len(set(labels.values())) == len(labels) for labels in REPORT_LABELS.values())
