"""Mixed headers and unsound lines."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows_of

from retailoom.sources.tables import TableStore
from retailoom.sources.tolerant_csv import headers, judged_rows, load_tolerant, rejects_by_file


def write(folder, table, **files):
    (folder / f"{table}.csv").mkdir(parents=True)
    for name, text in files.items():
        (folder / f"{table}.csv" / f"{name}.csv").write_text(text, encoding="utf-8")


GOOD = "﻿店铺ID,店铺名称,平台,开店日期\nS1,\"One, Ltd\",A,2024-01-01\nS2,Two,B,2024-01-02 10:00:00\n"


def test_files_are_read_by_their_own_header(spark, tmp_path):
    write(tmp_path, "ods_stores", a=GOOD, b="开店日期,店铺ID,extra,platform\n2024-02-01,S3,more,C\n", c="")
    assert len(headers(spark, str(tmp_path / "ods_stores.csv"))) == 2
    store = TableStore(spark, str(tmp_path / "out"))
    assert load_tolerant(spark, str(tmp_path), store) == {"ods_stores": (3, 0)}
    rows = store.read("ods_stores").select("store_id", "store_name", "platform", "open_date", "extra")
    day = dt.date
    assert rows_of(rows) == [("S1", "One, Ltd", "A", day(2024, 1, 1), None), ("S2", "Two", "B", day(2024, 1, 2), None), ("S3", None, "C", day(2024, 2, 1), "more")]
    assert store.read("rejects").isEmpty()


def test_bad_lines_are_kept_apart(spark, tmp_path):
    lines = "".join(f"K{n},P,{n}.5,{n}.0\n" for n in range(300))
    bad = "K900,P,cheap,1\nK901,P\nK902,P,1,2,3\nK903,P,1,1.7e400\nK904,P,,\n"
    write(tmp_path, "ods_products", a="SKU_ID,商品ID,售价,库存\n" + lines, b="SKU_ID,商品ID,售价,库存\n" + bad)
    store = TableStore(spark, str(tmp_path / "out"))
    assert load_tolerant(spark, str(tmp_path), store, most=0.02) == {"ods_products": (301, 4)}
    rows = {r.sku_id: (r.price, r.stock) for r in store.read("ods_products").collect()}
    assert rows["K7"] == (Decimal("7.50"), 7) and rows["K904"] == (None, None) and "K900" not in rows
    found = {r.line.split(",")[0]: (r.file.rsplit("/", 1)[1], r.reason) for r in store.read("rejects").collect()}
    assert found["K900"] == ("b.csv", "price is no decimal(10,2): cheap")
    assert found["K901"][1] == found["K902"][1] == "the line does not fit the header"
    assert found["K903"][1].startswith("stock is no int") and len(found) == 4
    assert {(r.reason, r.lines) for r in rejects_by_file(store).collect()} == {("price is no decimal(10,2)", 1), ("the line does not fit the header", 2), ("stock is no int", 1)}


def test_too_many_bad_lines_leave_the_table_alone(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "out"))
    write(tmp_path / "one", "ods_stores", a=GOOD)
    load_tolerant(spark, str(tmp_path / "one"), store)
    write(tmp_path / "two", "ods_stores", a="店铺ID,开店日期\nS8,2024-01-01\nS9,some day\n")
    outcome = load_tolerant(spark, str(tmp_path / "two"), store, most=0.1)
    assert outcome == {"ods_stores": "TooManyRejects: 1 of 2 lines"}
    assert {r.store_id for r in store.read("ods_stores").collect()} == {"S1", "S2"}
    assert store.read("rejects").count() == 1


def test_nothing_to_read(spark, tmp_path):
    write(tmp_path, "ods_stores", a="", b="店铺ID\n")
    write(tmp_path, "ods_users", a="")
    assert load_tolerant(spark, str(tmp_path), TableStore(spark, str(tmp_path / "out"))) == {"ods_stores": "no rows"}
    with pytest.raises(ValueError, match="no file with a header"):
        judged_rows(spark, str(tmp_path / "ods_users.csv"), "ods_users")


def test_columns_given_twice(spark, tmp_path):
    write(tmp_path, "ods_stores", a="店铺ID,store_id\nS1,S1\n")
    with pytest.raises(ValueError, match="store_id"):
        judged_rows(spark, str(tmp_path / "ods_stores.csv"), "ods_stores")
