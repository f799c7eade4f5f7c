from conftest import rows_of

from retailoom.session import shared_folder
from retailoom.sources.tables import TableStore


def dated(spark, *rows):
    return spark.createDataFrame(rows, "v string, date_key int")


def test_a_table_without_rows_keeps_its_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    empty = dated(spark, ("a", 20240101)).limit(0)
    for by_date in (False, True):
        assert store.replace(f"t{by_date}", empty, by_date).columns == ["v", "date_key"]
    store.replace("tTrue", dated(spark, ("a", 20240101)), by_date=True)
    assert store.replace("tTrue", empty, by_date=True).count() == 0


def test_replacing_twice_leaves_the_last(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("t", dated(spark, ("a", 20240101), ("b", 20240102)), by_date=True)
    assert rows_of(store.replace("t", dated(spark, ("c", 20240103)), by_date=True)) == [("c", 20240103)]


def test_dated_tables_lie_by_month_in_order_of_days(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = dated(spark, *[(f"r{n}", 20240101 + n % 28 + 100 * (n % 3)) for n in range(300)], ("none", None))
    assert rows_of(store.replace("t", rows.repartition(7), by_date=True)) == rows_of(rows)
    assert {p.name for p in (tmp_path / "t").glob("month_key=*")} == {"month_key=202401", "month_key=202402", "month_key=202403", "month_key=__HIVE_DEFAULT_PARTITION__"}
    for part in (tmp_path / "t").glob("month_key=2024*/*.parquet"):
        days = [r.date_key for r in spark.read.parquet(str(part)).collect()]
        assert days == sorted(days)
    assert {r.date_key for r in store.read_dates("t", [20240103, 20240205]).collect()} == {20240103, 20240205}


def test_find(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert store.find("t") is None
    store.replace("t", dated(spark, ("a", 20240101)))
    assert store.find("t").count() == 1


def test_scratch_folder_is_the_one_named(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
