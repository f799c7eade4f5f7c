import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailoom.functions import columns as C
from retailoom.operators.dims import dim_date


def week_by_counting(day):
    """Weeks start on Monday; week 1 is the first with four days in the year; days before it are week 0."""
    first = dt.date(day.year, 1, 1)
    monday = first - dt.timedelta(days=first.weekday())
    if first.weekday() > 3:
        monday += dt.timedelta(days=7)
    return (day - monday).days // 7 + 1


def test_week_on_every_day(spark):
    days = [dt.date(1995, 1, 1) + dt.timedelta(days=n) for n in range(366 * 30)]
    found = spark.createDataFrame([(d,) for d in days], "d date").select("d", C.week_from_monday(F.col("d"))).collect()
    assert [(d, w) for d, w in found if w != week_by_counting(d)] == []


def test_calendar(spark):
    calendar = dim_date(spark, end=dt.date(2021, 1, 3), days=4).orderBy("date_key").collect()
    assert [row["date_key"] for row in calendar] == [20201231, 20210101, 20210102, 20210103]
    assert [row["year_week"] for row in calendar] == ["2020-W53", "2021-W00", "2021-W00", "2021-W00"]
    assert [row["weekday_name"] for row in calendar] == ["周四", "周五", "周六", "周日"]
    assert [row["is_weekend"] for row in calendar] == [0, 0, 1, 1]
    assert [row["quarter"] for row in calendar] == [4, 1, 1, 1]
    assert dim_date(spark, end=dt.date(2024, 12, 31)).count() == 1096


@pytest.mark.parametrize(
    "numerator, denominator, ratio, quotient, percent",
    [
        ("5.35", "2", "2.68", "2.68", "267.50"),  # a tie rounds away from zero
        ("-5.35", "2", "-2.68", "-2.68", "-267.50"),
        ("1", "0", "0.00", None, "0.00"),
        ("1", "-4", "0.00", "-0.25", "0.00"),
        ("1", None, "0.00", None, "0.00"),
        (None, "1", None, None, None),
        ("-100000000", "0.01", "-10000000000.00", "-10000000000.00", "-1000000000000.00"),
        ("2", "3", "0.67", "0.67", "66.67"),
    ],
)
def test_ratios(spark, numerator, denominator, ratio, quotient, percent):
    row = [tuple(None if v is None else Decimal(v) for v in (numerator, denominator))]
    n, d = F.col("n"), F.col("d")
    found = (
        spark.createDataFrame(row, "n decimal(12,2), d decimal(12,2)")
        .select(C.ratio(n, d), C.quotient(n, d), C.percent(n, d))
        .first()
    )
    assert tuple(found) == tuple(None if v is None else Decimal(v) for v in (ratio, quotient, percent))


def test_groups(spark):
    ages = spark.createDataFrame([(a,) for a in (None, 0, 17, 18, 25, 26, 35, 36, 45, 46, 55, 56)], "a int")
    groups = [row[0] for row in ages.select(C.age_group(F.col("a"))).collect()]
    assert groups == (
        ["55岁以上", "未成年", "未成年", "18-25岁", "18-25岁", "26-35岁", "26-35岁", "36-45岁", "36-45岁"]
        + ["46-55岁", "46-55岁", "55岁以上"]
    )
    names = spark.createDataFrame([("直营店和旗舰店",), ("一号专卖店",), ("直营店",), ("小店",), (None,)], "n string")
    types = [row[0] for row in names.select(C.store_type(F.col("n"))).collect()]
    assert types == ["旗舰店", "专卖店", "直营店", "普通店", "普通店"]
    spent = spark.createDataFrame([(Decimal(v),) for v in ("9999.99", "10000", "5000", "4999.99")], "s decimal(18,2)")
    assert [row[0] for row in spent.select(C.user_level(F.col("s"))).collect()] == ["中价值", "高价值", "中价值", "低价值"]
    categories = spark.createDataFrame([("整车-品牌",), ("骑行装备",), (None,)], "c string")
    assert [row[0] for row in categories.select(C.unit_freight(F.col("c"))).collect()] == [30, 3, 3]


def test_keys(spark):
    day = spark.createDataFrame([(dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 23, 59, 59))], "d date, t timestamp")
    key = day.select(C.date_key(F.col("d")).alias("a"), C.date_key(F.col("t")).alias("b"))
    assert tuple(key.first()) == (20240229, 20240229)
    assert key.select(C.month_of_key(F.col("a"))).first()[0] == "2024-02"
