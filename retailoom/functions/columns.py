"""Column expressions shared by the operators. All of them stay inside whole-stage codegen."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from retailoom import config

MONEY = "decimal(18,2)"
RATE = "decimal(18,2)"

# wide enough for 18 integer digits and for amounts already multiplied by a two-digit fee
_EXACT = "decimal(22,4)"


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def total(column: str) -> Column:
    """Sum of a money column."""
    return money(F.sum(column))


def units(column: str) -> Column:
    """Sum of a count column."""
    return F.sum(column).cast("bigint")


def quotient(numerator: Column, denominator: Column) -> Column:
    """Exact quotient rounded half up to two digits; NULL when the denominator is 0."""
    return F.round(numerator.cast(_EXACT) / F.nullif(denominator.cast(_EXACT), F.lit(0)), 2).cast(RATE)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``quotient``, with 0 unless the denominator is positive."""
    return F.when(denominator > 0, quotient(numerator, denominator)).otherwise(F.lit(0).cast(RATE))


def percent(numerator: Column, denominator: Column) -> Column:
    """``ratio`` in per cent."""
    return ratio(numerator.cast(_EXACT) * 100, denominator)


def average(amount: Column) -> Column:
    """Mean of a money column inside an aggregation; NULL over no rows."""
    return quotient(F.sum(amount), F.count(amount))


def date_key(day: Column) -> Column:
    """A date or timestamp as the int ``yyyyMMdd``."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_key(key: Column) -> Column:
    """The date of a date key."""
    return F.make_date((key / 10000).cast("int"), (key / 100).cast("int") % 100, key % 100)


def month_of_key(key: Column) -> Column:
    """``yyyy-MM`` of a date key."""
    month = (key / 100).cast("int")
    return F.format_string("%04d-%02d", (month / 100).cast("int"), month % 100)


def week_from_monday(day: Column) -> Column:
    """Week 0..53 of the calendar year: weeks start on Monday, week 1 is the first with four days in the year.

    ISO weeks that reach over New Year are cut at the year: what ISO counts into the year before is
    week 0, what it counts into the year after is week 53.
    """
    iso, month = F.weekofyear(day), F.month(day)
    return F.when((month == 1) & (iso >= 52), 0).when((month == 12) & (iso == 1), 53).otherwise(iso)


def is_completed(status: Column | None = None) -> Column:
    return (F.col("order_status") if status is None else status).isin(*config.COMPLETED)


def age_group(age: Column) -> Column:
    group = F
    for upper, label in config.AGE_BANDS:
        group = group.when(age < upper, label)
    return group.otherwise(config.AGE_REST)


def store_type(name: Column) -> Column:
    kind = F
    for label in config.STORE_TYPES:
        kind = kind.when(name.contains(label), label)
    return kind.otherwise(config.STORE_TYPE_REST)


def user_level(spent: Column) -> Column:
    level = F
    for least, label in config.USER_LEVELS:
        level = level.when(spent >= least, label)
    return level.otherwise(config.USER_LEVEL_REST)


def unit_freight(category: Column) -> Column:
    bulky = category.startswith(config.BULKY_CATEGORY_PREFIX)
    return F.when(bulky, config.FREIGHT_BULKY).otherwise(config.FREIGHT_OTHER)


def conversion_rate(tier: Column) -> Column:
    """Middle of the conversion-rate range of a tier, in 1/10000."""
    rate = F
    for label, (low, high) in config.TIER_CONVERSION.items():
        rate = rate.when(tier == label, (low + high) // 2)
    return rate.otherwise(sum(config.TIER_CONVERSION_REST) // 2)


def any_null(columns: Sequence[str]) -> Column:
    test = F.lit(False)
    for name in columns:
        test = test | F.col(name).isNull()
    return test
