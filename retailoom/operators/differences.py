"""Where two layers differ: rows are named although their sums may agree.

Both sides are reduced to checksums that don't depend on the order of rows, per day and hash bucket of the key; days are
told from them by adding up. Only rows of buckets whose checksums differ are compared one by one, so layers that agree
cost one aggregation, and a wrong row costs the comparison of its bucket.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
_CHECK = ("rows", "checksum")


def _content(names: Sequence[str]) -> Column:
    # a hash skips NULLs, so each value goes with whether there is one
    return F.xxhash64(*[part for name in names for part in (F.col(name), F.col(name).isNull())])


def checksums(rows: DataFrame, by: str, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(by, bucket, rows, checksum) of all rows; the same for the same rows in any order."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")
    return rows.groupBy(by, bucket).agg(
        F.count("*").alias("rows"), F.sum(_content([*key, *columns]).cast("decimal(38,0)")).alias("checksum")
    )


def _matched(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    same = F.lit(True)
    for name in names:
        same = same & left[name].eqNullSafe(right[name])
    return left.join(right, same, how)


def differing_places(left: DataFrame, right: DataFrame, by: str, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(by, bucket) whose rows are not the same on both sides."""
    one = checksums(left, by, key, columns, buckets)
    other = checksums(right, by, key, columns, buckets)
    both = _matched(one, other, [by, "bucket"], "full_outer")
    unequal = F.lit(False)
    for name in _CHECK:
        unequal = unequal | ~one[name].eqNullSafe(other[name])
    there = one["rows"].isNotNull()
    return both.filter(unequal).select(F.when(there, one[by]).otherwise(other[by]).alias(by), F.coalesce(one["bucket"], other["bucket"]).alias("bucket"))


def differing_days(left: DataFrame, right: DataFrame, by: str, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The days on which anything differs."""
    return differing_places(left, right, by, key, columns).select(by).distinct()


def located_differences(left: DataFrame, right: DataFrame, by: str, key: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(by, key, column, left_value, right_value): each value that differs between rows of one day and key.

    A row that is missing on a side differs in all columns that the other side fills, and in ``(row)``, with ``true`` where it
    is there. Values are given as text. The right side's columns take the left side's types. Keys should be unique; of
    repeated ones every combination is compared, so that each side's odd row shows up.
    """
    kinds = dict(left.dtypes)
    names = [by, *key, *columns]
    left = left.select(*names)
    right = right.select(*[F.col(name).cast(kinds[name]).alias(name) for name in names])
    places = differing_places(left, right, by, key, columns, buckets)

    def there(rows: DataFrame, prefix: str) -> DataFrame:
        bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        some = _matched(bucketed, places, [by, "bucket"], "left_semi").drop("bucket")
        return some.withColumn("row", F.lit(True)).toDF(*[f"{prefix}_{name}" for name in (*names, "row")])

    one, other = there(left, "l"), there(right, "r")
    same = F.lit(True)
    for name in (by, *key):
        same = same & F.col(f"l_{name}").eqNullSafe(F.col(f"r_{name}"))
    both = one.join(other, same, "full_outer")
    values = [
        F.struct(F.lit(label).alias("column"), F.col(f"l_{name}").cast("string").alias("left_value"), F.col(f"r_{name}").cast("string").alias("right_value"))
        for name, label in [*((name, name) for name in columns), ("row", "(row)")]
    ]
    place = [F.when(F.col("l_row"), F.col(f"l_{name}")).otherwise(F.col(f"r_{name}")).alias(name) for name in (by, *key)]
    return both.select(*place, F.inline(F.array(*values))).filter(~F.col("left_value").eqNullSafe(F.col("right_value")))
