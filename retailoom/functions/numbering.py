"""Dense row numbers without sorting everything in one task.

``row_number()`` over a whole table plans to a single partition. Here the rows are split into buckets
that are already in the wanted order; each bucket is numbered by itself and shifted by the number of
rows in the buckets before it. Only the bucket sizes pass through one task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_DIGITS = 3  # 4096 buckets
RANGES = 256  # of a measure that rows are ranked by


def hash_bucket(*columns: str, digits: int = HASH_DIGITS) -> Column:
    """Leading hex digits of the MD5 of the columns: an even spread that any engine can repeat."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.substring(F.md5(text), 1, digits)


def number_rows(
    rows: DataFrame,
    into: str,
    bucket: str,
    order_by: Sequence[str],
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Number all rows 1..n in the order (bucket, *order_by). ``sizes`` (bucket, count) saves a pass if known."""
    if sizes is None:
        sizes = rows.groupBy(bucket).count()
    before = F.sum("count").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(bucket, F.coalesce(before, F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy(bucket).orderBy(*order_by))
    return (
        rows.withColumn("_here", here)
        .join(offsets, bucket)  # one row per bucket: small enough that Spark broadcasts it by itself
        .withColumn(into, F.col("_before") + F.col("_here"))
        .drop("_here", "_before", bucket)
    )


def rank_rows(rows: DataFrame, measure: str, into: str, ties: Sequence[str], within: str | None = None) -> DataFrame:
    """Rank rows 1..n by ``measure``, largest first and NULL last, then by ``ties``; apart for each value of ``within``.

    Quantiles of the measure cut the rows into ranges. Each range is ranked by itself and shifted by the rows of the
    ranges before it, so no task sees more than a range (and rows of equal measure).
    """
    keys = [within] if within else []
    cuts = F.percentile_approx(measure, [n / RANGES for n in range(1, RANGES)], 100 * RANGES)
    above = F.size(F.filter("_cuts", lambda cut: cut > F.col(measure)))
    ranged = rows.withColumn("_cuts", rows.select(cuts).scalar()).withColumn("_range", F.when(F.col(measure).isNull(), RANGES).otherwise(above))
    sizes = ranged.groupBy(*keys, "_range").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_range").alias("_at"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("_range") == F.col("_at")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    here = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(F.col(measure).desc_nulls_last(), *ties))
    ranked = ranged.withColumn("_here", here).join(offsets, same)
    return ranked.withColumn(into, (F.col("_before") + F.col("_here")).cast("int")).select(*rows.columns, into)


def surrogate_key(rows: DataFrame, business_id: str, into: str, existing: DataFrame | None = None) -> DataFrame:
    """One row per business id with a dense BIGINT key.

    A repeated business id keeps its smallest row. With ``existing`` (business id, key), known ids keep
    their key and new ones are numbered after the highest key, so that stored facts stay valid.
    """
    bucketed = rows.withColumn("_bucket", hash_bucket(business_id))
    unique = _one_row_per_id(bucketed, business_id)
    if existing is None:
        sizes = bucketed.groupBy("_bucket").agg(F.count_distinct(business_id).alias("count"))
        return number_rows(unique, into, "_bucket", [business_id], sizes)
    known = existing.select(business_id, into)
    kept = unique.join(known, business_id, "left")
    fresh = number_rows(kept.filter(F.col(into).isNull()).drop(into), into, "_bucket", [business_id])
    highest = known.select(F.coalesce(F.max(into), F.lit(0))).scalar()
    return kept.filter(F.col(into).isNotNull()).drop("_bucket").unionByName(fresh.withColumn(into, F.col(into) + highest))


def _one_row_per_id(bucketed: DataFrame, business_id: str) -> DataFrame:
    """The smallest row of each id, found on the map side first: an id with very many rows is a few when it moves."""
    others = [c for c in bucketed.columns if c not in (business_id, "_bucket")]
    smallest = F.min(F.struct(*others)).alias("_row") if others else F.lit(None).alias("_row")
    return bucketed.groupBy("_bucket", business_id).agg(smallest).select(
        business_id, "_bucket", *[F.col(f"_row.`{c}`").alias(c) for c in others]
    )


def number_by_hash(rows: DataFrame, unique_id: str, into: str) -> DataFrame:
    """Number rows that already are one per id, in the same order as ``surrogate_key``."""
    return number_rows(rows.withColumn("_bucket", hash_bucket(unique_id)), into, "_bucket", [unique_id])
