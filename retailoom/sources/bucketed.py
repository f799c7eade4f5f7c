"""Tables kept in buckets of a key: joins and groupings by that key move no rows.

A table is written once, into a folder of its own; a later state of it is a table of another folder.
"""

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# a bucket is read by one task and never split, so keys with more rows than this share of a mean bucket lie apart
HOT_SHARE = 0.25
LEAST_HOT = 100_000


@dataclass(frozen=True)
class Bucketed:
    """A table in two parts: ``rows`` in buckets, ``apart`` the rows of the ``hot`` keys and of no key, in plain files."""

    key: str
    rows: DataFrame
    apart: DataFrame
    hot: DataFrame

    def everything(self) -> DataFrame:
        return self.rows.unionByName(self.apart)


def pairs(left: Bucketed, right: Bucketed) -> list[tuple[DataFrame, DataFrame]]:
    """Parts of two tables to be joined by their key, whose results together are the inner join of the tables.

    The first pair needs no shuffle. The others, with the rows of hot keys, are there only if there are such keys; adaptive
    execution splits them as any other join.
    """
    key = left.key
    found = [(left.rows, right.rows)]
    if not left.hot.isEmpty():
        found.append((left.apart, right.everything().join(left.hot, key, "left_semi")))
    if not right.hot.isEmpty():
        found.append((left.rows.join(right.hot, key, "left_semi"), right.apart))
    return found


class BucketStore:
    """Bucketed tables below a folder that all executors share. Tables are joined without a shuffle if key and number agree."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    def path(self, name: str, part: str) -> str:
        return f"{self.root}/{name}/{self.key}-{self.buckets}/{part}"

    def write(self, name: str, rows: DataFrame, least_hot: int = LEAST_HOT) -> Bucketed:
        """Write a table. Keys with over ``least_hot`` rows and over HOT_SHARE of a mean bucket (so at most
        buckets / HOT_SHARE of them) lie apart, and so do rows without a key, which join with nothing.
        """
        hot_path = self.path(name, "hot")
        most = max(least_hot, rows.count() * HOT_SHARE / self.buckets)
        counts = rows.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.count(F.lit(1)).alias("_rows"))
        counts.filter(F.col("_rows") > most).select(self.key).write.parquet(hot_path)
        hot = self.spark.read.schema(rows.select(self.key).schema).parquet(hot_path)
        apart = rows.filter(F.col(self.key).isNull()).unionByName(rows.join(hot, self.key, "left_semi"))
        apart.write.parquet(self.path(name, "apart"))
        rest = rows.filter(F.col(self.key).isNotNull()).join(hot, self.key, "left_anti").select(*rows.columns)
        # the same hash decides on partition and bucket, so a bucket is one file
        rest.repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key).sortBy(self.key).option(
            "path", self.path(name, "rows")
        ).saveAsTable(self._table(name))
        return self.read(name)

    def read(self, name: str) -> Bucketed:
        """A table, also one that another session has written: the catalog is told of its buckets if it doesn't know them."""
        apart = self.spark.read.parquet(self.path(name, "apart"))
        if not self.spark.catalog.tableExists(self._table(name)):
            columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in apart.schema)
            by = f"clustered by (`{self.key}`) sorted by (`{self.key}`) into {self.buckets} buckets"
            self.spark.sql(f"create table {self._table(name)} ({columns}) using parquet {by} location '{self.path(name, 'rows')}'")
        hot = self.spark.read.schema(apart.select(self.key).schema).parquet(self.path(name, "hot"))
        return Bucketed(self.key, self.spark.table(self._table(name)), apart, hot)

    def _table(self, name: str) -> str:
        return f"bucketed_{hashlib.sha256(self.path(name, 'rows').encode()).hexdigest()[:16]}"
