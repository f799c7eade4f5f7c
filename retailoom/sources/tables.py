"""Stored tables: one Parquet folder per table under a root folder that all executors share."""

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

DAY = "date_key"
# dated tables have a folder per month; inside the files rows lie in order of their day, so that row groups are skipped
MONTH = "month_key"
# of stored tables, which are written once and read a few times; a fifth smaller than Spark's own choice
COMPRESSION = "zstd"


def version_of(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of the files below the paths: their names, lengths and times of change."""
    files = []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        place = hadoop.Path(path)
        system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        statuses = system.listStatus(place)
        files += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in statuses]
    return hashlib.sha256("\n".join(files).encode()).hexdigest()[:16]


def month_of(day: str = DAY) -> Column:
    return F.floor(F.col(day) / 100).cast("int")


def months_of(date_keys: Iterable[int]) -> list[int]:
    return sorted({key // 100 for key in date_keys})


def spread_by_month(rows: DataFrame, day: str = DAY) -> DataFrame:
    """Rows of a month together; adaptive execution splits large months and joins small ones."""
    return rows.withColumn(MONTH, month_of(day)).hint("rebalance", MONTH)


def by_month(rows: DataFrame, day: str = DAY, spread: bool = False) -> DataFrame:
    """Rows of a month together, in order of their day. ``spread``: they were put together before, by ``spread_by_month``."""
    rows = rows.withColumn(MONTH, month_of(day)) if spread else spread_by_month(rows, day)
    return rows.sortWithinPartitions(MONTH, day)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name)).drop(MONTH)

    def read_dates(self, name: str, date_keys: Sequence[int], day: str = DAY) -> DataFrame:
        """Rows of the given days of a dated table: the folders of their months, and of those the row groups of the days."""
        rows = self.spark.read.parquet(self.path(name))
        return rows.filter(F.col(MONTH).isin(months_of(date_keys)) & F.col(day).isin(*date_keys)).drop(MONTH)

    def find(self, name: str) -> DataFrame | None:
        """The table, or None if it was never written."""
        try:
            return self.read(name)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def replace(self, name: str, rows: DataFrame, by_date: bool = False, day: str = DAY) -> DataFrame:
        """Write the whole table anew and return it as read back, with its lineage cut."""
        writer = by_month(rows, day).write.partitionBy(MONTH) if by_date else rows.write
        writer.option("compression", COMPRESSION).option("partitionOverwriteMode", "static").mode("overwrite").parquet(self.path(name))
        stored = self.find(name)
        if stored is None:  # no rows, so no partition was written that would hold the schema
            rows.limit(0).write.mode("overwrite").parquet(self.path(name))
            stored = self.read(name)
        return stored

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        """Add rows to a table, which may not be there yet."""
        rows.write.mode("append").parquet(self.path(name))
        return self.read(name)

    def settle(self, name: str, rows: DataFrame) -> DataFrame:
        """Write an intermediate table and go on from what was written."""
        return self.replace(name, rows)
