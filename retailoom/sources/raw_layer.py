"""Raw tables that take deliveries again and again: rows are merged by key, and only months that change are written.

Dated tables lie in folders by month (see ``sources.versions``). Order lines have no day of their own: they get that of
their order, from the index of order ids and days that the stored orders are, and so lie beside their order's month. A
line whose order has not come yet waits in the folder of rows without a day, until the order comes.

A delivery is one version: all of its tables change together, or none. What it changed is kept (``changes``), so whoever
builds on the layer can go on from the version it has seen last. The same delivery twice changes nothing.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailoom.functions import columns as C
from retailoom.plans.star import RAW_DAY
from retailoom.schemas import RAW_COLUMNS, RAW_KEYS
from retailoom.sources.csv_files import csv_tables, read_raw_csv
from retailoom.sources.tables import TableStore, version_of
from retailoom.sources.versions import VersionedStore

#: the day of a row, beside its own columns
ROW_DAY = "_date_key"
LINES, ORDERS = "ods_order_details", "ods_orders"
DATED = frozenset({*RAW_DAY, LINES})
CHANGES = "changes"


@dataclass(frozen=True)
class Delivery:
    """What a merge did: its version (None if nothing changed), the days and the tables that it changed."""

    version: int | None
    date_keys: tuple[int, ...]
    tables: tuple[str, ...]


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


class RawLayer:
    def __init__(self, spark: SparkSession, root: str, as_of: int | None = None):
        self.spark = spark
        self.store = VersionedStore(spark, root, as_of)
        # ids of the orders that the delivery at hand changed, and the months they were in
        self._touched: tuple[DataFrame, list[int | None]] | None = None

    # --- reading

    @property
    def version(self) -> int:
        return max(self.store.published(), default=0)

    def read(self, name: str) -> DataFrame:
        return self.store.read(name).drop(ROW_DAY)

    def read_all(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in RAW_COLUMNS if self.store.folders(name)}

    def read_dates(self, name: str, date_keys: Sequence[int]) -> DataFrame:
        """Rows of some days; of order lines those of the orders of these days. Other months are not read."""
        if name not in DATED:
            return self.read(name)
        return self.store.read_dates(name, date_keys, ROW_DAY).drop(ROW_DAY)

    def changes(self, since: int = 0) -> DataFrame:
        """(version, table_name, date_key) of what later versions than ``since`` changed; no day for undated tables."""
        found = self.store.find(CHANGES)
        if found is None:
            return self.spark.createDataFrame([], "version int, table_name string, date_key int")
        return found.filter(F.col("version") > since)

    # --- writing

    def load(self, frames: Mapping[str, DataFrame]) -> int:
        """Replace the given tables."""
        with self.store.version() as number:
            for name in _ordered(frames):
                self.store.replace(name, self._with_day(name, frames[name], every=True), name in DATED, ROW_DAY)
        return number

    def merge(self, frames: Mapping[str, DataFrame]) -> Delivery:
        """Add new rows and replace rows of the same key (``schemas.RAW_KEYS``; null-safe).

        Rows with one key in a delivery count together: all of them replace all stored rows of the key, so nothing is
        lost where a key is not as unique as it should be (the layer checks tell). Where there is an ``update_time``,
        only the latest of a key count. Tables without the columns of their key are delivered by days: the days that
        occur replace those stored. Columns that the stored table lacks are left out, missing ones become NULL.
        """
        days: dict[str, set[int | None]] = {}
        self._touched = None
        number = self.store.begin()
        try:
            staged = TableStore(self.spark, f"{self.store.root}/_delivered/{number}")
            for name in _ordered(frames):
                days[name] = self._merge(name, frames[name], staged)
                if name == ORDERS and days[name] and LINES not in frames and self.store.find(LINES) is not None:
                    days[LINES] = self._merge(LINES, self.read(LINES).limit(0), staged)
            changed = sorted(name for name, some in days.items() if some)
            if not changed:
                self.store.writing = None
                return Delivery(None, (), ())
            noted = [(number, name, day) for name in changed for day in sorted(days[name], key=_null_first)]
            log = self.spark.createDataFrame(noted, "version int, table_name string, date_key int")
            # as many rows as deliveries changed days, which is far from the size of any table
            before = self.store.find(CHANGES)
            self.store.replace(CHANGES, log if before is None else before.unionByName(log).coalesce(1))
            self.store.publish()
        finally:
            self.store.writing = None
        keys = sorted({day for name in changed if name in DATED for day in days[name] if day is not None})
        return Delivery(number, tuple(keys), tuple(changed))

    def merge_csv(self, folder: str, multi_line: bool = False) -> Delivery:
        """Merge every ``<table>.csv`` of a folder. Files that were merged before, as they are now, are not read again."""
        names = sorted(set(csv_tables(self.spark, folder)) & set(RAW_COLUMNS))
        seen = {name: f"{self.store.root}/_merged/{name}-{version_of(self.spark, [f'{folder}/{name}.csv'])}" for name in names}
        fresh = [name for name in names if not self.store.exists(seen[name])]
        delivery = self.merge({name: read_raw_csv(self.spark, f"{folder}/{name}.csv", name, multi_line) for name in fresh})
        for name in fresh:  # after the fact: a delivery that is merged twice changes nothing
            self.store.create(seen[name])
        return delivery

    def _with_day(self, name: str, rows: DataFrame, every: bool = False) -> DataFrame:
        """``every``: the rows are the whole table, so looking up the orders they need costs more than taking all."""
        if name in RAW_DAY:
            return rows.withColumn(ROW_DAY, C.date_key(F.col(RAW_DAY[name])))
        if name == LINES:
            return rows.join(self._order_days(None if every else rows), "order_id", "left").select(*rows.columns, ROW_DAY)
        return rows

    def _order_days(self, lines: DataFrame | None) -> DataFrame:
        """The index from order ids to days, of the orders of ``lines``, or of all. A repeated id counts for its first day."""
        orders = self.store.find(ORDERS)
        if orders is None:
            return self.spark.createDataFrame([], f"order_id string, {ROW_DAY} int")
        some = orders.select("order_id", ROW_DAY)
        if lines is not None:
            some = some.join(lines.select("order_id").distinct(), "order_id", "left_semi")
        return some.groupBy("order_id").agg(F.min(ROW_DAY).alias(ROW_DAY))

    def _merge(self, name: str, rows: DataFrame, staged: TableStore) -> set[int | None]:
        """The days that changed; {None} stands for an undated table, or for rows without a day."""
        stored = self.store.find(name)
        if stored is None:
            new = self.store.replace(name, self._with_day(name, _latest(rows, RAW_KEYS[name])), name in DATED, ROW_DAY)
            if name == ORDERS:
                self._touched = new.select("order_id"), [None]
            return self._days(new) if name in DATED else {None}
        kinds = {c: stored.schema[c].dataType for c in stored.columns if c != ROW_DAY}
        rows = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])
        key = [k for k in RAW_KEYS[name] if k in kinds]
        if len(key) < len(RAW_KEYS[name]):
            return self._replace_days(name, staged.replace(name, self._with_day(name, rows)))
        rows = staged.replace(name, self._with_day(name, _latest(rows, key))).select(stored.columns)
        keys = rows.select(key).distinct()
        held = stored
        if name in DATED:  # the other rows of the table are not read but for their keys
            before = stored.select(*key, ROW_DAY)
            before = before.join(keys, _same(before, keys, key), "left_semi")
            held = self.store.read_months(name, _months(self._days(before.select(ROW_DAY).unionByName(rows.select(ROW_DAY)))))
        held = staged.replace(f"{name}-held", held.join(keys, _same(held, keys, key), "left_semi")).select(stored.columns)
        differ = rows.exceptAll(held).unionByName(held.exceptAll(rows)).select(key).distinct()
        new = rows.join(differ, _same(rows, differ, key), "left_semi")
        old = held.join(differ, _same(held, differ, key), "left_semi")
        if name == LINES:
            moved_from, moved_to = self._moved_lines(keys)
            new, old = new.unionByName(moved_to.select(stored.columns)), old.unionByName(moved_from)
        new, old = staged.replace(f"{name}-new", new), staged.replace(f"{name}-old", old)
        if new.isEmpty():
            return set()
        keys = new.select(key).distinct()
        if name not in DATED:
            kept = stored.join(keys, _same(stored, keys, key), "left_anti")
            self.store.replace(name, kept.unionByName(new))
            return {None}
        days = self._days(new.select(ROW_DAY).unionByName(old.select(ROW_DAY)))
        months = _months(days)
        if name == ORDERS:
            self._touched = new.select("order_id"), months
        rest = self.store.read_months(name, months)
        kept = rest.join(keys, _same(rest, keys, key), "left_anti")
        self.store.replace_months(name, kept.unionByName(new), months, ROW_DAY)
        return days

    def _replace_days(self, name: str, rows: DataFrame) -> set[int | None]:
        """A delivery of whole days; days that are stored just so stay untouched."""
        days = self._days(rows)
        held = self.store.read_dates(name, [d for d in days if d is not None], ROW_DAY)
        content = F.sum(F.xxhash64(*held.columns).cast("decimal(38,0)")).alias("content")

        def by_day(frame: DataFrame) -> dict:
            found = frame.filter(F.col(ROW_DAY).isNotNull()).groupBy(ROW_DAY).agg(F.count("*").alias("n"), content)
            return {row[0]: (row[1], row[2]) for row in found.collect()}  # one row per day

        new, old = by_day(rows), by_day(held)
        days = {day for day in new if new[day] != old.get(day)}
        if days:
            self.store.replace_dates(name, rows, sorted(days), ROW_DAY)
        return days

    def _moved_lines(self, delivered: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Stored lines whose order came after them or changed its day, and the same with the day of now.

        Only orders of this delivery can be such, and their lines lie where the orders were, or wait without a day.
        Lines of a key move together. Keys that are delivered anew are not meant.
        """
        orders, months = self._touched or (self.store.read(ORDERS).select("order_id").limit(0), [])
        held = self.store.read_months(LINES, sorted({*months, None}, key=_null_first))
        key = list(RAW_KEYS[LINES])
        theirs = held.join(orders.distinct(), "order_id", "left_semi").select(held.columns)
        now = self._order_days(orders).withColumnRenamed(ROW_DAY, "_day")
        moved = theirs.join(now, "order_id").filter(~F.col(ROW_DAY).eqNullSafe(F.col("_day"))).select(key).distinct()
        moved = moved.join(delivered, _same(moved, delivered, key), "left_anti")
        lines = held.join(moved, _same(held, moved, key), "left_semi")
        return lines, self._with_day(LINES, lines.drop(ROW_DAY))

    def _days(self, rows: DataFrame) -> set[int | None]:
        return {row[0] for row in rows.select(ROW_DAY).distinct().collect()}  # days of a calendar


def _null_first(x: int | None) -> tuple[bool, int | None]:
    return x is not None, x


def _months(days: set[int | None]) -> list[int | None]:
    return sorted({None if day is None else day // 100 for day in days}, key=_null_first)


def _latest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows with the latest ``update_time`` of their key, which may be several; all rows if there is no such column."""
    if "update_time" not in rows.columns or not all(k in rows.columns for k in key):
        return rows
    last = rows.groupBy(*key).agg(F.max("update_time").alias("update_time"))
    return rows.join(last, _same(rows, last, [*key, "update_time"]), "left_semi")


def _ordered(frames: Mapping[str, DataFrame]) -> list[str]:
    """Lines after the orders they take their day from."""
    return sorted(frames, key=lambda name: (name == LINES, name))
