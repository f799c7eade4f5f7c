"""Refreshing the stored warehouse: all of it, or some dates."""

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailoom.functions import columns as C
from retailoom.operators import quality, reports
from retailoom.plans.star import DAILY, DIMENSION_SOURCE, DIMENSIONS, FACTS, LATE, MERGED, RAW_DAY, REPORTS, SOME_DAYS, STATES, TOTALS, Star
from retailoom.schemas import RAW_COLUMNS, REPORT_LABELS
from retailoom.sources.csv_files import write_csv
from retailoom.sources.raw_layer import RawLayer
from retailoom.sources.tables import TableStore, spread_by_month
from retailoom.sources.versions import VersionedStore

TABLES = (*DIMENSIONS, *FACTS, *DAILY, *TOTALS, *REPORTS)

# what a refresh stores: besides the tables, the states that totals are merged from
STORED = frozenset({*TABLES, *LATE, *STATES})

# stored by month of their date, and refreshed by date
DATED = frozenset({*FACTS, *LATE, *STATES, *DAILY, "daily_report", "traffic_report"})

# Facts that a refresh of one table passes on: only that table is made from them, so storing them costs more than it
# saves. A refresh of some dates makes them anew from the raw rows of these dates.
PASSED_ON = frozenset({"fact_order_detail", "sales", "fact_promotion"})

# wide tables that are spread by month while they are narrow
SPREAD: dict[str, Callable[[Star], DataFrame]] = {
    "daily_report": lambda s: reports.daily_report(
        s["sales"], s["fact_promotion"], s["dim_store"], s["dim_product"], lay_out=spread_by_month
    ),
}

# the version of the raw layer that the tables were made from
SEEN = "raw_seen"

UNIQUE = {
    "dim_date": ("date_key",),
    "dim_user": ("user_id",),
    "dim_product": ("sku_id",),
    "dim_store": ("store_id",),
    "fact_order": ("order_id",),
}


class Warehouse:
    """Dimensions, facts, rollups and reports stored under one root, from the raw tables ``raw``.

    Each table is written, read back and only then used by the next ones, so that a lost executor costs a part of one
    table. A refresh is a version of the store: its tables become visible together at its end, and if an error stops it
    readers keep what they had. Totals by store, product, category, user and month are merged from daily states.
    """

    def __init__(self, spark: SparkSession, raw: Mapping[str, DataFrame] | RawLayer, root: str):
        self.spark = spark
        self.store = VersionedStore(spark, root)
        self.layer = raw if isinstance(raw, RawLayer) else None
        self.raw: Mapping[str, DataFrame] = raw.read_all() if isinstance(raw, RawLayer) else raw

    @classmethod
    def over_store(cls, spark: SparkSession, raw_store: TableStore, root: str) -> "Warehouse":
        """Over raw tables as ``load_layer`` stores them."""
        return cls(spark, {name: raw_store.read(name) for name in RAW_COLUMNS}, root)

    def refresh(self, tables: Sequence[str] = TABLES) -> Star:
        """Build the tables, and what they are made from, anew."""
        with self.store.version():
            self._note_layer()
            passed_on = {name for name in PASSED_ON if len(tables) == 1 and name not in tables}
            star = Star(
                self.raw,
                lambda name, plan: plan if name in passed_on else self._write_all(name, plan, name in SPREAD),
                plans=MERGED | SPREAD,
            )
            for name in (*LATE, *tables):
                star[name]
        return star

    def refresh_dates(self, date_keys: Sequence[int], tables: Sequence[str] = TABLES) -> Star:
        """Recompute the given dates, and the tables that are not by date.

        Facts and daily tables are read and written in the months of these dates only, raw tables too where ``raw`` is a
        ``RawLayer``; merged totals read daily states. Orders that waited for a user or store who is there now are taken
        up with their dates. The result is that of a full refresh, with one difference: rows new to a dimension get the
        next free key instead of being numbered anew, as the facts of other dates hold the old keys.
        """
        with self.store.version():
            self._note_layer()
            # a raw layer of some tables makes some of the dimensions
            made = [name for name in DIMENSIONS if all(raw in self.raw for raw in _sources(name))]
            before = {name: self.store.read(name) for name in made if name in DIMENSION_SOURCE}
            dimensions = Star(self.raw, self._write_all, earlier=before)
            given = {name: dimensions[name] for name in made}
            date_keys = sorted({*date_keys, *self._awaited(before, given)})
            passed_on = {name for name in PASSED_ON if name not in tables and not self.store.folders(name)}

            if date_keys:
                some_days = {name: self._on_days(name, date_keys) for name in self.raw}
                dated = Star(
                    some_days, lambda name, plan: self._write_dates(name, plan, date_keys, passed_on), given, plans=MERGED | SOME_DAYS
                )
                for name in DATED:
                    if name in tables or self.store.folders(name):
                        dated[name]

            write = lambda name, plan: plan if name in passed_on else self._write_all(name, plan)
            star = Star(self.raw, write, _Stored(self.store, given), plans=MERGED)
            for name in tables:
                star[name]
        return star

    def catch_up(self, tables: Sequence[str] = TABLES) -> list[int]:
        """Refresh what the raw layer changed since the last refresh, and return its dates. Without one, refresh all.

        How far the tables have come is published with them, so a refresh that failed is made up for by the next one.
        """
        if self.layer is None:
            raise ValueError("the raw tables are no RawLayer, so their changes are not known")
        self.raw = self.layer.read_all()
        seen = self.store.find(SEEN)
        if seen is None:
            self.refresh(tables)
            return []
        changes = self.layer.changes(seen.first()[0])
        if changes.isEmpty():
            return []
        dates = [row[0] for row in changes.filter("date_key is not null").select("date_key").distinct().orderBy("date_key").collect()]
        self.refresh_dates(dates, tables)
        return dates

    def _note_layer(self) -> None:
        if self.layer is not None:
            self.store.replace(SEEN, self.spark.createDataFrame([(self.layer.version,)], "raw_version int"))

    def _awaited(self, before: Mapping[str, DataFrame], now: Mapping[str, DataFrame]) -> list[int]:
        """Dates of stored orphans whose user or store has come since."""
        waiting = self.store.find("order_orphans")
        if waiting is None:
            return []
        came = []
        for name, key in (("dim_user", "user_id"), ("dim_store", "store_id")):
            new = now[name].select(key).join(before[name].select(key), key, "left_anti")
            came.append(waiting.join(new, key, "left_semi").select("date_key"))
        return [row[0] for row in came[0].union(came[1]).filter("date_key is not null").distinct().collect()]

    def check(self, files: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Compare the stored layers; ``files`` are the raw frames as read from CSV."""
        star = Star(self.raw, given={name: self.store.read(name) for name in TABLES})
        layers = quality.LAYERS if files is not None else quality.LAYERS[1:]
        return quality.consistency_check(star.metrics(files), layers)

    def duplicates(self) -> dict[str, DataFrame]:
        """Repeated keys per table where keys must be unique; every frame should be empty."""
        return {name: quality.duplicate_keys(self.store.read(name), *key) for name, key in UNIQUE.items()}

    def export_report(self, name: str, path: str) -> None:
        """Write a report as CSV under its column labels."""
        labels = REPORT_LABELS[name]
        write_csv(self.store.read(name).select(*[F.col(column).alias(label) for column, label in labels.items()]), path)

    def _on_days(self, name: str, date_keys: Sequence[int]) -> DataFrame:
        if self.layer is not None:
            return self.layer.read_dates(name, date_keys)
        rows = self.raw[name]
        if name not in RAW_DAY:  # order lines follow their order; only a RawLayer knows their day
            return rows
        days = [dt.datetime.strptime(str(key), "%Y%m%d") for key in date_keys]
        moment = F.col(RAW_DAY[name])
        # the range is for skipping files and row groups, the keys for being exact
        near = (moment >= F.lit(min(days))) & (moment < F.lit(max(days) + dt.timedelta(days=1)))
        return rows.filter(near & C.date_key(moment).isin(*date_keys))

    def _write_all(self, name: str, plan: DataFrame, spread: bool = False) -> DataFrame:
        if name not in STORED:
            return plan
        return self.store.replace(name, _keyed(name, plan), by_date=name in DATED, spread=spread)

    def _write_dates(self, name: str, plan: DataFrame, date_keys: Sequence[int], passed_on: set[str]) -> DataFrame:
        if name not in DATED or name in passed_on:
            return plan
        if not self.store.folders(name):  # never built: all of it is missing, not these dates only
            raise FileNotFoundError(f"{name} was not refreshed before; refresh it whole first")
        self.store.replace_dates(name, _keyed(name, plan), date_keys)
        return self.store.read_dates(name, date_keys)


class _Stored(Mapping[str, DataFrame]):
    """Dimensions at hand and dated tables of a store, which are looked up when asked for."""

    def __init__(self, store: VersionedStore, given: Mapping[str, DataFrame]):
        self.store = store
        self._read = dict(given)

    def __contains__(self, name: object) -> bool:
        return name in self._read or (name in DATED and bool(self.store.folders(str(name))))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.store.read(name)
        return self._read[name]

    def __iter__(self) -> Iterator[str]:
        return (name for name in (*DIMENSIONS, *DATED) if name in self)

    def __len__(self) -> int:
        return sum(1 for _ in self)


def _sources(dimension: str) -> list[str]:
    return [DIMENSION_SOURCE[dimension]] if dimension in DIMENSION_SOURCE else list(RAW_DAY)


def _keyed(name: str, plan: DataFrame) -> DataFrame:
    """Reports carry a date; give them the date key they are stored by."""
    if name in ("daily_report", "traffic_report"):
        return plan.withColumn("date_key", C.date_key(F.col("date")))
    return plan
