"""Tables that change all together or not at all.

    <root>/<table>/_version=<n>/month_key=<m>/...    what one version wrote of a dated table
    <root>/<table>/_version=<n>/...                  what one version wrote of another table
    <root>/_started/<n>, <root>/_published/<n>      empty files: a version was begun, and became valid

A writer begins a version, writes tables or months of tables into folders of its own, and publishes them by creating one
empty file, which any file system does in one step. Nothing that readers may be using is ever written over. A version
that fails is never published, so nobody sees it; of two writers that began from the same state the later one is
refused. ``_version=<n>`` holds ``_whole`` if it replaces all of the table; else its months replace those of the same name.
"""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailoom.sources.tables import COMPRESSION, DAY, MONTH, TableStore, by_month, months_of

_WHOLE = "_whole"


def _folder(month: int | None) -> str:
    return f"{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


class Conflict(RuntimeError):
    """Another version was published since this one was begun."""


class VersionedStore(TableStore):
    def __init__(self, spark: SparkSession, root: str, as_of: int | None = None):
        """``as_of``: show the tables as that published version left them."""
        super().__init__(spark, root)
        self.as_of = as_of
        self.writing: int | None = None
        self._base: int | None = None

    # --- versions

    def published(self) -> list[int]:
        """Versions that became valid, oldest first; up to ``as_of``."""
        numbers = sorted(int(name) for name in self._names(f"{self.root}/_published"))
        return [n for n in numbers if self.as_of is None or n <= self.as_of]

    def begin(self) -> int:
        if self.writing is not None or self.as_of is not None:
            raise RuntimeError("a version is being written" if self.as_of is None else "an earlier version can't be changed")
        self._base = max(self.published(), default=0)
        number = max((int(name) for name in self._names(f"{self.root}/_started")), default=0) + 1
        while not self.create(f"{self.root}/_started/{number}"):
            number += 1  # another writer took it
        self.writing = number
        return number

    def publish(self) -> int:
        """Make what was written since ``begin`` the state that everybody reads."""
        number = self.writing
        if number is None:
            raise RuntimeError("no version was begun")
        if max(self.published(), default=0) != self._base:
            self.writing = None
            raise Conflict(f"version {number} was begun from {self._base}")
        self.create(f"{self.root}/_published/{number}")
        self.writing = None
        return number

    @contextmanager
    def version(self) -> Iterator[int]:
        """Writes inside become valid together at the end, or never if an error leaves the block."""
        number = self.begin()
        try:
            yield number
            self.publish()
        finally:
            self.writing = None

    def _seen(self) -> set[int]:
        return {*self.published(), *([] if self.writing is None else [self.writing])}

    # --- reading

    def _state(self, name: str) -> tuple[int | None, dict[str, int]]:
        """The version that wrote the whole table last, and which version each month is of."""
        seen = self._seen()
        written = sorted(int(f.removeprefix("_version=")) for f in self._names(self.path(name)) if f.startswith("_version="))
        written = [n for n in written if n in seen]
        whole = max((n for n in written if self.exists(f"{self.path(name)}/_version={n}/{_WHOLE}")), default=None)
        months: dict[str, int] = {}
        for n in written:
            if whole is not None and n >= whole:
                months |= {f: n for f in self._names(f"{self.path(name)}/_version={n}") if f.startswith(f"{MONTH}=")}
        return whole, months

    def folders(self, name: str) -> list[str]:
        """The folders that make up the table now: of its months, if it is dated and has rows."""
        whole, months = self._state(name)
        if months:
            return [f"{self.path(name)}/_version={n}/{month}" for month, n in sorted(months.items())]
        return [] if whole is None else [f"{self.path(name)}/_version={whole}"]

    def _rows(self, name: str, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.option("basePath", self.path(name)).parquet(*folders).drop("_version", MONTH)

    def find(self, name: str) -> DataFrame | None:
        folders = self.folders(name)
        return self._rows(name, folders) if folders else None

    def read(self, name: str) -> DataFrame:
        rows = self.find(name)
        if rows is None:
            raise FileNotFoundError(f"{self.path(name)}: no published version")
        return rows

    def read_dates(self, name: str, date_keys: Sequence[int], day: str = DAY) -> DataFrame:
        return self.read_months(name, months_of(date_keys)).filter(F.col(day).isin(*date_keys))

    def read_months(self, name: str, months: Sequence[int | None]) -> DataFrame:
        """Rows of some months; None stands for rows without a day. Folders of other months are not even listed."""
        folders = self.folders(name)
        if not folders:
            raise FileNotFoundError(f"{self.path(name)}: no published version")
        wanted = {_folder(month) for month in months}
        some = [folder for folder in folders if folder.rsplit("/", 1)[1] in wanted]
        return self._rows(name, some) if some else self._rows(name, folders[:1]).limit(0)

    # --- writing

    def replace(self, name: str, rows: DataFrame, by_date: bool = False, day: str = DAY, spread: bool = False) -> DataFrame:
        """``spread``: the rows of a month are together already."""
        with self._own_version():
            path = self._written(name)
            writer = by_month(rows, day, spread).write.partitionBy(MONTH) if by_date else rows.write
            writer.option("compression", COMPRESSION).option("partitionOverwriteMode", "static").mode("overwrite").parquet(path)
            if by_date and not any(f.startswith(f"{MONTH}=") for f in self._names(path)):
                rows.limit(0).write.mode("overwrite").parquet(path)
            self.create(f"{path}/{_WHOLE}")
        return self.read(name)

    def replace_months(self, name: str, rows: DataFrame, months: Sequence[int | None], day: str = DAY) -> DataFrame:
        """Replace the given months by ``rows``, which hold no others, and return them. Months without rows end up empty."""
        with self._own_version():
            path = self._written(name)
            writer = by_month(rows, day).write.option("compression", COMPRESSION).option("partitionOverwriteMode", "static")
            writer.mode("overwrite").partitionBy(MONTH).parquet(path)
            filled = set(self._names(path))
            nothing = rows.limit(0)
            for month in months:
                if _folder(month) not in filled:
                    nothing.write.parquet(f"{path}/{_folder(month)}")
        return self.read_months(name, months)

    def replace_dates(self, name: str, rows: DataFrame, date_keys: Sequence[int], day: str = DAY) -> DataFrame:
        """Replace the rows of ``date_keys`` by those of ``rows``; only the months of these days are read and written."""
        months = months_of(date_keys)
        others = self.read_months(name, months).filter(~F.col(day).isin(*date_keys))
        return self.replace_months(name, others.unionByName(rows.filter(F.col(day).isin(*date_keys))), months, day)

    def append(self, name: str, rows: DataFrame) -> DataFrame:
        raise NotImplementedError("a version replaces tables or months of them; see RawLayer.merge for new rows")

    def clean(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the last ``keep`` published versions shows, and return them.

        Folders of versions begun after the last published one stay, as they may be in the making.
        """
        published = self.published()
        if self.writing is not None or not published:
            return []
        views = [VersionedStore(self.spark, self.root, n) for n in published[-max(keep, 1) :]]
        gone = []
        for name in (n for n in self._names(self.root) if not n.startswith("_")):
            states = [view._state(name) for view in views]
            wholes = {whole for whole, _ in states}
            shown = {(n, month) for _, months in states for month, n in months.items()}
            for folder in self._names(self.path(name)):
                number = int(folder.removeprefix("_version="))
                months = [f for f in self._names(f"{self.path(name)}/{folder}") if f.startswith(f"{MONTH}=")]
                if number > published[-1]:
                    continue
                if number in wholes or any((number, month) in shown for month in months):
                    gone += [f"{self.path(name)}/{folder}/{month}" for month in months if (number, month) not in shown]
                else:
                    gone.append(f"{self.path(name)}/{folder}")
        for folder in gone:
            self._system(folder).delete(self._path(folder), True)
        return gone

    @contextmanager
    def _own_version(self) -> Iterator[None]:
        """A write outside of a version is a version by itself."""
        if self.writing is not None:
            yield
        else:
            with self.version():
                yield

    def _written(self, name: str) -> str:
        return f"{self.path(name)}/_version={self.writing}"

    # --- the file system of the root folder

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        """Names in a folder; none if it is not there."""
        system = self._system(folder)
        if not system.exists(self._path(folder)):
            return []
        return [status.getPath().getName() for status in system.listStatus(self._path(folder))]

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def create(self, path: str) -> bool:
        """Create an empty file; False if it is there already."""
        return bool(self._system(path).createNewFile(self._path(path)))
