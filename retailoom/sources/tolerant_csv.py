"""Loading CSV files that are not all alike or not all sound.

Files of a table are grouped by their header and each group is read by its own, as the columns that a file has are in its
first line. Lines that don't fit their header, and values that don't fit their type, go to a stored table of rejects with
their file and the reason; the sound rows are loaded. A table with too large a share of rejects is not loaded at all.
"""

import csv
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailoom.schemas import MISSING, RAW_COLUMNS, column_names
from retailoom.sources.csv_files import BOM, LINE, csv_tables
from retailoom.sources.tables import TableStore

REJECTS = "rejects"
MOST_REJECTED = 0.01
_FILE, _WHY = "_file", "_why"


class TooManyRejects(RuntimeError):
    """A table's share of rejected lines is above what is allowed."""


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a path by their header. Only the first line of each file is read; empty files are left out."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if status.isDirectory() or name.startswith(("_", ".")):
            continue
        stream = system.open(status.getPath())
        try:
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        if line:
            found[tuple(next(csv.reader([line.removeprefix(BOM)])))].append(status.getPath().toString())
    return {header: sorted(files) for header, files in sorted(found.items())}


def _fits(text: Column, kind: str) -> Column:
    """The text as a value of its type; NULL if it doesn't fit."""
    if kind == "int":  # a column of whole numbers with gaps is written as 18.0
        return text.try_cast("decimal(20,4)").try_cast("int")
    if kind == "date":  # may be written with a time of day
        return text.try_cast("timestamp").cast("date")
    return text.try_cast(kind)


def judged_rows(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """All lines of a table's files: the table's columns, the file, the line as text if it is rejected, and why (or NULL)."""
    types = {name: kind for _, name, kind in RAW_COLUMNS[table]}
    renamed = column_names(table)
    parts: DataFrame | None = None
    for header, files in headers(spark, path).items():
        raw = [f"c{n}" for n in range(len(header))]  # whatever the headers are, they can't clash here
        schema = T.StructType([T.StructField(name, T.StringType()) for name in (*raw, LINE)])
        lines = (
            spark.read.option("header", True).option("encoding", "UTF-8").option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"').option("columnNameOfCorruptRecord", LINE).schema(schema).csv(files)
        )
        lines = lines.withColumn(_FILE, F.col("_metadata.file_path"))
        names = [renamed.get(name, name) for name in header]
        double = {name for name in names if names.count(name) > 1}
        if double:
            raise ValueError(f"{table}: columns given twice: {sorted(double)}")
        values, unfit = [], []
        for at, name in zip(raw, names, strict=True):
            kind = types.get(name, "string")
            text = F.when(~F.col(at).isin(*MISSING), F.col(at))
            value = _fits(text, kind)
            values.append(value.alias(name))
            if kind != "string":
                unfit.append(F.when(text.isNotNull() & value.isNull(), F.concat(F.lit(f"{name} is no {kind}: "), text)))
        broken = F.when(F.col(LINE).isNotNull(), F.lit("the line does not fit the header"))
        why = F.coalesce(broken, *unfit, F.lit(None).cast("string"))
        line = F.coalesce(F.col(LINE), F.concat_ws(",", *raw))
        part = lines.select(*values, F.col(_FILE), F.when(why.isNotNull(), line).alias(LINE), why.alias(_WHY))
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    if parts is None:
        raise ValueError(f"{table}: no file with a header in {path}")
    return parts


def load_tolerant(
    spark: SparkSession, folder: str, store: TableStore, most: float = MOST_REJECTED, multi_line: bool = False
) -> dict[str, tuple[int, int] | str]:
    """Load every known ``<table>.csv`` of ``folder``: table -> (rows loaded, lines rejected), or why it was not loaded.

    Files are read once, into a stored table that rows and rejects are taken from. The rejects of all tables are stored as
    ``rejects`` (table_name, file, line, reason), those of tables that were not loaded too. A table whose share of rejects
    is above ``most`` keeps what was stored before. Columns that only some files have are NULL in the rows of the others.
    """
    outcome: dict[str, tuple[int, int] | str] = {}
    rejected: DataFrame | None = None
    for name in sorted(set(csv_tables(spark, folder)) & set(RAW_COLUMNS)):
        try:
            judged = store.settle(f"{name}__judged", judged_rows(spark, f"{folder}/{name}.csv", name, multi_line))
        except Exception as error:  # noqa: BLE001 - reported, not hidden
            outcome[name] = f"{type(error).__name__}: {error}"
            continue
        every, bad = judged.agg(F.count("*"), F.count(_WHY)).first()
        some = judged.filter(f"{_WHY} is not null").select(
            F.lit(name).alias("table_name"), F.col(_FILE).alias("file"), F.col(LINE).alias("line"), F.col(_WHY).alias("reason")
        )
        rejected = some if rejected is None else rejected.unionByName(some)
        if every == bad or bad > most * every:
            outcome[name] = "no rows" if not every else f"{TooManyRejects.__name__}: {bad} of {every} lines"
            continue
        store.replace(name, judged.filter(f"{_WHY} is null").drop(_FILE, LINE, _WHY))
        outcome[name] = (every - bad, bad)
    if rejected is not None:
        store.replace(REJECTS, rejected)
    return outcome


def rejects_by_file(store: TableStore) -> DataFrame:
    """(table_name, file, reason kind, lines): how many lines each file lost, and over what."""
    kind = F.regexp_replace("reason", ": .*$", "").alias("reason")
    return store.read(REJECTS).groupBy("table_name", "file", kind).agg(F.count("*").alias("lines"))
