"""CSV files: UTF-8, with a header and possibly a byte order mark."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailoom.schemas import MISSING, RAW_COLUMNS, column_names
from retailoom.sources.tables import TableStore

BOM = "\ufeff"
LINE = "_line"


def rename_columns(rows: DataFrame, table: str) -> DataFrame:
    """Give the columns of a raw table their names; columns without an entry keep theirs."""
    return rows.withColumnsRenamed(column_names(table))


def with_nulls(rows: DataFrame, text: bool = True) -> DataFrame:
    """Turn NaN, and text that stands for a missing value unless ``text`` is off, into NULL."""

    def clean(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        if kind in ("float", "double"):
            return F.when(~F.isnan(column), column).alias(name)
        if text and kind == "string":
            return F.when(~column.isin(*MISSING), column).alias(name)
        return column

    return rows.select(*[clean(name, kind) for name, kind in rows.dtypes])


def read_raw_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """Read a file or folder of files as the raw table ``table``, with typed columns.

    Columns are taken by their header, in any order and under either name; columns that the table does not know stay
    text. All files of a folder must have the same header. It is an error if one has not, if a value does not fit its
    type, or if a line has more or fewer fields than its header. Files are split among tasks unless ``multi_line`` is
    set, which fields with line breaks need; without it such a field is an error too.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
    )
    found = reader.csv(path).columns  # of the first file
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*found, LINE)])
    # every file's header is held against the schema
    text = reader.schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", LINE).csv(path)
    unfit = F.raise_error(F.concat(F.lit(f"{table}: a line does not fit the header: "), F.col(LINE))).cast("string")
    # in the first column, so that no use of the rows goes without the check
    first = F.when(F.col(LINE).isNull(), F.col(f"`{found[0]}`")).otherwise(unfit)
    checked = text.withColumn(found[0], first).drop(LINE)
    named = rename_columns(checked.withColumnRenamed(found[0], found[0].removeprefix(BOM)), table)
    types = {name: kind for _, name, kind in RAW_COLUMNS.get(table, ())}
    return with_nulls(named).select(
        *[_typed(F.col(f"`{name}`"), types.get(name, "string")).alias(name) for name in named.columns]
    )


def _typed(column: Column, kind: str) -> Column:
    if kind == "int":  # a column of whole numbers with gaps is written as 18.0
        return column.cast("decimal(20,4)").cast(kind)
    if kind == "date":  # may be written with a time of day
        return column.cast("timestamp").cast(kind)
    return column.cast(kind)


def write_csv(rows: DataFrame, path: str, bom: bool = True) -> None:
    """Write CSV with a header, marked as UTF-8 for spreadsheet programs unless ``bom`` is off.

    Every file of the folder starts with the header, hence with the mark.
    """
    if bom:
        rows = rows.withColumnRenamed(rows.columns[0], BOM + rows.columns[0])
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def has_rows(rows: DataFrame | None) -> bool:
    return rows is not None and not rows.isEmpty()


def preview(spark: SparkSession, folder: str, tables: int = 3, rows: int = 10) -> dict[str, DataFrame]:
    """The first ``rows`` rows, as text, of the first ``tables`` CSV tables in ``folder``."""
    names = sorted(csv_tables(spark, folder))[:tables]
    return {name: spark.read.option("header", True).csv(f"{folder}/{name}.csv").limit(rows) for name in names}


def load_layer(
    spark: SparkSession, folder: str, store: TableStore, multi_line: bool = False, mode: str = "full"
) -> dict[str, str | None]:
    """Load every ``<table>.csv`` of ``folder`` into ``store``: table -> None, or why it was not loaded.

    ``mode`` "full" replaces each table; "append" adds the files' rows to what is stored. A table that fails leaves the others alone; whoever goes on must look at the result.
    """
    if mode not in ("full", "append"):
        raise ValueError(f"unknown mode {mode}")
    outcome: dict[str, str | None] = {}
    for name in sorted(csv_tables(spark, folder)):
        try:
            rows = read_raw_csv(spark, f"{folder}/{name}.csv", name, multi_line)
            if has_rows(rows):
                store.replace(name, rows) if mode == "full" else store.append(name, rows)
                outcome[name] = None
            else:
                outcome[name] = "no rows"
        except Exception as error:  # noqa: BLE001 - reported, not hidden
            outcome[name] = f"{type(error).__name__}: {error}"
    return outcome


def load_frames(frames: Mapping[str, DataFrame], store: TableStore) -> None:
    """Load DataFrames that are already in memory, under raw or final column names. NaN becomes NULL, text stays."""
    for name, rows in frames.items():
        store.replace(name, with_nulls(rename_columns(rows, name), text=False))


def csv_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables in ``folder``: files ``<table>.csv`` or folders of that name."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(folder)
    )
    table = F.regexp_extract("path", r"/([^/]+)\.csv(?:/[^/]*)?$", 1)
    return [row[0] for row in files.select(table).distinct().collect()]  # one short name per table
