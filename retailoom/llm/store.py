"""Tables stored between steps, and filters of fixed size."""

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailoom.session import shared_folder


# Python workers get whole texts in batches of this many rows and bytes at most
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep what a Python worker holds at once small, however long the texts are."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        held = spark.conf.get(key, None)
        digits = "".join(c for c in held or "" if c.isdigit())
        if held is None or not held.isdigit() or int(digits) > most or int(digits) <= 0:
            spark.conf.set(key, str(most))


class Scratch:
    """Stored steps of one run, in a folder of its own below the cluster's shared folder.

    A stored step cuts lineage like a checkpoint: later stages read files, so a lost executor costs a read only.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4()}"
        self.steps = 0
        bounded_batches(spark)

    def settle(self, frame: DataFrame, name: str) -> DataFrame:
        self.steps += 1
        path = f"{self.folder}/{self.steps:03d}-{name}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)


def schema_text(frame: DataFrame) -> str:
    """The columns of a frame as Python functions over Arrow name them."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)


def in_blocks(rows: DataFrame, sized: list[str], most_rows: int, most_bytes: int) -> DataFrame:
    """Adds ``unit``, the number of a row's block: rows as they come, until there are many or their ``sized`` strings are long.

    One longer row is a block of its own. The result must be stored before it is used twice.
    """

    def deal(batches):
        unit = TaskContext.get().partitionId() << 32
        n = size = 0
        for batch in batches:
            units = []
            for values in zip(*[batch.column(name) for name in sized], strict=True):
                long_ = sum(v.as_buffer().size for v in values if v.is_valid)
                if n and (n == most_rows or size + long_ > most_bytes):
                    unit, n, size = unit + 1, 0, 0
                n, size = n + 1, size + long_
                units.append(unit)
            yield pa.record_batch([*batch.columns, pa.array(units, pa.int64())], [*batch.schema.names, "unit"])

    return rows.mapInArrow(deal, schema_text(rows) + ", unit long")


def bitmap(frame: DataFrame, hashed: Column, bits: int) -> np.ndarray:
    """A bit for each remainder of ``hashed`` that occurs. At most ``bits / 64`` longs ever reach the driver."""
    at = F.pmod(hashed, F.lit(bits))
    words = (
        frame.select(F.floor(at / 64).cast("int").alias("word"), F.expr("0L").alias("zero"), (at % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("set"))
    )
    rows = words.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows["word"].to_numpy()] = rows["set"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which of the signed 64-bit hashes have their bit set; as in ``bitmap``, by the non-negative remainder."""
    at = np.mod(hashed, np.int64(len(bits) * 64))
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
