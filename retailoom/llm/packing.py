"""Best-fit packing of documents into sequences, with conflicts.

Pieces are dealt to shards of bounded size by hash. In a shard the largest piece comes first. Open bins are ordered by
what is left in them; from the first that is large enough the search goes on to the next larger one until a bin holds
neither the piece's source nor its duplicate cluster, which its bitmaps tell. That bin is the tightest compatible one.
"""

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import Scratch

SHARD_PIECES = 4096


def best_fit(pieces: list[tuple[int, int | None, int | None]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each (units, source bit, cluster bit), in this order; a bit of None conflicts with nothing."""
    left: list[tuple[int, int]] = []  # (residual, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    placed = []
    for units, source, cluster in pieces:
        source_bit = 0 if source is None else 1 << source
        cluster_bit = 0 if cluster is None else 1 << cluster
        at = bisect_left(left, (units, -1))
        while at < len(left) and (sources[left[at][1]] & source_bit or clusters[left[at][1]] & cluster_bit):
            at += 1
        if at < len(left):
            residual, number = left.pop(at)
        else:
            residual, number = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        placed.append((number, capacity - residual))
        sources[number] |= source_bit
        clusters[number] |= cluster_bit
        if residual > units:
            insort(left, (residual - units, number))
    return placed


def _numbered(values: pd.Series) -> list[int | None]:
    codes, _ = pd.factorize(values)
    return [None if c < 0 else int(c) for c in codes]


def pack(
    docs: DataFrame,
    units: Column,
    capacity: int,
    id_column: str = "doc_id",
    source: Column | None = None,
    cluster: Column | None = None,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """(id, piece, start, n_units, bin, offset): where each part of each document goes.

    A document of more than ``capacity`` units is cut into pieces of ``capacity`` and a rest. No bin holds two pieces of
    one source or of one duplicate cluster. Bins are numbered over all shards; the number of shards follows the number
    of pieces, so a shard holds about ``shard_pieces`` at any scale, and a hot source is spread over all shards.

    Documents of null or no units (empty texts) are returned once, with null bin and offset. A null source or cluster
    conflicts with nothing. Rows that share an id, and equal rows, are packed one by one. Ties go by id, then piece.
    An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    nothing = F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(units.cast("long"), F.lit(0)).alias("units"),
        nothing.alias("source") if source is None else source.cast("string").alias("source"),
        nothing.alias("cluster") if cluster is None else cluster.cast("string").alias("cluster"),
    )
    last = F.greatest(F.lit(0), F.floor((F.col("units") - 1) / capacity)).cast("int")
    pieces = rows.select("id", "units", "source", "cluster", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * capacity
    # a stored number, as rows without an id would all land in one shard
    number = F.monotonically_increasing_id().alias("row")
    pieces = pieces.select("id", "piece", start.alias("start"), F.least(F.lit(capacity), F.col("units") - start).alias("n_units"), "source", "cluster", number)
    pieces = scratch.settle(pieces, "pieces")
    shards = -(-pieces.count() // shard_pieces) or 1
    schema = "id long, piece int, start long, n_units long, bin long, offset long"

    def place(key, frame):
        frame = frame.sort_values(["n_units", "id", "piece", "source", "cluster"], ascending=[False, True, True, True, True], na_position="first")
        placed = best_fit(list(zip(frame["n_units"].tolist(), _numbered(frame["source"]), _numbered(frame["cluster"]), strict=True)), capacity)
        frame["bin"] = [(int(key[0]) << 32) + number for number, _ in placed]
        frame["offset"] = [offset for _, offset in placed]
        return frame[["id", "piece", "start", "n_units", "bin", "offset"]]

    # rows of one id are told apart by what they are; the number stands in for a missing id
    shard = F.pmod(F.xxhash64(F.coalesce("id", "row"), "piece", "source", "cluster", "n_units"), F.lit(shards))
    packed = pieces.where("n_units > 0").withColumn("shard", shard).groupBy("shard").applyInPandas(place, schema)
    empty = pieces.where("n_units = 0").select("id", "piece", "start", "n_units", F.lit(None).cast("long").alias("bin"), F.lit(None).cast("long").alias("offset"))
    return packed.unionByName(empty).withColumnRenamed("id", id_column)
