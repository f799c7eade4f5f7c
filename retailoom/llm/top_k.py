"""Exact top-k inner products by MaxScore.

The dimensions of a vector are its terms; what a term can add to a query's score at most is the query's weight times the
largest (or smallest) component of the shard. Queries meet shards of bounded size. In a shard, a query's terms are
ordered by these bounds. Terms whose bounds together cannot lift a vector to the k-th best score so far are
non-essential: the postings of the others are traversed, and non-essential terms are probed only for vectors that can
still compete, term by term. The best k of each shard are then merged.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailoom.llm.store import Scratch

QUERY_BLOCK = 2048
SHARD_ROWS = 8192
CHUNK = 1024


def max_score(query: np.ndarray, postings: np.ndarray, high: np.ndarray, low: np.ndarray, k: int, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of all columns of ``postings`` (terms x vectors) that may be among the k best.

    All vectors with the k-th best score are included. Whole numbers throughout, so bounds and scores are exact.
    """
    bounds = np.maximum(query * high, query * low)
    order = np.argsort(bounds, kind="stable")
    weights = query[order]
    below = np.concatenate(([0], np.cumsum(bounds[order])))  # what the first terms of the order can add together
    floor = None
    places, scores = [], []
    for first in range(0, postings.shape[1], chunk):
        block = postings[:, first : first + chunk]
        # non-essential: the longest run of weakest terms that cannot reach the floor alone
        cut = 0 if floor is None else int(np.searchsorted(np.maximum.accumulate(below), floor, side="left")) - 1
        cut = max(0, min(cut, len(order)))
        score = weights[cut:] @ block[order[cut:]]
        at = np.arange(block.shape[1])
        for term in range(cut - 1, -1, -1):
            competes = score + below[term + 1] >= floor
            if not competes.all():
                at, score = at[competes], score[competes]
            if not len(at):
                break
            score = score + weights[term] * block[order[term], at]
        if floor is not None:
            good = score >= floor
            at, score = at[good], score[good]
        places.append(at + first)
        scores.append(score)
        best = np.concatenate(scores)
        if len(best) >= k:
            floor = np.partition(best, len(best) - k)[len(best) - k]
            found = np.concatenate(places)
            places, scores = [found[best >= floor]], [best[best >= floor]]
    return (np.concatenate(places), np.concatenate(scores)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _numbers(width: int, *vectors: pd.Series) -> type:
    """float64 where every sum of products stays an exact integer in it (it multiplies faster), else int64."""
    most = [max((abs(int(x)) for v in series for x in (v.min(initial=0), v.max(initial=0))), default=0) for series in vectors]
    return np.float64 if width * most[0] * most[1] < 1 << 52 else np.int64


def _matrix(vectors: pd.Series, width: int, kind: type) -> np.ndarray:
    """Terms x vectors; shorter vectors are filled with zeros."""
    if all(len(v) == width for v in vectors):
        return np.ascontiguousarray(np.array(vectors.tolist(), dtype=kind).reshape(len(vectors), width).T)
    out = np.zeros((width, len(vectors)), kind)
    for i, v in enumerate(vectors):
        out[: len(v), i] = v
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_block: int = QUERY_BLOCK,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): for each query row its k highest inner products with rows of another id.

    Components become floor(scale * x), with x as double. Ties go to the smaller id; a query with fewer than k candidates
    gets all. Vectors (and ids) that are null, or hold null or non-finite components, take no part. Vectors of different
    lengths are compared as if filled with zeros; an empty one scores 0. Equal rows are candidates one by one; rows that
    share the id of the query are not; a query id that occurs several times is answered once for each of its rows.
    An empty table gives an empty result.

    Queries are dealt to blocks of about ``query_block`` and vectors to shards of about ``shard_rows``, by hash; every
    block meets every shard as one group of bounded size.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    x = F.col(vector_column)
    usable = x.isNotNull() & F.col(id_column).isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    rows = vectors.where(usable).select(
        F.col(id_column).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
        F.expr("monotonically_increasing_id()").alias("row"),
    )
    rows = scratch.settle(rows, "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("m"), F.max(F.size("v")).alias("width")).first()
    shards, blocks, width = -(-size.n // shard_rows) or 1, -(-size.m // query_block) or 1, size.width or 0
    shard, block = F.pmod(F.xxhash64("row"), F.lit(shards)), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks))
    asked = rows.where("q").select("id", "v", "row", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    given = rows.select("id", "v", shard.alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def search(queries: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(queries) and len(some):
            some = some.sort_values("id", kind="stable")
            ids = some["id"].to_numpy()
            kind = _numbers(width, queries["v"], some["v"])
            postings, asked = _matrix(some["v"], width, kind), _matrix(queries["v"], width, kind)
            high, low = postings.max(axis=1, initial=0), postings.min(axis=1, initial=0)
            for i, (query, row) in enumerate(zip(queries["id"], queries["row"], strict=True)):
                own = int(np.searchsorted(ids, query, side="right") - np.searchsorted(ids, query, side="left"))
                at, score = max_score(asked[:, i], postings, high, low, k + own)
                other = ids[at] != query
                at, score = at[other], score[other]
                best = np.lexsort((ids[at], -score))[:k]
                out.append(pd.DataFrame({"query_id": query, "row": row, "id": ids[at[best]], "score": score[best].astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "row": [], "id": [], "score": []}, dtype="int64")

    pairs = asked.groupBy("block", "shard").cogroup(given.groupBy("block", "shard")).applyInPandas(search, "query_id long, row long, id long, score long")
    best = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "id")
    merged = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", F.col("id").alias(id_column), "score")
