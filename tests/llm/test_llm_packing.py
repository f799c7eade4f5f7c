"""Best-fit packing against a plain search over all bins."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from retailoom.llm.packing import best_fit, pack


def plain(pieces, capacity):
    bins, placed = [], []
    for units, source, cluster in pieces:
        fits = [
            (left, n) for n, (left, sources, clusters) in enumerate(bins)
            if left >= units and (source is None or source not in sources) and (cluster is None or cluster not in clusters)
        ]
        left, n = min(fits, default=(None, None))
        if n is None:
            n, left = len(bins), capacity
            bins.append((capacity, set(), set()))
        placed.append((n, capacity - left))
        sources, clusters = bins[n][1] | {source} - {None}, bins[n][2] | {cluster} - {None}
        bins[n] = (left - units, sources, clusters)
    return placed


@pytest.mark.parametrize("seed", range(20))
def test_same_bins_as_a_plain_search(seed):
    rng = random.Random(seed)
    pieces = [
        (rng.randrange(1, 101), rng.choice((None, 0, 0, 1, 2, 3)), rng.choice((None, rng.randrange(40)))) for _ in range(300)
    ]
    if seed % 2:
        pieces.sort(key=lambda p: -p[0])
    assert best_fit(pieces, 100) == plain(pieces, 100)


def test_whole_table(spark):
    rng = random.Random(5)
    rows = [(n, rng.randrange(0, 700), "hot" if n % 3 == 0 else f"s{n % 11}", rng.choice((None, n % 50)), 1) for n in range(2000)]
    rows += [(5000, None, "a", 1, 1), (5001, 0, None, None, 1), (5002, 100_000, "a", 1, 1), (None, 50, None, None, 1), rows[1], rows[1], (1, 64, "b", 9, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, units int, source string, cluster int, bin int")
    found = pack(docs, F.col("units"), 256, source=F.col("source"), cluster=F.col("cluster"), shard_pieces=200).collect()
    # nothing is lost or doubled: pieces of a row add up to it
    assert sum(r.n_units for r in found) == sum(r[1] or 0 for r in rows)
    assert Counter(r.doc_id for r in found if r.start == 0) == Counter(r[0] for r in rows)
    assert [(r.doc_id, r.bin, r.offset) for r in found if r.n_units == 0 and r.doc_id in (5000, 5001)] == [(5000, None, None), (5001, None, None)] or {
        (r.doc_id, r.bin, r.offset) for r in found if r.doc_id in (5000, 5001)
    } == {(5000, None, None), (5001, None, None)}
    long = sorted(r.start for r in found if r.doc_id == 5002)
    assert long == list(range(0, 100_000, 256))
    bins = {}
    for r in found:
        if r.bin is not None:
            bins.setdefault(r.bin, []).append(r)
    facts = {}
    for i, units, source, cluster, _ in rows:
        facts.setdefault(i, []).append((source, cluster))
    for members in bins.values():
        members.sort(key=lambda r: r.offset)
        end = 0
        for r in members:
            assert r.offset == end
            end += r.n_units
        assert end <= 256
        sure = [facts[r.doc_id][0] for r in members if len(set(facts[r.doc_id])) == 1]
        for n in (0, 1):
            seen = [f[n] for f in sure if f[n] is not None]
            assert len(seen) == len(set(seen))


def test_same_result_whatever_the_order(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") * 37 % 90 + 1).alias("u"), (F.col("id") % 7).alias("s"))
    first, second = (
        sorted(map(tuple, pack(d, F.col("u"), 100, source=F.col("s"), shard_pieces=100).collect()))
        for d in (docs, docs.orderBy(F.desc("doc_id")).repartition(3))
    )
    assert first == second


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, units int")
    assert pack(docs, F.col("units"), 10).count() == 0


def test_rows_without_an_id_are_spread_over_shards(spark):
    """A third of the rows have no id; no shard is much fuller than others."""
    docs = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(60).alias("u"))
    found = pack(docs, F.col("u"), 100, shard_pieces=500).groupBy((F.col("bin") / 2**32).cast("long").alias("shard")).count().collect()
    assert len(found) == 12 and max(r["count"] for r in found) < 700
