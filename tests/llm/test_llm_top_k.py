"""Exact top-k against all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailoom.llm.top_k import max_score, top_k


def brute_force(rows, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in usable:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in usable if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_max_score_keeps_the_best(seed):
    rng = np.random.default_rng(seed)
    postings = rng.integers(-20, 20, (12, 700)) * (rng.random((12, 700)) < 0.4)
    for query in rng.integers(-9, 9, (8, 12)):
        at, score = max_score(query, postings, postings.max(axis=1), postings.min(axis=1), 5, chunk=64)
        every = query @ postings
        best = np.sort(every)[-5]
        assert set(np.flatnonzero(every >= best)) == set(at[score >= best])
        assert (score == every[at]).all()


def test_against_all_products(spark):
    rng = random.Random(3)
    rows = [(n, [rng.uniform(-1, 1) for _ in range(16)]) for n in range(400)]
    rows += [(n, rows[n % 7][1]) for n in range(400, 460)]  # ties
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")] * 16), (650, [float("inf")] * 16), (None, [1.0] * 16), (700, []), (750, [0.5] * 3), (750, [0.25] * 16)]
    rows += [rows[5]]
    frame = spark.createDataFrame([(*r, 1, "s") for r in rows], "vec_id long, embedding array<float>, rank int, score string")
    narrow = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = top_k(frame, F.col("vec_id") % 50 == 0, query_block=5, shard_rows=90)
    assert sorted(map(tuple, found.collect())) == brute_force(narrow, 5)


def test_few_and_no_candidates(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    assert top_k(spark.createDataFrame([(1, [1.0])], schema), F.lit(True)).count() == 0
    found = top_k(spark.createDataFrame([(1, [1.0]), (2, [-0.5])], schema), F.col("vec_id") == 1)
    assert [tuple(r) for r in found.collect()] == [(1, 1, 2, -128 * 256)]
