"""Near-duplicates, components and stored steps against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from retailoom.llm.graph import components, joined_components
from retailoom.llm.near_dedup import SHORT, _open, _shingle_sets, bitmaps, near_duplicates, possible, profiles
from retailoom.llm.store import Scratch

SCHEMA = "doc_id long, text string, id long, token string, component string"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingle_set(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    if len(words) >= k:
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
    return {tuple(words)} if words else set()


def brute_force(rows, k, percent=80):
    """{(id, text): (set size, component)}; rows without id only follow a copy that has one."""
    sets = [(i, t, shingle_set(t, k)) for i, t in rows]
    parent = {i: i for i, _, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, _, a) in enumerate(sets):
        for j, _, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    by_set = defaultdict(list)
    for i, _, a in sets:
        if i is not None and a:
            by_set[frozenset(a)].append(i)
    out = {}
    for i, t, a in sets:
        of = root(i) if i is not None else root(min(by_set[frozenset(a)])) if by_set.get(frozenset(a)) else None
        out[(i, t)] = (len(a), of)
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(60)]
    rows = []
    for base in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((3, 8, 30, 60, 150)))]
        for _ in range(rng.choice((1, 2, 6))):
            copy = list(words)
            for _ in range(rng.randrange(0, 1 + len(copy) // 8)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((rng.randrange(10_000), " ".join(copy).upper() if base % 5 == 0 else "\n ".join(copy)))
    rows += [(20_000, None), (20_001, ""), (20_002, " \t\n"), (20_003, "one"), (20_004, "ONE"), (20_005, "É x"), (20_006, "é x")]
    rows += [rows[0], rows[0], (None, rows[0][1]), (None, "nobody else"), (None, None), (20_007, "long " * 20_000 + "end")]
    return rows


@pytest.mark.parametrize(("k", "rounds"), [(2, 2), (5, 2), (2, 0)])
def test_against_brute_force(spark, k, rounds):
    rows = corpus(k)
    docs = spark.createDataFrame([(*r, 1, "t", "c") for r in rows], SCHEMA)
    found = near_duplicates(docs, shingle=k, leader_rounds=rounds).collect()
    expected = brute_force(rows, k)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None) == sorted(
        (i, *expected[(i, t)], i == expected[(i, t)][1]) for i, t in rows if i is not None
    )
    nameless = sorted(((r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is None), key=repr)
    assert nameless == sorted(((*expected[(i, t)], expected[(i, t)][1] is None) for i, t in rows if i is None), key=repr)


def test_group_of_near_copies_is_one_component(spark):
    """Many texts that differ from their base in other places each; with a base of J < 0.8 to some of them."""
    rng = random.Random(1)
    base = [f"b{n}" for n in range(120)]
    rows = []
    for i in range(150):
        copy = list(base)
        for n in rng.sample(range(120), rng.randrange(1, 12)):
            copy[n] = f"x{i}-{n}"
        rows.append((i, " ".join(copy)))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    expected = brute_force(rows, 2)
    assert {r.doc_id: r.component_id for r in found} == {i: expected[(i, t)][1] for i, t in rows}


def test_empty_table(spark):
    found = near_duplicates(spark.createDataFrame([], "doc_id long, text string"))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"] and found.count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_bitmaps_lose_no_link(spark, seed):
    """Pairs that reach the similarity always pass; of pairs far from it hardly any do."""
    rng = np.random.default_rng(seed)
    sets, pairs, links, far = [], [], set(), set()
    for n in range(120):
        size = int(rng.integers(1, 900))
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        b = np.concatenate((a[: int(size * rng.choice([0.2, 0.85, 0.9, 0.95, 1]))], rng.integers(0, 1 << 63, int(size * rng.choice([0, 0.05, 0.1, 3])), dtype=np.uint64)))
        for i, x in ((2 * n, a), (2 * n + 1, b)):
            sets.append((i, bytearray(np.unique(x).tobytes())))
        pairs.append((2 * n, 2 * n + 1))
        common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        links |= {n} if 100 * common >= 80 * union and common else set()
        far |= {n} if 100 * common < 40 * union and size > 200 else set()
    bits = bitmaps(spark.createDataFrame(sets, "id long, shingles binary").repartition(3))
    found = {r.a // 2 for r in possible(spark.createDataFrame(pairs, "a long, b long"), bits, 80).collect()}
    assert links and links <= found and far and not far & found


def test_components_after_more_links(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)]
    frame = lambda some: spark.createDataFrame(some, "a long, b long")
    scratch = Scratch(spark, "t")
    groups = components(frame(edges[:20]), scratch)
    groups = joined_components(groups, frame(edges[20:35]), frame(edges[:20]), scratch, "more")
    groups = joined_components(groups, frame(edges[35:]), frame(edges[:35]), scratch, "most")
    assert sorted(map(tuple, groups.collect())) == sorted(map(tuple, components(frame(edges), scratch).collect()))
    none = joined_components(groups, frame(edges).limit(0), frame(edges), scratch, "none")
    assert sorted(map(tuple, none.collect())) == sorted(map(tuple, groups.collect()))


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (3, 2), (20, 30), (30, 40), (40, 50), (50, 60), (60, 21)]
    star = [(100, n) for n in range(101, 160)]
    frame = spark.createDataFrame(edges + star, "a long, b long")
    found = {r.id: r.component for r in components(frame, Scratch(spark, "t")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7} | dict.fromkeys((20, 21, 30, 40, 50, 60), 20) | dict.fromkeys(range(100, 160), 100)


def test_texts_are_open_for_partners_that_share_enough(spark):
    rows, token = [], 0

    def listed(*ids, component=None):
        nonlocal token
        token += 1
        rows.extend((token, i, 100, component or i, len(ids)) for i in ids)

    for partner in (2, 3, 4):  # three lists with three partners: no pair
        listed(1, partner)
    for _ in range(3):
        listed(11, 12)
        listed(21, 22, component=21)  # linked already
    for _ in range(2):
        listed(31, 32)
    listed(31, *range(200, 200 + SHORT))  # not with 32, but a long list isn't spelled out
    for _ in range(2):
        listed(*range(300, 300 + SHORT + 1))
    members = spark.createDataFrame(rows, "token long, id long, n long, component long, c long")
    assert {r.id for r in _open(members, 80).collect()} == {11, 12, 31}


def test_sets_are_built_where_the_texts_are(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "other words here"), (2, "e f g h"), (3, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    own = {r.id: r.d1 for r in profiles(docs.where("text like '% % % %'"), "doc_id", "text", 2).where("id is not null").collect()}
    wanted = spark.createDataFrame([(i, own[i]) for i in (1, 2)], "id long, d1 long")
    sets = _shingle_sets(docs, "doc_id", "text", 2, wanted)
    assert "Exchange" not in sets._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, len(r.shingles) // 8) for r in sets.collect()) == [(1, 3), (2, 3)]
