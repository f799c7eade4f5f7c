"""Benchmark decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from retailoom.llm.decontaminate import contamination, winnowed
from retailoom.llm.text import ALNUM, text_slices, words

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall((text or "").translate(UPPER))


def brute_force(text, items, window=13, share=20):
    mine = split(text)
    hit, found = set(), set()
    for item_id, item in items:
        theirs = split(item)
        n = min(window, len(theirs))
        windows = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for i in range(len(mine) - n + 1):
            if tuple(mine[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item_id)
    digest = hashlib.sha256(",".join(sorted(str(i) for i in found if i is not None)).encode()).hexdigest()
    n_items = len(found - {None})
    return len(mine), len(hit), n_items, digest, bool(hit) and share * len(hit) >= len(mine)


def case(seed, vocabulary):
    rng = random.Random(seed)
    some = [f"w{n}" for n in range(vocabulary)] + ["Ü", "été", "7"]
    items = [(n, " ".join(rng.choice(some) for _ in range(rng.choice((1, 2, 4, 5, 6, 12, 13, 14, 30))))) for n in range(25)]
    items += [(3, items[3][1]), (900, items[5][1]), (901, None), (902, "... !"), (None, items[7][1])]
    docs = []
    for n in range(60):
        text = [rng.choice(some) for _ in range(rng.choice((0, 1, 5, 40, 300)))]
        for _ in range(rng.randrange(3)):
            item = split(rng.choice(items)[1])
            cut = item[rng.randrange(3) :] if len(item) > 13 else item
            at = rng.randrange(len(text) + 1)
            text[at:at] = cut
        docs.append((n, ", ".join(text).upper() if n % 7 == 0 else " ".join(text)))
    docs += [(1000, None), (1001, ""), (1002, items[4][1] * 50), (None, items[6][1]), docs[0], docs[0], (0, "another text of the same id")]
    return docs, items


@pytest.mark.parametrize(("seed", "vocabulary"), [(1, 400), (2, 12), (3, 2)])
def test_against_brute_force(spark, seed, vocabulary):
    docs, items = case(seed, vocabulary)
    frame = spark.createDataFrame([(*d, "k", 5) for d in docs], "doc_id long, text string, key string, n_words int")
    found = contamination(frame, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, fp int"), filter_bits=1 << 10)
    rows = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect()]
    expected = {(i, t): (i, *brute_force(t, items)) for i, t in docs}
    assert sorted(rows, key=repr) == sorted(expected.values(), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(docs.limit(0), items).count() == 0
    (row,) = contamination(docs, items.limit(0)).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (3, 0, 0, False)
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_every_window_keeps_its_smallest_hash():
    import pyarrow as pa

    text = " ".join(str(random.Random(4).randrange(30)) for _ in range(200))
    ((_, _, data, offsets),) = text_slices(pa.array([text, "a b", text]))
    hashes, begins = words(data, offsets, ALNUM)
    at, _ = winnowed(hashes, begins, 13, np.array([True] * 3))
    for start in range(begins[1] - 13 + 1):
        assert ((at >= start) & (at <= start + 8)).any()
    assert not ((at >= begins[1]) & (at < begins[2])).any()
