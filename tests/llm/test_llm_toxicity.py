"""Weak supervision: parts against brute force, the whole by held-out accuracy."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailoom.llm.toxicity import LabelModel, LinearModel, Voters, expected_counts, fit_linear, label_model, mined_voters, put_to_the_vote, terms, toxicity_scores, train
from retailoom.llm.store import Scratch

SCHEMA = "doc_id long, text string, y int, score string, p double, term string"
RUDE = [f"rude{c}{d}" for c in "abcd" for d in "xyz"]


def corpus(rows, seed=1, toxic=0.2):
    """Rows of made-up words; toxic ones hold a few rude ones at any place."""
    rng = random.Random(seed)
    common = ["".join(rng.choice("aeioklmnrst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    out = []
    for n in range(rows):
        words = [rng.choice(common) for _ in range(rng.randint(5, 120))]
        bad = rng.random() < toxic
        for _ in range(rng.randint(2, 6) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(RUDE).upper() if rng.random() < 0.3 else rng.choice(RUDE))
        out.append((n, " ".join(words), int(bad)))
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([(i, t, 5, "x", 0.5, "z") for i, t, _ in rows], SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2], "doc_id long, toxic int")
    return rows, docs, labels


def test_terms():
    assert terms("Ab ab, ABCDE abcdx 12") == Counter({"ab": 1, "abcde": 1, "abcdx": 1, "abcd*": 2})
    assert terms("") == Counter() and set(terms("a" * 100)) == {"a" * k + "*" for k in range(4, 9)}


def test_votes():
    voters = Voters(["abcd*", "ab", "zz"])

    def fired(text):
        return np.unpackbits(np.frombuffer(voters.votes(text), np.uint8))[:3].tolist()

    assert fired("") == [0, 0, 0]
    assert fired("ab AB zz") == [0, 1, 1]
    assert fired("abcde abcde") == [0, 0, 0]  # one word twice
    assert fired("abcde ABCDX") == [1, 0, 0]


def test_posterior_is_that_of_the_tree():
    """Against the sum over both labels of the product of all chances."""
    rng = np.random.default_rng(2)
    parents = [-1, 0, 0, 2]
    model = LabelModel(0.3, (0.9, 0.8), parents, rng.uniform(0.05, 0.95, (2, 4, 2)))
    for fired in itertools.product((0, 1), repeat=4):
        for given in (-1, 0, 1):
            joint = []
            for y in (0, 1):
                p = 0.3 if y else 0.7
                for v, u in enumerate(parents):
                    c = model.chances[y, v, fired[u] if u >= 0 else 0]
                    p *= c if fired[v] else 1 - c
                if given >= 0:
                    p *= model.trust[y] if given == y else 1 - model.trust[y]
                joint.append(p)
            found = model.posterior(np.array([fired], float), np.array([given]))[0]
            assert math.isclose(found, joint[1] / sum(joint), rel_tol=1e-9)


def test_expected_counts_against_loops(spark):
    rng = np.random.default_rng(4)
    rows = [(bytes(np.packbits(rng.random(11) < 0.3)), int(rng.integers(-1, 2)), int(rng.integers(1, 9))) for _ in range(60)]
    ballots = spark.createDataFrame(rows, "votes binary, given int, n long").repartition(4)
    model = LabelModel(0.3, (0.9, 0.8), [-1, *range(10)], rng.uniform(0.05, 0.95, (2, 11, 2)))
    for m in (None, model):
        weight, pairs, labels = np.zeros(2), np.zeros((2, 11, 11)), np.zeros((2, 2))
        for votes, given, n in rows:
            fired = np.unpackbits(np.frombuffer(votes, np.uint8))[:11].astype(float)
            if m is None:
                p, n = max(given, 0), n * (given >= 0)
            else:
                p = m.posterior(fired[None], np.array([given]))[0]
            for y, q in ((0, 1 - p), (1, p)):
                weight[y] += q * n
                pairs[y] += q * n * np.outer(fired, fired)
                if given >= 0:
                    labels[y, given] += q * n
        for found, want in zip(expected_counts(ballots, 11, m), (weight, pairs, labels), strict=True):
            assert np.allclose(found, want)


def test_label_model_tells_accurate_voters_from_copies(spark):
    """Voter 1 repeats voter 0, voter 2 is as good and on its own: the copy hangs on its original and adds nothing."""
    rng = random.Random(3)
    rows = []
    for _ in range(6000):
        y = rng.random() < 0.3
        a = rng.random() < (0.8 if y else 0.1)
        c, d = (rng.random() < (0.8 if y else 0.1) for _ in range(2))
        rows.append((bytes(np.packbits([a, a, c, d])), int(y) if rng.random() < 0.1 else -1, 1))
    model = label_model(spark.createDataFrame(rows, "votes binary, given int, n long"), 4)
    assert 1 in [u for v, u in enumerate(model.parents) if v == 0] or 0 in [u for v, u in enumerate(model.parents) if v == 1]
    assert abs(model.prior - 0.3) < 0.04
    one, both = model.posterior(np.array([[1.0, 1, 0, 0], [1, 1, 1, 0]]), np.array([-1, -1]))
    assert abs(one - 0.3 * 0.8 * 0.04 / (0.3 * 0.8 * 0.04 + 0.7 * 0.1 * 0.81)) < 0.06
    assert both > one


def test_fit_linear_is_the_optimum():
    rng = np.random.default_rng(1)
    dense = (rng.random((80, 6)) < 0.4) * rng.integers(1, 4, (80, 6))
    target = np.clip((dense[:, 0] > 0) * 0.9 + rng.random(80) * 0.1, 0, 1)
    rows, columns = np.nonzero(dense)
    w, b = fit_linear(rows, columns, dense[rows, columns].astype(float), target, 6)
    say = np.where(target >= 0.5, 0.5 / (target >= 0.5).sum(), 0.5 / (target < 0.5).sum()) * 80
    scale = np.sqrt(np.maximum((dense**2 * say[:, None]).sum(axis=0), 1))
    error = (1 / (1 + np.exp(-(dense @ w + b))) - target) * say
    assert np.abs((dense / scale).T @ error + w * scale / 80).max() < 1e-3 and abs(error.sum()) < 1e-3


def test_margin_adds_up_terms():
    rng = random.Random(0)
    model = LinearModel({t: rng.uniform(-1, 1) for t in ("abcd*", "abcde*", "abcdef", "xy", "xyz")}, 0.25)
    for text in ("", "xy XY xyz", "abcdef abcdeg abcd", "a" * 200, "xy " * 1000):
        want = 0.25 + sum(model.weights.get(t, 0.0) * n for t, n in terms(text).items())
        assert math.isclose(model.margin(text), want)
        assert math.isclose(model.margin(text), want)  # remembered words


def test_voters_are_words_that_tell(spark, data):
    _, docs, labels = data
    drawn = {r.doc_id: r.toxic for r in labels.collect()}
    chosen = mined_voters(docs, drawn, "doc_id", "text", 64, Scratch(spark, "test")).chosen
    assert set(RUDE) & set(chosen) and all("rude".startswith(t[:4]) for t in chosen)
    votes = put_to_the_vote(docs, Voters(chosen), drawn, "doc_id", "text")
    assert votes.count() == docs.count() and votes.where("given >= 0").count() == len(drawn)


def test_held_out_rows_are_told(data):
    rows, docs, labels = data
    scores = {r.doc_id: r.score for r in toxicity_scores(docs, train(docs, labels)).collect()}
    assert set(scores) == {i for i, _, _ in rows} and all(0 <= s <= 1 for s in scores.values())
    held = [(scores[i] >= 0.5, y) for i, _, y in rows if i % 2 == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.99


def test_wrong_labels_are_outvoted(spark, data):
    rows, docs, _ = data
    rng = random.Random(9)
    labels = spark.createDataFrame([(i, y ^ (rng.random() < 0.05)) for i, _, y in rows if i % 2], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity_scores(docs, train(docs, labels)).collect()}
    assert sum((scores[i] >= 0.5) == y for i, _, y in rows) / len(rows) > 0.98


def test_same_result_in_any_order(data):
    _, docs, labels = data
    one, two = train(docs, labels), train(docs.repartition(7).orderBy(F.rand(3)), labels.repartition(3))
    assert set(one.weights) == set(two.weights) and math.isclose(one.bias, two.bias, rel_tol=1e-4)


def test_odd_rows(spark, data):
    rows, _, _ = data
    some = [(i, t) for i, t, _ in rows[:600]] + [(None, None), (None, "rudeax rudeby rudecz"), (7, ""), (7, "rudeax"), (3000, "kilo " * 200_000), (3001, "a" * 1_000_000), (3002, "\0 12 !!")]
    docs = spark.createDataFrame([(i, t, 5, "x", 0.5, "z") for i, t in some], SCHEMA)
    labels = [(i, y) for i, _, y in rows[:600]] + [(None, 1), (8, None), (9, 0), (9, 1), (10, 5)]
    model = train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = toxicity_scores(docs, model).collect()
    assert len(found) == len(some)
    assert all(math.isclose(r.score, model.score("")) for r in found if r.doc_id in (3001, 3002))


def test_without_labels_every_score_is_the_share(spark, data):
    _, docs, labels = data
    for some, share in ((labels.limit(0), 0.5), (labels.where("toxic = 0").limit(9), 0.5 / 10)):
        scores = toxicity_scores(docs.limit(20), train(docs, some)).collect()
        assert len(scores) == 20 and all(math.isclose(r.score, share) for r in scores)
    empty = docs.limit(0)
    assert toxicity_scores(empty, train(empty, labels)).count() == 0
