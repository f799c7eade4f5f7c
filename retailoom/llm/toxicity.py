"""Toxicity by weak supervision.

1. Voters. Terms of a text are its words, and the beginnings of its words with the number of different words that share
   them. From a bounded sample of labelled rows the terms that best tell the labels apart become voters: lexicon voters
   fire on a word, pattern voters on a beginning that several words share.
2. Label model. Every text of the corpus is put to the vote. Firings are generated by a hidden label: P(label), and for
   each voter the chance to fire given the label and what one other voter, its parent, does. The parents form a tree
   of the strongest dependences given the label (Chow and Liu), which keeps voters that say the same thing from counting
   twice. A known label is a voter, too, with an accuracy of its own, so single wrong labels are outvoted. Expectation
   maximisation over all texts, by one aggregation a step, estimates accuracies and dependences.
3. Classifier. The posterior labels of a bounded sample of texts train a linear classifier (logistic, ridge) over
   words and beginnings, which also knows terms that no voter looks at. It alone makes the score.
"""

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import Scratch, bounded_batches

#: labelled rows of either label that voters are mined from at most
SAMPLE = 3000
#: texts of either posterior label that the classifier is trained on at most
TRAINING = 2000
VOTERS = 128
FEATURES = 4096
STEPS = 4
#: code points of the beginnings of words that count as patterns, and different words that make a pattern voter fire
BEGINNINGS = range(4, 9)
SHARED = 2
#: prior of a voter's chances, in texts
SMOOTHING = 0.5
#: how often a given label is right before anything is known, and how many texts that belief weighs
LABEL_TRUST, LABEL_WEIGHT = 0.97, 100.0
RIDGE = 1.0

_WORD = re.compile(r"[^\W\d_]+")
LONGEST = 64  # longer words only count by their beginnings
KNOWN = 200_000  # words whose weight a task remembers


def beginnings(word: str) -> list[str]:
    return [f"{word[:k]}*" for k in BEGINNINGS if k < len(word)]


def terms(text: str) -> Counter:
    """Words (1 each) and beginnings (how many different words have them) of a text, without regard to case."""
    found = set(_WORD.findall(text.lower()))
    out = Counter({w: 1 for w in found if len(w) <= LONGEST})
    out.update(itertools.chain.from_iterable(map(beginnings, found)))
    return out


def fires(term: str, count: int) -> bool:
    return count >= SHARED if term.endswith("*") else count > 0


def _texts(column: pa.Array) -> Iterator[str]:
    for raw in column.cast(pa.large_binary()):
        yield (raw.as_py() or b"").decode("utf-8", "replace")


class Voters:
    """Which terms vote. Votes of a text are a bit string, one bit per voter."""

    def __init__(self, chosen: list[str]):
        self.chosen = chosen
        self.place = {term: n for n, term in enumerate(chosen)}
        self.lengths = sorted({len(t) - 1 for t in chosen if t.endswith("*")})

    def votes(self, text: str) -> bytes:
        found = set(_WORD.findall(text.lower()))
        fired = np.zeros(len(self.chosen), bool)
        shared: Counter = Counter()
        for word in found:
            at = self.place.get(word)
            if at is not None:
                fired[at] = True
            for k in self.lengths:
                if k < len(word):
                    at = self.place.get(word[:k] + "*")
                    if at is not None:
                        shared[at] += 1
        for at, n in shared.items():
            fired[at] = n >= SHARED
        return np.packbits(fired).tobytes()


def _unpacked(column: pa.Array, voters: int) -> np.ndarray:
    width = -(-voters // 8)
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)
    return np.unpackbits(raw, axis=1)[:, :voters].astype(np.float64)


class LabelModel:
    """P(label), how right given labels are, and a tree of voters with their chances to fire."""

    def __init__(self, prior: float, trust: tuple[float, float], parents: list[int], chances: np.ndarray):
        self.prior, self.trust, self.parents = prior, trust, parents
        self.chances = chances  # [label, voter, does the parent fire]

    @classmethod
    def estimated(cls, weight: np.ndarray, pairs: np.ndarray, labels: np.ndarray) -> "LabelModel":
        """From expected counts: texts by label, texts by label in which two voters fire, texts by label and given label."""
        total = weight.sum()
        prior = (weight[1] + SMOOTHING) / (total + 2 * SMOOTHING)
        trust = tuple(float((labels[y, y] + LABEL_TRUST * LABEL_WEIGHT) / (labels[y].sum() + LABEL_WEIGHT)) for y in (0, 1))
        single = np.stack([np.diag(p) for p in pairs])
        parents = _tree(weight, single, pairs)
        chances = np.zeros((2, single.shape[1], 2))
        for v, u in enumerate(parents):
            for y in (0, 1):
                # the chance without regard to the parent is the prior of the two with regard to it
                base = (single[y, v] + SMOOTHING * single[:, v].sum() / max(total, 1.0)) / (weight[y] + SMOOTHING)
                base = min(max(base, 1e-6), 1 - 1e-6)
                both, alone = (pairs[y, v, u], single[y, u]) if u >= 0 else (0.0, 0.0)
                chances[y, v, 1] = (both + base * 2 * SMOOTHING) / (alone + 2 * SMOOTHING)
                chances[y, v, 0] = (single[y, v] - both + base * 2 * SMOOTHING) / (weight[y] - alone + 2 * SMOOTHING)
        return cls(float(prior), trust, parents, np.clip(chances, 1e-6, 1 - 1e-6))

    def posterior(self, fired: np.ndarray, given: np.ndarray) -> np.ndarray:
        """P(label 1) of rows of firings; given: the known label, -1 if there is none."""
        odds = np.full(len(fired), math.log(self.prior / (1 - self.prior)))
        if len(self.parents):
            parents = np.array(self.parents)
            above = np.where(parents >= 0, fired[:, np.maximum(parents, 0)], 0).astype(np.int64)
            at = np.arange(fired.shape[1])
            p0, p1 = self.chances[0][at, above], self.chances[1][at, above]
            odds += np.where(fired > 0, np.log(p1 / p0), np.log((1 - p1) / (1 - p0))).sum(axis=1)
        odds += np.where(given == 1, math.log(self.trust[1] / (1 - self.trust[0])), 0.0)
        odds += np.where(given == 0, math.log((1 - self.trust[1]) / self.trust[0]), 0.0)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _tree(weight: np.ndarray, single: np.ndarray, pairs: np.ndarray) -> list[int]:
    """Parent of each voter (-1: none) in the spanning tree of the greatest information about each other given the label."""
    voters = single.shape[1]
    if not voters:
        return []
    information = np.zeros((voters, voters))
    for y in (0, 1):
        n = weight[y] + 4 * SMOOTHING
        one = (single[y] + 2 * SMOOTHING) / n
        both = (pairs[y] + SMOOTHING) / n
        for a, b in itertools.product((0, 1), repeat=2):
            joint = both if a and b else one[:, None] - both if a else one[None, :] - both if b else 1 - one[:, None] - one[None, :] + both
            apart = (one if a else 1 - one)[:, None] * (one if b else 1 - one)[None, :]
            joint = np.clip(joint, 1e-12, 1)
            information += weight[y] / weight.sum() * joint * np.log(joint / np.clip(apart, 1e-12, 1))
    parents = [-1] * voters
    inside = np.zeros(voters, bool)
    inside[0] = True
    best, of = information[0].copy(), np.zeros(voters, np.int64)
    for _ in range(voters - 1):
        v = int(np.where(inside, -np.inf, best).argmax())
        parents[v] = int(of[v])
        inside[v] = True
        closer = information[v] > best
        best, of = np.where(closer, information[v], best), np.where(closer, v, of)
    return parents


def clean_labels(labels: DataFrame, id_column: str, label_column: str) -> DataFrame:
    """(id, y): labels 0 or 1 of ids that carry only one of them."""
    known = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    return known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").select("id", "y")


def _drawn(known: DataFrame, sample: int, seed: int) -> dict[int, int]:
    """At most ``sample`` ids of either label, those with the smallest hash."""
    some = [known.where(F.col("y") == y).orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample) for y in (0, 1)]
    return {row.id: row.y for row in some[0].unionByName(some[1]).collect()}


def _g2(with_1: str, with_0: str, all_1: float, all_0: float):
    """How far a term's share of texts differs between the labels (log likelihood ratio), as a column."""
    a, b = F.col(with_1), F.col(with_0)
    c, d = F.lit(all_1) - a, F.lit(all_0) - b
    total = all_1 + all_0

    def part(seen, row, column):
        return F.when(seen > 0, seen * F.log(seen * F.lit(total) / (row * column))).otherwise(0.0)

    return part(a, a + b, F.lit(all_1)) + part(b, a + b, F.lit(all_0)) + part(c, c + d, F.lit(all_1)) + part(d, c + d, F.lit(all_0))


def _telling(counted: DataFrame, all_1: float, all_0: float, most: int, tested: int) -> list[str]:
    """The terms of (term, n1, n0) that differ most between the labels, in order of the alphabet, ``most`` at most.

    A term must differ by more than the best of as many terms as were tested would by chance: chance exceeds a log
    likelihood ratio of g once in about exp(g) terms.
    """
    judged = counted.select("term", _g2("n1", "n0", all_1, all_0).alias("g")).where(F.col("g") > math.log(max(tested, 1)))
    return sorted(row.term for row in judged.orderBy(F.desc("g"), "term").limit(most).collect())


def mined_voters(docs: DataFrame, drawn: dict[int, int], id_column: str, text_column: str, voters: int, scratch: Scratch) -> Voters:
    """The terms that best tell the labels of the drawn rows apart; of terms of the very same rows one is taken.

    An id with several rows counts once for a term. Only rows with a drawn id leave the scan.
    """
    spark = docs.sparkSession
    if not drawn:
        return Voters([])
    names = spark.createDataFrame(list(drawn.items()), "id long, y int")  # bounded by the sample

    def fired_terms(batches):
        for batch in batches:
            ids, ys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in enumerate(_texts(batch.column(2))):
                some = [t for t, n in terms(text).items() if fires(t, n)]
                for first in range(0, len(some), 50_000):
                    part = some[first : first + 50_000]
                    yield pa.record_batch([pa.array([ids[i]] * len(part), pa.int64()), pa.array([ys[i]] * len(part), pa.int32()), pa.array(part)], ["id", "y", "term"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.join(F.broadcast(names), "id").select("id", "y", "text")
    counted = rows.mapInArrow(fired_terms, "id long, y int, term string").distinct().groupBy("term")
    # rows of a term as the sum of their hashes: terms of the very same rows are told by it
    counted = counted.agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("rows"))
    counted = counted.where("n1 + n0 > 1").groupBy("rows", "n1", "n0").agg(F.min("term").alias("term"))
    counted = scratch.settle(counted, "mined")
    all_1 = float(sum(drawn.values()))
    return Voters(_telling(counted, all_1, len(drawn) - all_1, voters, counted.count()))


def put_to_the_vote(docs: DataFrame, voters: Voters, drawn: dict[int, int], id_column: str, text_column: str) -> DataFrame:
    """(text_key, votes, given) of every row; given is the drawn label of its id, else -1."""

    def vote(batches):
        for batch in batches:
            given = [drawn.get(i, -1) if i is not None else -1 for i in batch.column(0).to_pylist()]
            votes = [voters.votes(text) for text in _texts(batch.column(2))]
            yield pa.record_batch([batch.column(1), pa.array(votes, pa.binary()), pa.array(given, pa.int32())], ["text_key", "votes", "given"])

    text = F.col(text_column).cast("string")
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(vote, "text_key long, votes binary, given int")


def expected_counts(ballots: DataFrame, voters: int, model: LabelModel | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts by label, texts by label in which two voters fire, and given labels by label, as the model expects them.

    ``ballots`` (votes, given, n) count equal votes. Without a model only rows with a given label count, as labelled.
    """

    def count(batches):
        weight, pairs, labels = np.zeros(2), np.zeros((2, voters, voters)), np.zeros((2, 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            fired = _unpacked(batch.column(0), voters)
            given, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            p1 = np.where(given < 0, 0, given) if model is None else model.posterior(fired, given)
            n = n * (given >= 0) if model is None else n
            for y, p in ((0, 1 - p1), (1, p1)):
                w = p * n
                weight[y] += w.sum()
                pairs[y] += (fired * w[:, None]).T @ fired
                for g in (0, 1):
                    labels[y, g] += w[given == g].sum()
        flat = np.concatenate((weight, labels.ravel(), pairs.ravel()))
        at = np.flatnonzero(flat)
        yield pa.record_batch([pa.array(at), pa.array(flat[at])], ["at", "x"])

    sums = ballots.select("votes", "given", "n").mapInArrow(count, "at long, x double").groupBy("at").agg(F.sum("x").alias("x"))
    flat = np.zeros(6 + 2 * voters * voters)
    for at, x in sums.collect():  # two numbers for each pair of voters at most
        flat[at] = x
    return flat[:2], flat[6:].reshape(2, voters, voters), flat[2:6].reshape(2, 2)


def label_model(ballots: DataFrame, voters: int, steps: int = STEPS) -> LabelModel:
    """Fitted over all ballots, starting from the rows with a given label."""
    model = LabelModel.estimated(*expected_counts(ballots, voters, None))
    for _ in range(steps):
        model = LabelModel.estimated(*expected_counts(ballots, voters, model))
    return model


class LinearModel:
    """Weights of terms and a bias; of bounded size, so it travels inside the functions of tasks."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self._known: dict[str, float] = {}

    def margin(self, text: str) -> float:
        # a word adds its own weight and those of its beginnings, so a text adds up its different words
        known, weights, total = self._known, self.weights, self.bias
        for word in set(_WORD.findall(text.lower())):
            add = known.get(word)
            if add is None:
                add = weights.get(word, 0.0) + sum(weights.get(b, 0.0) for b in beginnings(word))
                if len(known) < KNOWN and len(word) <= LONGEST:
                    known[word] = add
            total += add
        return total

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.margin(text)))))


def fit_linear(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, width: int, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model of soft targets over sparse rows, by accelerated gradient steps."""
    n = len(target)
    # equal say for both labels; the caller moves the bias back to the corpus' share
    say = np.where(target >= 0.5, 0.5 / max(1, (target >= 0.5).sum()), 0.5 / max(1, (target < 0.5).sum())) * n
    scale = np.sqrt(np.maximum(np.bincount(columns, values**2 * say[rows], width), 1.0))
    x = values / scale[columns]
    norm = np.bincount(rows, x**2 * say[rows], n).max(initial=0.0) + say.max(initial=1.0)
    # the largest eigenvalue of the curvature, by power iteration
    v = np.ones(width + 1)
    for _ in range(30):
        z = (np.bincount(rows, x * v[columns], n) + v[-1]) * say
        v = np.append(np.bincount(columns, x * z[rows], width), z.sum())
        norm = np.linalg.norm(v)
        v /= max(norm, 1e-12)
    step = 1 / (0.25 * norm * 1.1 + ridge / n)
    w, ahead, momentum = np.zeros(width + 1), np.zeros(width + 1), 1.0
    penalty = np.append(np.full(width, ridge / max(n, 1)), 0.0)
    for _ in range(1000):
        margin = np.bincount(rows, x * ahead[columns], n) + ahead[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target) * say
        slope = np.append(np.bincount(columns, x * error[rows], width), error.sum()) + penalty * ahead
        after = ahead - step * slope
        momentum, earlier = (1 + math.sqrt(1 + 4 * momentum**2)) / 2, momentum
        ahead = after + (earlier - 1) / momentum * (after - w)
        done = np.abs(after - w).max() < 1e-7
        w = after
        if done:
            break
    return w[:-1] / scale, float(w[-1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample: int = SAMPLE,
    training: int = TRAINING,
    voters: int = VOTERS,
    features: int = FEATURES,
    seed: int = 0,
) -> LinearModel:
    """Voters, label model and classifier from ``docs`` and the labels (id, 0 or 1) that may be learned from.

    At most ``sample`` labelled rows of either label are mined for voters; the label model sees the votes of all rows; the
    classifier is trained on at most ``training`` different texts of either posterior label. Those with the smallest hash
    are taken, so the result depends on the rows alone. Ids that carry both labels, null ids and null labels are left
    out. Null texts count as empty. Without labels of both kinds every score is the share of label 1 (0.5 if none).
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = clean_labels(labels, id_column, label_column)
    counts = {row.y: row.n for row in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    flat = LinearModel({}, math.log(share / (1 - share)))
    if len(counts) < 2:
        return flat
    drawn = _drawn(known, sample, seed)
    chosen = mined_voters(docs, drawn, id_column, text_column, voters, scratch)
    voters = len(chosen.chosen)
    if not voters:
        return flat
    voted = scratch.settle(put_to_the_vote(docs, chosen, drawn, id_column, text_column), "votes")
    ballots = scratch.settle(voted.groupBy("votes", "given").agg(F.count(F.lit(1)).alias("n")), "ballots")
    model = label_model(ballots, voters)

    def judge(batches):
        for batch in batches:
            if batch.num_rows:
                p = model.posterior(_unpacked(batch.column(1), voters), batch.column(2).to_numpy(zero_copy_only=False))
                yield pa.record_batch([batch.column(0), pa.array(p)], ["text_key", "p"])

    judged = voted.groupBy("text_key").agg(F.min("votes").alias("votes"), F.max("given").alias("given"))
    judged = scratch.settle(judged.select("text_key", "votes", "given").mapInArrow(judge, "text_key long, p double"), "posteriors")
    taken = [judged.where(side).orderBy(F.xxhash64("text_key", F.lit(seed)), "text_key").limit(training).collect() for side in ("p >= 0.5", "p < 0.5")]
    target = {row.text_key: row.p for some in taken for row in some}  # twice ``training`` numbers at most
    if not all(taken):
        return flat
    fitted = _fitted(docs, text_column, target, features, scratch)
    expected = expected_counts(ballots, voters, model)[0]
    # trained with equal say for both labels: back to the corpus' share of toxic texts as the label model sees it
    fitted.bias += math.log((expected[1] + 0.5) / (expected[0] + 0.5))
    return fitted


def _fitted(docs: DataFrame, text_column: str, target: dict[int, float], features: int, scratch: Scratch) -> LinearModel:
    spark = docs.sparkSession
    names = spark.createDataFrame(list(target.items()), "text_key long, p double")

    def counted_terms(batches):
        done = set()  # copies of a text in one task count once here, those of several tasks below
        for batch in batches:
            for key, p, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch.column(2)), strict=True):
                if key in done:
                    continue
                done.add(key)
                found = list(terms(text).items())
                for first in range(0, len(found), 50_000):
                    some, n = zip(*found[first : first + 50_000], strict=True)
                    yield pa.record_batch([pa.array([key] * len(n), pa.int64()), pa.array([p] * len(n), pa.float64()), pa.array(some), pa.array(n, pa.int64())], ["text_key", "p", "term", "n"])

    text = F.col(text_column).cast("string")
    rows = docs.select(F.xxhash64(text).alias("text_key"), text.alias("text")).join(F.broadcast(names), "text_key").select("text_key", "p", "text")
    found = rows.mapInArrow(counted_terms, "text_key long, p double, term string, n long")
    found = scratch.settle(found.groupBy("text_key", "p", "term").agg(F.max("n").alias("n")), "terms")
    all_1 = sum(target.values())
    counted = found.groupBy("term").agg(F.sum("p").alias("n1"), F.sum(1 - F.col("p")).alias("n0")).where("n1 + n0 > 1.5")
    counted = scratch.settle(counted, "counted")
    chosen = _telling(counted, all_1, len(target) - all_1, features, counted.count())
    place = spark.createDataFrame(list(enumerate(chosen)), "place int, term string")
    some = found.join(F.broadcast(place), "term").select("text_key", "place", "n").toArrow()  # a number for each of the texts and features at most
    keys = np.array(sorted(target), np.int64)
    row = np.searchsorted(keys, some["text_key"].to_numpy())
    weights, bias = fit_linear(row, some["place"].to_numpy(), some["n"].to_numpy().astype(float), np.array([target[k] for k in keys.tolist()]), len(chosen))
    return LinearModel({t: float(w) for t, w in zip(chosen, weights, strict=True) if w}, bias)


def toxicity_scores(docs: DataFrame, model: LinearModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) of every row, from its whole text alone; null and empty texts get the score of a text without words.

    Rows are scored one by one, so repeats, ties and null ids are no matter. Languages that don't separate words are seen
    by the beginnings of their runs of letters only.
    """
    bounded_batches(docs.sparkSession)

    def score(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([model.score(text) for text in _texts(batch.column(1))], pa.float64())], ["id", "score"])

    frame = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return frame.mapInArrow(score, "id long, score double").withColumnRenamed("id", id_column)
