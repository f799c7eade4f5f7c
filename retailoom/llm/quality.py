"""Quality classifier by compression.

Two zstandard dictionaries are built, from good and from bad labelled texts. A text is cut into blocks, each compressed
with either dictionary; the difference of the compressed sizes, divided by their sum, tells which dictionary knows the
text better. A logistic curve fitted on other labelled texts turns it into a score. Beside the difference the curve sees
how far the text shrinks at all, as text that repeats itself shrinks equally with either dictionary.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import bounded_batches

BLOCK = 512
DICT_BYTES = 112 * 1024
LEVEL = 3
SAMPLE = 3000
FOLDS = 3
HEADER = 64  # bytes added to the sum, so that the difference of a very short text stays small


class Compressors:
    """Compressed sizes of texts with the dictionaries; made in each task from the dictionaries' bytes."""

    def __init__(self, good: bytes, bad: bytes, block: int = BLOCK, level: int = LEVEL):
        self.block = block
        self.pair = [self._compressor(raw, level) for raw in (good, bad)]

    @staticmethod
    def _compressor(raw: bytes, level: int) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_AUTO)
        known.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)

    def measure(self, text: bytes) -> tuple[float, float]:
        """Normalised difference of the sizes, and the log of what is left of the text; zeros if empty."""
        if not text:
            return 0.0, 0.0
        blocks = [text[i : i + self.block] for i in range(0, len(text), self.block)]
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self.pair)
        return (bad - good) / (bad + good + HEADER), math.log((bad + good) / (2 * len(text)))


def build_dictionary(texts: list[bytes], size: int = DICT_BYTES, block: int = BLOCK) -> bytes:
    """A dictionary from blocks of texts; the blocks themselves where there are too few to train from."""
    blocks = [t[i : i + block] for t in texts for i in range(0, len(t), block)]
    if sum(map(len, blocks)) > 8 * size:
        try:
            return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass  # nothing common in them
    return b"".join(blocks)[-size:]


Curve = tuple[np.ndarray, np.ndarray, np.ndarray, float]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Curve:
    """(means, deviations, weights, bias) of P(y = 1) = 1 / (1 + exp(-(weights . (x - means) / deviations + bias)))."""
    means, deviations = x.mean(axis=0), x.std(axis=0)
    deviations[deviations == 0] = 1.0
    z = np.column_stack([(x - means) / deviations, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (y - p) - ridge * w
        curve = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return means, deviations, w[:-1], float(w[-1])


class QualityModel:
    """Dictionaries and curve; small and of bounded size, so it travels inside the functions of tasks."""

    def __init__(self, good: bytes, bad: bytes, curve: Curve):
        self.good, self.bad, self.curve = good, bad, curve

    def score(self, measures: np.ndarray) -> np.ndarray:
        means, deviations, weights, bias = self.curve
        return 1 / (1 + np.exp(-np.clip((measures - means) / deviations @ weights + bias, -30, 30)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample: int = SAMPLE,
    seed: int = 0,
) -> QualityModel:
    """Fit on labelled rows of ``labels`` (id, 0 or 1); at most ``sample`` rows of either label are read.

    The sample takes the rows with the smallest hash of their id; of several rows of an id the least text. Ids that carry both labels, null ids and null labels are
    left out. The curve is fitted on measures of each third of the sample under dictionaries made from the other two, and
    shifted back to the shares of the two labels among all rows; the dictionaries that score are made from the whole sample. Without rows of both labels every score is the share of label 1 (0.5 if there are none).
    """
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").select("id", "y")
    counts = {row.y: row.n for row in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    share = (counts.get(1, 0) + 0.5) / (total + 1)
    drawn = None
    for y in (0, 1):
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample)
        drawn = some if drawn is None else drawn.unionByName(some)
    # at most 2 * sample ids, so a broadcast is bounded
    every = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    one = every.join(F.broadcast(drawn), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    rows = one.orderBy(F.xxhash64("id", F.lit(seed)), "id").select("y", F.col("text").cast("binary").alias("text")).toArrow()
    texts = {y: [text or b"" for text in rows.filter(pc.equal(rows["y"], y))["text"].to_pylist()] for y in (0, 1)}
    del rows
    flat = (np.zeros(2), np.ones(2), np.zeros(2), float(np.log(share / (1 - share))))
    if min(sum(map(bool, texts[y])) for y in (0, 1)) < FOLDS:
        return QualityModel(b"", b"", flat)

    def dictionaries(leave_out: int | None) -> tuple[bytes, bytes]:
        some = {y: [t for n, t in enumerate(texts[y]) if n % FOLDS != leave_out] for y in (0, 1)}
        return build_dictionary(some[1]), build_dictionary(some[0])

    measures: list[tuple[float, float]] = []
    of: list[float] = []
    for fold in range(FOLDS):
        sizes = Compressors(*dictionaries(fold))
        for y in (0, 1):
            held = texts[y][fold::FOLDS]
            measures += [sizes.measure(t) for t in held]
            of += [float(y)] * len(held)
    means, deviations, weights, bias = fit_logistic(np.array(measures), np.array(of))
    bias += float(np.log(share / (1 - share)) - np.log(len(texts[1]) / len(texts[0])))
    return QualityModel(*dictionaries(None), (means, deviations, weights, bias))


def score_of(texts: pa.Array, model: QualityModel, sizes: Compressors | None) -> np.ndarray:
    """Scores of a text column; null and empty texts have measures of 0."""
    if sizes is None or not len(texts):
        return model.score(np.zeros((len(texts), 2)))
    return model.score(np.array([sizes.measure(t or b"") for t in texts.cast(pa.large_binary()).to_pylist()]))


def quality_scores(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) of every row, from its whole text alone. Rows are scored one by one, so repeats and nulls are no matter."""

    def score(batches):
        sizes = Compressors(model.good, model.bad) if model.good else None
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(score_of(batch.column(1), model, sizes))], ["id", "score"])

    frame = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return frame.mapInArrow(score, "id long, score double").withColumnRenamed("id", id_column)


def accepted_only(docs: DataFrame, model: QualityModel, least: float, text_column: str = "text") -> DataFrame:
    """The rows with a score of at least ``least``, with all their columns, filtered where they are read."""
    place = docs.columns.index(text_column)

    def keep(batches):
        sizes = Compressors(model.good, model.bad) if model.good else None
        for batch in batches:
            yield batch.filter(pa.array(score_of(batch.column(place), model, sizes) >= least))

    return docs.mapInArrow(keep, docs.schema)
