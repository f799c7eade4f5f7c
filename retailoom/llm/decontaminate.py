"""Benchmark decontamination by winnowing.

Of every run of ``GRAM`` words a hash is taken, and of every window of consecutive hashes the smallest is kept, on both
sides. A passage of ``window`` words or more that a document shares with an item therefore has a kept hash in common
with it. Kept hashes of documents pass a filter of fixed size made from those of the items, meet them in a join, and
each hit is extended word by word in both directions.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import Scratch, bitmap, in_bitmap
from retailoom.llm.text import ALNUM, U64, grams, mix, signed, text_slices, words

GRAM = 5
FILTER_BITS = 1 << 23


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum or maximum of each ``width`` neighbours, by doubling."""
    pick = np.minimum if least else np.maximum
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[:-step], x[step:])
        done += step
    return x


def winnowed(hashes: np.ndarray, begins: np.ndarray, span: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) that winnowing keeps for shared passages of ``span`` words, in the marked rows.

    Every window of ``span`` words inside a row keeps its smallest hash (each place of it), and nothing else is kept.
    """
    k = min(GRAM, span)
    w = span - k + 1
    n = len(hashes)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    gram = grams(hashes, k) | U64(1)
    least = _slide(gram, w, least=True)
    lengths = np.diff(begins)
    ends = np.repeat(np.where(rows, begins[1:], 0), lengths)
    least[ends[: len(least)] < np.arange(span, span + len(least))] = 0  # windows across rows
    edge = np.zeros(w - 1, U64)
    held = _slide(np.concatenate((edge, least, edge)), w, least=False)
    at = np.flatnonzero(held == gram)
    return at, mix(gram[at] + U64(span))


def _around(hashes: np.ndarray, begins: np.ndarray, at: np.ndarray, reach: int, blank: int) -> np.ndarray:
    """Word hashes from ``reach - 1`` before to ``reach`` after each position; ``blank`` outside of the row."""
    row = np.searchsorted(begins, at, side="right") - 1
    places = at[:, None] + np.arange(1 - reach, reach + 1)[None, :]
    outside = (places < begins[row][:, None]) | (places >= begins[row + 1][:, None])
    places[outside] = 0
    out = hashes[places]
    out[outside] = blank
    return out


def _kept(batch: pa.RecordBatch, spans: list[int], window: int, item: bool, wanted: np.ndarray | None):
    """Kept hashes of (id, key, text) rows: batches of (id, key, n_words, fp, at, around), and a row per text without fp."""
    for first, last, data, offsets in text_slices(batch.column(2)):
        hashes, begins = words(data, offsets, ALNUM)
        lengths = np.diff(begins)
        ids, keys = batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first)
        nothing = pa.nulls(last - first, pa.int64())
        yield pa.record_batch(
            [ids, keys, pa.array(lengths), nothing, nothing, pa.nulls(last - first, pa.binary())],
            ["id", "key", "n_words", "fp", "at", "around"],
        )
        for span in spans:
            rows = (lengths == span) | (span == window) & (lengths >= span) if item else lengths >= span
            at, fp = winnowed(hashes, begins, span, rows)
            if wanted is not None and len(at):
                passed = in_bitmap(wanted, signed(fp))
                at, fp = at[passed], fp[passed]
            if not len(at):
                continue
            row = np.searchsorted(begins, at, side="right") - 1
            near = _around(hashes, begins, at, window, int(item))
            raw, width = near.tobytes(), 16 * window
            yield pa.record_batch(
                [
                    ids.take(pa.array(row)),
                    keys.take(pa.array(row)),
                    pa.array(lengths[row]),
                    pa.array(signed(fp)),
                    pa.array(at - begins[row]),
                    pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary()),
                ],
                ["id", "key", "n_words", "fp", "at", "around"],
            )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    window: int = 13,
    share: int = 20,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, text_key) of each document.

    Words are runs of ASCII digits, letters and all other than ASCII characters, A-Z lower-cased. A window is any
    ``window`` consecutive words of an item; an item with fewer words is one window. A word is hit if it is inside an
    occurrence of a window; a document is contaminated if n_hit > 0 and share * n_hit >= n_words.

    Null and empty texts have no words, on both sides. Equal rows (same id, same text) give one row; rows that share an
    id but not their text give one each, told apart by text_key (xxhash64 of the text). Repeated items count once by id,
    items without an id hit words but are not listed. Empty tables are allowed on both sides.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    schema = "id long, key long, n_words long, fp long, at long, around binary"
    every_span = list(range(1, window + 1))

    def of_items(batches):
        for batch in batches:
            yield from _kept(batch, every_span, window, True, None)

    items = benchmark.select(F.col(item_id_column).cast("long").alias("id"), F.lit(0).cast("long").alias("key"), F.col(item_text_column).alias("text"))
    items = scratch.settle(items.mapInArrow(of_items, schema), "items")
    # an item of n words is looked for by windows of min(n, window) words: no more lengths than that
    lengths = items.where("fp is null and n_words > 0").select(F.least("n_words", F.lit(window)).alias("n")).distinct()
    spans = sorted(row.n for row in lengths.collect())
    items = items.where("fp is not null").select("fp", F.col("id").alias("item"), F.least("n_words", F.lit(window)).alias("span"), F.col("around").alias("theirs"))
    wanted = bitmap(items, F.col("fp"), filter_bits)

    def of_docs(batches):
        for batch in batches:
            yield from _kept(batch, spans, window, False, wanted)

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(F.col(text_column)).alias("key"), F.col(text_column).alias("text"))
    rows = scratch.settle(rows.mapInArrow(of_docs, schema), "documents")

    def extend(batches):
        width = 2 * window
        for batch in batches:
            mine, theirs = (np.frombuffer(b"".join(batch.column(i).to_pylist()), U64).reshape(-1, width) for i in (5, 6))
            same = mine == theirs
            left = np.logical_and.accumulate(same[:, window - 2 :: -1] if window > 1 else same[:, :0], axis=1).sum(axis=1)
            right = np.logical_and.accumulate(same[:, window - 1 :], axis=1).sum(axis=1)
            at, span = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 4))
            hit = pa.array((left + right >= span) & (right > 0))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(at - left), pa.array(at + right)],
                ["id", "key", "item", "start", "stop"],
            ).filter(hit)

    met = rows.where("fp is not null").join(items, "fp").select("id", "key", "at", "item", "span", "around", "theirs")
    found = met.mapInArrow(extend, "id long, key long, item long, start long, stop long")
    found = found.select("id", "key", F.lit(None).cast("long").alias("n_words"), "item", F.struct("start", "stop").alias("span"))
    texts = rows.where("fp is null").select("id", "key", "n_words", F.lit(None).cast("long").alias("item"), F.lit(None).cast("struct<start:long,stop:long>").alias("span"))
    # a group holds the spans of one text: at most a few per word of it
    per_text = texts.unionByName(found).groupBy("id", "key").agg(
        F.max("n_words").alias("n_words"), F.collect_set("item").alias("items"), F.collect_set("span").alias("spans")
    )
    hit = F.expr(
        "aggregate(array_sort(spans), named_struct('n', 0L, 'upto', 0L), (a, x) -> named_struct("
        "'n', a.n + greatest(0L, x.stop - greatest(x.start, a.upto)), 'upto', greatest(a.upto, x.stop)), a -> a.n)"
    )
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return per_text.select("id", "key", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256")).select(
        F.col("id").alias(id_column),
        "n_words",
        "n_hit",
        "n_items",
        "items_sha256",
        F.expr(f"n_hit > 0 and {share} * n_hit >= n_words").alias("contaminated"),
        F.col("key").alias("text_key"),
    )
