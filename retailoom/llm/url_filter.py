"""URL filter: rules first, then a ratio of two character language models.

Both models are Markov models of variable order: the chance of a character after the ``ORDER`` characters before it is
smoothed towards that after fewer, down to none. Their counts of character runs are rows keyed by a 64-bit hash, gathered
from all URLs that the rules accept or reject, so they grow with the input. URLs are scored in blocks of bounded size,
each of which gets the counts of its own runs only. A URL without a rule is allowed if the log-likelihood difference
per character reaches a threshold, calibrated on URLs that were held out of the counts.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import Scratch, in_blocks, schema_text
from retailoom.llm.text import U64, mix, signed, text_slices

ORDER = 5
CONCENTRATION = 2.0
BINS = 4001  # of differences between -10 and 10 when the threshold is calibrated
CLASSES = ("allow", "block")
BLOCK_ROWS = 4096
BLOCK_BYTES = 1 << 18  # of addresses in a block, unless one alone is longer
HOT_SHARE = 4096  # a run that is more than this part of all runs of its length is joined by broadcast: so many a length at most
START, END = 256, 257  # stand before and after an address, unlike any byte

Rules = list[tuple[str, str, str]]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or # or the end, A-Z lower-cased. Path: from there up to ?, # or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def ruled(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path prefix) that fits; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, of_host, of_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == of_host) | F.endswith(host, F.lit("." + of_host))) & F.startswith(path, F.lit(of_path))
        rule = F.when(fits, of_host + of_path).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def run_hashes(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of 1 to order + 1 characters that end at each place of the rows of a slice, and where rows begin.

    A row's places are the start before its first byte, its bytes and the end after them.
    """
    sizes = np.diff(offsets)
    before = order + 1
    first = offsets[:-1] + np.arange(len(sizes)) * (before + 1)  # of each row, with its markers, among all
    chars = np.full(len(data) + len(sizes) * (before + 1), START, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    chars[np.arange(len(data)) + (row + 1) * before + row] = data
    chars[first + before + sizes] = END
    chars = chars.astype(U64)
    begins = np.concatenate(([0], np.cumsum(sizes + 2)))
    places = np.arange(begins[-1]) + np.repeat(first + order - begins[:-1], sizes + 2)
    value = np.zeros(len(chars), U64)
    out = np.empty((order + 1, len(places)), U64)
    for back in range(order + 1):
        value[back:] = mix(value[back:] * U64(263) + chars[: len(chars) - back] + U64(1 + 1000 * back))
        out[back] = value[places]
    return signed(out), begins


def _differences(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """(log P(row | allow) - log P(row | block)) / length of each row; ``counts`` are (2, runs) of the sorted ``keys``."""
    hashes, begins = run_hashes(data, offsets)
    at = np.minimum(np.searchsorted(keys, hashes.ravel()), max(len(keys) - 1, 0))
    known = (keys[at] == hashes.ravel()) if len(keys) else np.zeros(hashes.size, bool)
    follows = np.ones(begins[-1], bool)
    follows[begins[:-1]] = False
    places = np.flatnonzero(follows)
    logs = []
    for of_class, total in zip(counts, totals, strict=True):
        seen = (np.where(known, of_class[at], 0) if len(keys) else np.zeros(hashes.size, np.int64)).reshape(hashes.shape)
        p = (seen[0, places] + CONCENTRATION / 256) / (total + CONCENTRATION)
        for n in range(1, len(hashes)):
            p = (seen[n, places] + CONCENTRATION * p) / (seen[n - 1, places - 1] + CONCENTRATION)
        logs.append(np.log(p))
    lengths = np.diff(begins) - 1
    return np.add.reduceat(logs[0] - logs[1], begins[:-1] - np.arange(len(lengths))) / lengths


def _addresses(batch: pa.RecordBatch | pa.Table) -> pa.Array:
    """Host and path together, as bytes."""
    host, path = (batch.column(name).cast(pa.large_binary()) for name in ("host", "path"))
    if isinstance(host, pa.ChunkedArray):
        host, path = host.combine_chunks(), path.combine_chunks()
    return pc.binary_join_element_wise(host, path, pa.scalar(b"", pa.large_binary()))


def model_counts(labelled: DataFrame) -> DataFrame:
    """(run, length, allow, block): how often each run of characters occurs in all rows (host, path, verdict) of a class."""

    def count(batches):
        for batch in batches:
            allowed = np.array([v == CLASSES[0] for v in batch.column(2).to_pylist()], bool)
            for first, last, data, offsets in text_slices(_addresses(batch), BLOCK_BYTES):
                hashes, begins = run_hashes(data, offsets)
                of = np.repeat(allowed[first:last], np.diff(begins))
                for n, level in enumerate(hashes):
                    run, at = np.unique(level, return_inverse=True)
                    sums = [np.bincount(at[mask], minlength=len(run)) for mask in (of, ~of)]
                    yield pa.record_batch([pa.array(run), pa.array(np.full(len(run), n + 1, np.int32)), *map(pa.array, sums)], ["run", "length", *CLASSES])

    runs = labelled.select("host", "path", "verdict").mapInArrow(count, "run long, length int, allow long, block long")
    return runs.groupBy("run", "length").agg(*[F.sum(name).alias(name) for name in CLASSES])


def class_totals(labelled: DataFrame) -> np.ndarray:
    """How many places the rows of each class have after their start: the count of the empty run."""
    places = F.octet_length("host") + F.octet_length("path") + 1
    row = labelled.agg(*[F.coalesce(F.sum(F.when(F.col("verdict") == name, places)), F.lit(0)) for name in CLASSES]).first()
    return np.array(tuple(row), np.int64)


def counts_of_blocks(rows: DataFrame, model: DataFrame, totals: np.ndarray, scratch: Scratch) -> DataFrame:
    """(unit, run, allow, block): what the model has counted of the runs that occur in each block."""

    def needed(batches):
        for batch in batches:
            units = batch.column("unit").to_numpy()
            for first, last, data, offsets in text_slices(_addresses(batch), BLOCK_BYTES):
                hashes, begins = run_hashes(data, offsets)
                of = np.repeat(units[first:last], np.diff(begins))
                for unit in np.unique(of):
                    runs = np.unique(hashes[:, of == unit])
                    yield pa.record_batch([pa.array(np.full(len(runs), unit)), pa.array(runs)], ["unit", "run"])

    wanted = rows.select("unit", "host", "path").mapInArrow(needed, "unit long, run long").distinct()
    wanted = scratch.settle(wanted, "wanted")
    often = F.col("allow") + F.col("block") > float(totals.sum()) / HOT_SHARE
    hot = wanted.join(F.broadcast(model.where(often)), "run")
    return hot.unionByName(wanted.join(model.where(~often), "run")).select("unit", "run", *CLASSES)


def scored(rows: DataFrame, model: DataFrame, totals: np.ndarray, scratch: Scratch) -> DataFrame:
    """Adds ``difference`` to rows with host, path and unit."""

    def score(held: pa.Table, counted: pa.Table) -> pa.Table:
        keys = counted.column("run").to_numpy()
        order = np.argsort(keys)
        counts = np.stack([counted.column(name).to_numpy()[order] for name in CLASSES])
        found = np.zeros(held.num_rows)
        for first, last, data, offsets in text_slices(_addresses(held), BLOCK_BYTES):
            found[first:last] = _differences(data, offsets, keys[order], counts, totals)
        return held.append_column("difference", pa.array(found))

    counted = counts_of_blocks(rows, model, totals, scratch)
    return rows.groupBy("unit").cogroup(counted.groupBy("unit")).applyInArrow(score, schema_text(rows) + ", difference double")


def threshold(held: DataFrame) -> float:
    """The difference at which the rates of held-out URLs judged right are highest, summed over both classes."""
    at = F.least(F.greatest(F.floor((F.col("difference") + 10) * ((BINS - 1) / 20)), F.lit(0)), F.lit(BINS - 1)).cast("int")
    rows = held.groupBy(at.alias("bin"), "verdict").agg(F.count(F.lit(1)).alias("n")).collect()
    found = np.zeros((2, BINS))
    for place, verdict, n in rows:
        found[CLASSES.index(verdict), place] = n
    if not found.sum(axis=1).all():
        return 0.0
    allowed, blocked = (h / h.sum() for h in found)
    right = np.concatenate(([0], np.cumsum(blocked))) + 1 - np.concatenate(([0], np.cumsum(allowed)))
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 * 20 / (BINS - 1) - 10)


def judged_urls(pages: DataFrame, rules: Rules, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, difference) of every row.

    The models see host and path of distinct URLs, so a URL counts once however many pages have it. A fifth of the ruled
    URLs, by hash, is held out for the threshold. Null URLs and such without :// have an empty host and path; they are
    judged like any other, by the models unless a rule fits. If the rules accept none or reject none of the URLs, the
    threshold is 0 and both models are as far as they were learned (uniform without any URL: difference 0, allowed).
    Rows are judged one by one: repeats come out repeated. The difference is null for rows with a rule.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = host_and_path(F.col(url_column).cast("string"))
    rows = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    known = scratch.settle(rows.where("verdict is not null").select("host", "path", "verdict").distinct(), "known")
    held = F.pmod(F.xxhash64(F.concat("host", "path")), F.lit(5)) == 0
    learned = known.where(~held)
    totals = class_totals(learned)
    model = scratch.settle(model_counts(learned), "model")
    unsure = rows.where("verdict is null").select("id", "host", "path", "verdict")
    nobody = F.lit(None).cast(rows.schema["id"].dataType).alias("id")
    unsure = unsure.unionByName(known.where(held).select(nobody, "host", "path", "verdict"))
    unsure = scratch.settle(in_blocks(unsure, ["host", "path"], BLOCK_ROWS, BLOCK_BYTES), "blocks")
    found = scratch.settle(scored(unsure, model, totals, scratch).drop("unit"), "scored")
    least = threshold(found.where("verdict is not null"))
    by_model = found.where("verdict is null").select(
        "id", "host", "path", F.lit(None).cast("string").alias("rule"),
        F.when(F.col("difference") >= least, "allow").otherwise("block").alias("verdict"), "difference",
    )
    by_rule = rows.where("verdict is not null").select("id", "host", "path", "rule", "verdict", F.lit(None).cast("double").alias("difference"))
    return by_rule.unionByName(by_model).withColumnRenamed("id", id_column)
