"""Fill-in-the-middle transformation by secondary sort.

A text of n code points is cut at two places drawn from a digest of its document's id. Its prefix, suffix and middle are
emitted as pieces of at most ``CHUNK`` code points, keyed by the row they come from and their place in the output.
Rows are then dealt out by their key and sorted by (key, place) within partitions (what ``repartitionAndSortWithinPartitions``
does for RDDs, here in Spark's own binary sort), so that a task sees the pieces of one document after the other, in
output order, and never holds more than one piece: digests grow piece by piece. For restoration the pieces of the output
are numbered anew, by what the marks between them say, and sorted once more inside the same partitions; no second
exchange is needed, as all pieces of a row are in one of them.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailoom.llm.store import bounded_batches

#: fixed marks and shares of the transformation
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90
SPM_BELOW = 20

CHUNK = 1 << 16
BATCH = 4 << 20  # bytes of pieces sent on at once

FACTS = "row long, id long, n long, form string, prefix_chars long, middle_chars long"
PIECES = f"{FACTS}, place int, piece binary"


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from the document's id; a row without one draws from the seed alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def _starts(text: bytes) -> np.ndarray:
    """Where the code points of UTF-8 text begin, and its length."""
    data = np.frombuffer(text, np.uint8)
    return np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))


def cut(text: bytes, doc_id: int | None, seed: int) -> tuple[str, int, int | None, int | None, list[bytes | tuple[int, int]], np.ndarray]:
    """(form, n, prefix and middle length, the output as marks and ranges of code points, beginnings of code points)."""
    starts = _starts(text)
    n = len(starts) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_FROM:
        return "plain", n, None, None, [(0, n)], starts
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < SPM_BELOW:
        return "spm", n, a, b - a, [SUFFIX, (b, n), PREFIX, (0, a), MIDDLE, (a, b)], starts
    return "psm", n, a, b - a, [PREFIX, (0, a), SUFFIX, (b, n), MIDDLE, (a, b)], starts


def pieces(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = 1, chunk: int = CHUNK) -> DataFrame:
    """The pieces of each row's output, one row each: its facts, the place in the output (from 0), the bytes.

    Every text has a piece at least, which is empty for an empty text. Marks are pieces of their own.
    """
    bounded_batches(docs.sparkSession)

    def emit(batches):
        for batch in batches:
            rows, size = [], 0
            texts = batch.column(2).cast(pa.large_binary())
            for i, (row, doc_id) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                text = texts[i].as_py() or b""
                form, n, prefix, middle, parts, starts = cut(text, doc_id, seed)
                place = 0
                for part in parts:
                    if isinstance(part, bytes):
                        found = [part]
                    else:
                        edges = [*range(part[0], part[1], chunk), part[1]] if part[1] > part[0] else [part[0], part[0]] if len(parts) == 1 else [part[0]]
                        found = [text[starts[a] : starts[b]] for a, b in zip(edges, edges[1:], strict=False)]
                    for piece in found:
                        rows.append((row, doc_id, n, form, prefix, middle, place, piece))
                        place += 1
                        size += len(piece)
                        if size >= BATCH:
                            yield _batch(rows)
                            rows, size = [], 0
            if rows:
                yield _batch(rows)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return numbered.mapInArrow(emit, PIECES)


_ARROW = [
    ("row", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("place", pa.int32()), ("piece", pa.binary()),
]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(values, kind) for values, (_, kind) in zip(zip(*rows, strict=True), _ARROW, strict=True)], [name for name, _ in _ARROW])


def in_output_order(cut_pieces: DataFrame) -> DataFrame:
    """Pieces of a row in one partition, one after the other."""
    return cut_pieces.repartition("row").sortWithinPartitions("row", "place")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


# where text after a mark belongs in the original
_SECTION = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}


def outputs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = 1, chunk: int = CHUNK) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row: the transformed text itself.

    A null text counts as empty, an empty one stays as it is (plain), as do texts that hold a mark and a tenth of all.
    Lengths are in code points and null where the form is plain. Rows without an id draw their cuts from the seed alone;
    repeated rows are transformed one by one, rows of one id draw alike. An empty table gives an empty result. Only the
    two named columns are read. A text must fit into a worker here; ``digests`` never joins the pieces.
    """

    def join(batches):
        last, parts, done, size = None, [], [], 0
        for *facts, _, piece in _each(batches):
            if last is not None and facts[0] != last[0]:
                done.append((*last, b"".join(parts)))
                parts = []
                if size >= BATCH or len(done) >= 1000:
                    yield _texts(done)
                    done, size = [], 0
            last = facts
            parts.append(piece)
            size += len(piece)
        if last is not None:
            yield _texts([*done, (*last, b"".join(parts))])

    def _texts(done: list[tuple]) -> pa.RecordBatch:
        names = [name for name, _ in _ARROW[:6]] + ["output"]
        kinds = [kind for _, kind in _ARROW[:6]] + [pa.binary()]
        return pa.record_batch([pa.array(values, kind) for values, kind in zip(zip(*done, strict=True), kinds, strict=True)], names)

    joined = in_output_order(pieces(docs, id_column, text_column, seed, chunk)).mapInArrow(join, f"{FACTS}, output binary")
    return joined.select(F.col("id").alias(id_column), "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restored_order(sorted_pieces: DataFrame) -> DataFrame:
    """From pieces in output order: the digest of each output, and its pieces in the order of the original text.

    The place in the original is read from the output alone: its form, and the marks that stand between the pieces.
    The digest travels with a row of its own that sorts last (place -1 becomes the largest).
    """

    def renumber(batches):
        rows, size = [], 0
        last, digest, section, count = None, None, 0, 0

        def closed():
            return (*last, 1 << 30, digest.digest())

        for *facts, _, piece in _each(batches):
            if last is None or facts[0] != last[0]:
                if last is not None:
                    rows.append(closed())
                last, digest, section, count = facts, hashlib.sha256(), 0, 0
            digest.update(piece)
            if facts[3] != "plain" and piece in _SECTION:
                section, count = _SECTION[piece], 0
                continue
            # a section's pieces follow each other; 2**28 pieces of a section are more than a row can hold
            rows.append((*facts, (section << 28) + count, piece))
            count += 1
            size += len(piece)
            if size >= BATCH or len(rows) >= 10_000:
                yield _batch(rows)
                rows, size = [], 0
        if last is not None:
            rows.append(closed())
        if rows:
            yield _batch(rows)

    return sorted_pieces.mapInArrow(renumber, PIECES).sortWithinPartitions("row", "place")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = 1, chunk: int = CHUNK) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row, edge cases as ``outputs``.

    Both digests are taken piece by piece, the second over the text that is rebuilt from the output and its form.
    """

    def finish(batches):
        done: list[tuple] = []
        last, digest = None, None
        for *facts, place, piece in _each(batches):
            if facts[0] != last:
                last, digest = facts[0], hashlib.sha256()
            if place == 1 << 30:
                done.append((*facts, piece.hex(), digest.hexdigest()))
                if len(done) >= 10_000:
                    yield _digested(done)
                    done = []
            else:
                digest.update(piece)
        if done:
            yield _digested(done)

    def _digested(done: list[tuple]) -> pa.RecordBatch:
        names = [name for name, _ in _ARROW[:6]] + ["output_sha256", "restored_sha256"]
        kinds = [kind for _, kind in _ARROW[:6]] + [pa.string(), pa.string()]
        return pa.record_batch([pa.array(values, kind) for values, kind in zip(zip(*done, strict=True), kinds, strict=True)], names)

    again = restored_order(in_output_order(pieces(docs, id_column, text_column, seed, chunk)))
    found = again.mapInArrow(finish, f"{FACTS}, output_sha256 string, restored_sha256 string")
    return found.select(F.col("id").alias(id_column), "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
