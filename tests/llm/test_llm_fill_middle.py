"""Fill-in-the-middle against a plain rewriting, and back."""

import hashlib

import pytest
from pyspark.sql import functions as F

from retailoom.llm.fill_middle import digests, in_output_order, outputs, pieces, restored_order

SCHEMA = "doc_id long, text string, row int, place string, n string"


def rewritten(doc_id, text, seed=1):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


TEXTS = [None, "", " ", "a", "é", "\U0001f600" * 7, "<", "<<", "<P", "P>", ">", "a<P>b", "<S>", "x<M>", "<p>", "line\nline\r\n\t", "ab" * 50, "é́" * 31, "<P" * 40, "\0", "long " * 3000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, TEXTS[n % len(TEXTS)]) for n in range(21 * 12)]
    rows += [(None, "no id"), (None, "no id"), (5, "other text of an id"), (5, "other text of an id"), (-3, "negative id")]
    return spark.createDataFrame([(*r, 9, "p", "q") for r in rows], SCHEMA).repartition(5), rows


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_outputs(docs, chunk):
    frame, rows = docs
    found = sorted((tuple(r) for r in outputs(frame, chunk=chunk).collect()), key=repr)
    assert found == sorted((rewritten(*r) for r in rows), key=repr)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_digests_of_output_and_restored_text(docs, chunk):
    frame, rows = docs
    found = sorted((tuple(r) for r in digests(frame, chunk=chunk).collect()), key=repr)
    want = [(*w[:5], hashlib.sha256(w[5].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for (i, t), w in ((r, rewritten(*r)) for r in rows)]
    assert found == sorted(want, key=repr)


def test_all_forms_occur(docs):
    forms = {w[2] for w in map(lambda r: rewritten(*r), docs[1])}
    assert forms == {"plain", "psm", "spm"}


def test_restoration_reads_the_output_only(docs):
    """A changed output is restored to a changed text: nothing of the original gets past it."""
    frame, _ = docs
    some = pieces(frame.where("doc_id between 6 and 66"), chunk=4)
    marks = F.col("piece").isin(bytearray(b"<P>"), bytearray(b"<S>"), bytearray(b"<M>"))
    changed = some.withColumn("piece", F.when(marks | (F.col("form") == "plain"), F.col("piece")).otherwise(F.translate(F.col("piece").cast("string"), "ab", "xy").cast("binary")))
    parts = {}
    for r in restored_order(in_output_order(changed)).collect():
        if r.place < 1 << 30:
            parts.setdefault((r.row, r.id, r.form), []).append((r.place, bytes(r.piece)))
    assert len(parts) == 61
    for (_, doc_id, form), found in parts.items():
        text = TEXTS[doc_id % len(TEXTS)] or ""
        rebuilt = b"".join(p for _, p in sorted(found)).decode()
        assert rebuilt == (text if form == "plain" else text.replace("a", "x").replace("b", "y"))


def test_pieces_are_bounded(docs):
    frame, _ = docs
    assert pieces(frame, chunk=16).agg(F.max(F.octet_length("piece"))).first()[0] <= 16 * 4


def test_one_exchange_serves_both_orders(docs):
    found = digests(docs[0])
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffleQueryStage") <= 2  # the fixture's own repartition is the other one


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert digests(frame).count() == 0
    assert outputs(frame).count() == 0
