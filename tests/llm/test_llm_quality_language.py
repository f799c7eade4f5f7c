"""The two classifiers: held-out accuracy, likelihoods against brute force, odd inputs."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retailoom.llm import language as L
from retailoom.llm import quality as Q
from retailoom.llm.queries import QUERIES, held_out, table

SF_DIR = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    found = {r.doc_id: r for r in QUERIES["op9_quality_classifier"](spark, SF_DIR).collect()}
    assert len(found) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in found.items())
    labels = [r for r in table(spark, SF_DIR, "labels").collect() if found[r.doc_id].held_out]
    assert np.mean([found[r.doc_id].predicted == r.quality for r in labels]) >= 0.9
    good = [found[r.doc_id].score for r in labels if r.quality == 1]
    bad = [found[r.doc_id].score for r in labels if r.quality == 0]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) >= 0.9


def test_quality_of_odd_rows(spark):
    docs = table(spark, SF_DIR, "documents")
    model = Q.train(docs, table(spark, SF_DIR, "labels").where(~held_out()), sample=200)
    odd = [(1, None), (2, ""), (3, "x"), (4, "word " * 200_000), (None, "a b"), (5, "same"), (5, "same")]
    frame = spark.createDataFrame([(*r, "s", 1.0) for r in odd], "doc_id long, text string, score string, y double")
    scores = Q.quality_scores(frame, model).collect()
    assert sorted((r.doc_id for r in scores), key=repr) == sorted((i for i, _ in odd), key=repr)
    assert all(0 <= r.score <= 1 for r in scores)
    by_id = {r.doc_id: r.score for r in scores}
    assert by_id[1] == by_id[2]
    kept = Q.accepted_only(frame, model, 0.0)
    assert kept.schema == frame.schema and kept.count() == len(odd)
    assert Q.accepted_only(frame, model, 1.1).count() == 0
    assert Q.quality_scores(frame.limit(0), model).count() == 0


def test_quality_without_usable_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 0), (2, None), (9, 0)], "doc_id long, quality int")
    model = Q.train(docs, labels)
    scores = {r.doc_id: r.score for r in Q.quality_scores(docs, model).collect()}
    assert scores[1] == scores[2] and 0 < scores[1] < 1
    empty = Q.train(docs, labels.limit(0))
    assert Q.quality_scores(docs, empty).first().score == 0.5


def test_language_of_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    found = L.languages_of(docs, declared=F.col("lang"), host=F.col("source")).collect()
    assert len(found) == 1000
    assert np.mean([r.language == r.declared for r in found]) >= 0.97
    assert np.mean([r.accepted for r in found]) >= 0.98
    # a tenth of the texts declare nothing, and are still told apart
    some = docs.withColumn("lang", F.when(F.col("doc_id") % 10 != 0, F.col("lang")))
    judged = {r.doc_id: r.language for r in L.languages_of(some, declared=F.col("lang")).collect()}
    right = [judged[r.doc_id] == r.lang for r in docs.collect() if r.doc_id % 10 == 0]
    assert np.mean(right) >= 0.97


def small(spark, *more):
    rng = random.Random(7)
    words = {"en": "the and with from house water".split(), "de": "der und mit von haus wasser".split()}
    rows = [(n, " ".join(rng.choices(words[l], k=20)), l, f"{l}.example.org", "org") for n, l in enumerate(("en", "de") * 40)]
    return spark.createDataFrame([*rows, *more], "id long, text string, lang string, host string, suffix string")


def test_evidence_adds_up(spark):
    """A text that tells nothing goes with its declaration, else with its host."""
    docs = small(spark, (900, "xq", "de", None, None), (901, "xq", None, "en.example.org", None), (902, "xq", None, "de.example.org", "org"))
    found = {r.id: r for r in L.languages_of(docs, "id", declared=F.col("lang"), host=F.col("host"), suffix=F.col("suffix")).collect()}
    assert [found[i].language for i in (900, 901, 902)] == ["de", "en", "de"]
    assert all(found[n].language == ("en", "de")[n % 2] for n in range(80))
    only = L.languages_of(docs, "id", declared=F.col("lang"), accept=["de"]).collect()
    assert all(r.accepted == (r.language == "de") for r in only if r.id < 80)


def test_odd_rows_of_languages(spark):
    odd = [(800, None, "en", None, None), (801, "", "de", "h", "x"), (802, "123 !?", None, None, None), (803, "a", "EN-us", None, None), (None, "the house", None, None, None)]
    docs = small(spark, *odd, odd[3], (804, "the water " * 50_000, None, None, None))
    found = L.languages_of(docs, "id", declared=F.col("lang"), host=F.col("host"), suffix=F.col("suffix")).collect()
    assert len(found) == 80 + len(odd) + 2
    for r in found:
        if r.id in (800, 801, 802):
            assert (r.language, r.confidence, r.accepted) == (None, 0.0, False)
    assert [r.declared for r in found if r.id == 803] == ["en", "en"]
    assert [r.language for r in found if r.id is None or r.id == 804] == ["en", "en"]
    nothing = L.languages_of(docs, "id").collect()
    assert len(nothing) == len(found) and not any(r.accepted for r in nothing)
    assert L.languages_of(docs.limit(0), "id", declared=F.col("lang")).count() == 0


def trigrams(text):
    low = [32 if x < 33 else x + 32 if 65 <= x <= 90 else x for x in text.encode()]
    return list(zip(low, low[1:], low[2:], strict=False))


def slow_judgement(rows):
    """language, confidence and likelihoods of (id, text, declared, host, suffix), by dictionaries; all texts must fit."""
    languages = sorted({r[2] for r in rows if r[2]})
    counts = {l: Counter(g for r in rows if r[2] == l for g in trigrams(r[1])) for l in languages}
    cells = len({g for c in counts.values() for g in c}) + 1
    sizes = {l: sum(counts[l].values()) + 0.5 * cells for l in languages}
    likelihood, vote = {}, {}
    for i, text, *_ in rows:
        grams = trigrams(text)
        weight = min(len(grams), L.TEXT_WEIGHT) / max(len(grams), 1)
        likelihood[i] = {l: weight * sum(math.log((counts[l][g] + 0.5) / sizes[l]) for g in grams) for l in languages}
        vote[i] = max(languages, key=lambda l: likelihood[i][l])
    votes = [(vote[r[0]], *r[2:]) for r in rows if len(r[1].encode()) > 2]

    def given(column, value):
        if value is None or not any(v[column] == value for v in votes):
            return dict.fromkeys(languages, 0.0)
        some = [v for v in votes if v[column] is not None]
        of_value, whole = Counter(v[0] for v in some if v[column] == value), Counter(v[0] for v in some)
        share = L.SMOOTHING * (sum(of_value.values()) + 1) / (len(some) + len({v[column] for v in some}))
        return {l: math.log((of_value[l] + share) / (whole[l] + L.SMOOTHING)) for l in languages}

    def prior(host):
        everything = Counter(v[0] for v in votes)
        base = {l: (everything[l] + 1) / (len(votes) + len(languages)) for l in languages}
        if host is None or not any(v[2] == host for v in votes):
            return {l: math.log(base[l]) for l in languages}
        of_host = Counter(v[0] for v in votes if v[2] == host)
        of_domain = Counter(v[0] for v in votes if v[2] and v[2].split(".")[-2:] == host.split(".")[-2:])
        smooth = {l: (of_domain[l] + L.SMOOTHING * base[l]) / (sum(of_domain.values()) + L.SMOOTHING) for l in languages}
        return {l: math.log((of_host[l] + L.SMOOTHING * smooth[l]) / (sum(of_host.values()) + L.SMOOTHING)) for l in languages}

    out = {}
    for i, _, declared, host, suffix in rows:
        said, ends, before = given(1, declared), given(3, suffix), prior(host)
        p = {l: likelihood[i][l] + said[l] + ends[l] + before[l] for l in languages}
        best = max(languages, key=lambda l: p[l])
        out[i] = best, 1 / sum(math.exp(x - p[best]) for x in p.values()), likelihood[i]
    return out


@pytest.mark.parametrize(("sent", "block"), [(1 << 20, 1 << 20), (0, 1 << 20), (0, 100)])
def test_posterior_against_brute_force(spark, monkeypatch, sent, block):
    """Likelihoods and fused posteriors, with the counts in every task or joined to blocks of texts."""
    monkeypatch.setattr(L._likelihoods, "__defaults__", (sent,))
    monkeypatch.setattr(L, "BLOCK_BYTES", block)
    rng = random.Random(11)
    words = {"en": "the and with from house water".split(), "de": "der und mit von haus wasser".split(), "nl": "de en met van huis water".split()}
    rows = []
    for n in range(90):
        l = ("en", "de", "nl")[n % 3]
        said = rng.choice((l, l, l, "en", None))
        rows.append((n, " ".join(rng.choices(words[l], k=rng.choice((2, 5, 20)))), said, rng.choice((f"{l}.a.org", f"www.{l}.com", "x.b.net", None)), rng.choice(("org", "com", None))))
    docs = spark.createDataFrame(rows, "id long, text string, declared string, host string, suffix string")
    slow = slow_judgement(rows)
    found = L.languages_of(docs, "id", declared=F.col("declared"), host=F.col("host"), suffix=F.col("suffix")).collect()
    assert len(found) == 90 and all(r.fit is not None for r in found)
    for r in found:
        language, confidence, _ = slow[r.id]
        assert (r.language, r.confidence) == (language, pytest.approx(confidence, rel=1e-9))


def test_three_hundred_languages(spark):
    """None is left out, neither languages nor suffixes: each text of 20 words of its language is told by them."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    codes = [a + b for a in letters for b in letters][:300]
    rows = []
    for i, code in enumerate(codes):
        own = ["".join(rng.choices(letters, k=6)) for _ in range(12)]
        rows += [(i * 3 + k, " ".join(rng.choices(own, k=20)), code if k < 2 else None, f"{code}.example.{code}", code) for k in range(3)]
    docs = spark.createDataFrame(rows, "id long, text string, lang string, host string, suffix string")
    found = {r.id: r for r in L.languages_of(docs, "id", declared=F.col("lang"), host=F.col("host"), suffix=F.col("suffix")).collect()}
    assert all(found[i].language == codes[i // 3] and found[i].accepted for i, *_ in rows)


def test_language_of_pages(spark):
    pages = table(spark, SF_DIR, "pages")
    found = QUERIES["op5_language_id"](spark, SF_DIR).collect()
    assert len(found) == pages.count() and np.mean([r.language == r.declared for r in found]) >= 0.95
    words = {"en": "the and with from house water", "de": "der und mit von haus wasser"}
    rows = [(n, f"http://{l}.example.{l}:80/x", f"<html class=a lang='{l.upper()}-xx'><body><nav>menu</nav><p>{words[l]} {n}</p>") for n, l in enumerate(("en", "de") * 20)]
    odd = [(100, None, None), (101, "", ""), (102, "no scheme", "<p>der und mit von</p>"), (None, "http://en.example.en", "<p>the and with"), (102, "no scheme", "<p>der und mit von</p>")]
    frame = spark.createDataFrame([(*r, "en", "h") for r in rows + odd], "page_id long, url string, html string, language string, host string")
    judged = L.languages_of_pages(frame).collect()
    assert len(judged) == 45
    for r in judged:
        wanted = "en" if r.page_id is None else ("en", "de")[r.page_id % 2] if r.page_id < 40 else "de" if r.page_id == 102 else None
        assert r.language == wanted and r.declared == (wanted if r.page_id is not None and r.page_id < 40 else None)
    assert L.languages_of_pages(frame.limit(0)).count() == 0


def test_markup_and_suffix(spark):
    pages = [
        ("<!DOCTYPE html><HTML class='a' LANG=fr-CA>", "a.b.fr", "fr-CA", "fr"), ('<html xml:lang="de">', "b.de:8080", "de", "de"), ("<html data-lang='x'><p lang='es'>", "10.0.0.1", None, None),
        ('<html><head><meta http-equiv="Content-Language" content="es">', "localhost", "es", None), (None, None, None, None), ("", "", None, None),
    ]
    frame = spark.createDataFrame([p[:2] for p in pages], "html string, host string")
    found = frame.select(L.markup_language(F.col("html")), L.suffix_of(F.col("host"))).collect()
    assert [tuple(r) for r in found] == [p[2:] for p in pages]


FOREIGN = {
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "ja": "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván.",
    "code": "a1 b2 {x:[0,0,1]}",
    "gibberish": "".join(random.Random(3).choices("bcdfghjklmnpqrstvwxz   ", k=400)),
    "repeated": "xqzt wvkj " * 2_000,
}


def with_foreign(spark, docs):
    """Documents with planted rows: foreign ones (ids from -10, half of them declare English), and ones under a wrong language (-100, -101)."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    foreign = spark.createDataFrame([(-10 - n, t, "en" if n % 2 else None, "src0", len(t)) for n, t in enumerate(FOREIGN.values())], columns)
    long_ = docs.where("length(text) > 500")
    wrong = [long_.where(f"lang = '{l}'").orderBy("doc_id").limit(1).withColumns({"doc_id": F.lit(i).cast("long"), "lang": F.lit(to)}) for i, l, to in ((-100, "de", "en"), (-101, "en", "fr"))]
    return docs.unionByName(foreign).unionByName(wrong[0]).unionByName(wrong[1])


def test_foreign_and_gibberish_rows(spark):
    docs = with_foreign(spark, table(spark, SF_DIR, "documents"))
    found = {r.doc_id: r for r in L.languages_of(docs, declared=F.col("lang"), host=F.col("source")).collect()}
    for n, name in enumerate(FOREIGN):
        r = found[-10 - n]
        assert (name, r.language, r.confidence, r.accepted, r.contradicted) == (name, None, 0.0, False, bool(n % 2))
    assert (found[-100].language, found[-100].contradicted, found[-101].language, found[-101].contradicted) == ("de", True, "en", True)
    clean = [r for i, r in found.items() if i >= 0]
    assert len(clean) == 1000 and all(r.accepted and not r.contradicted for r in clean)


def test_language_stage_drops_only_the_planted(spark):
    clean = table(spark, SF_DIR, "documents")
    docs = with_foreign(spark, clean)
    kept = corpus_pipeline.language(spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in clean.select("doc_id").collect())
