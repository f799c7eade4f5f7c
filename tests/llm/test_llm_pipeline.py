"""The pipeline's stages, registered queries and their SQL twins."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_llm_decontaminate import brute_force as contaminated
from test_llm_near_dedup import brute_force as components_of

import __spark_entry__ as registry
import corpus_pipeline
from retailoom.llm.oracle import SQL
from retailoom.llm.quality import quality_scores, train
from retailoom.llm.queries import LEAST_QUALITY, QUERIES, held_out, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages", "embeddings", "conversations"):
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(SQL[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    found = sorted(map(tuple, frame.select(columns).collect()), key=repr)
    assert found and found == sorted(map(tuple, expected.project(",".join(columns)).fetchall()), key=repr)


def test_one_query_per_operator():
    names = list(registry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and registry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_whole_tables(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    source = "pages" if name.split("_")[0] in ("op4", "op8") else "documents"
    key = "page_id" if source == "pages" else "doc_id"
    ids = sorted({r[0] for r in table(spark, SF_DIR, source).select(key).collect()})
    found = [r[0] for r in frame.select(key).collect()]
    assert sorted(set(found)) == ids
    if not name.startswith("op2_"):
        assert len(found) == len(ids)


def ids_of(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_stages_by_brute_force(spark):
    """Each stage on what the one before kept, as ids worked out apart from the stages."""
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    model = train(docs, table(spark, SF_DIR, "labels").where(~held_out()))
    scores = {r.doc_id: r.score for r in quality_scores(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = [i for i in sorted(texts) if scores[i] >= LEAST_QUALITY]
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        if name == "MinHash near-dedup":
            components = components_of([(i, texts[i]) for i in kept], 5)
            kept = [i for i in kept if components[(i, texts[i])][1] == i]
        elif name == "benchmark decontamination":
            kept = [i for i in kept if not contaminated(texts[i], items)[-1]]
        # these tables hold no document in another language than they say
        assert ids_of(docs) == kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sorted({r.doc_id for r in packed}) == kept
    assert sum(r.n_units for r in packed) == sum(len(texts[i].encode()) for i in kept)
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed))


def odd_documents(spark):
    docs = table(spark, SF_DIR, "documents").limit(30)
    some = docs.first()
    rows = [
        (900, None, None, None, None), (901, "", "en", "src0", 0), (None, some.text, "en", "src1", 5), (902, "the of and " * 60_000, "en", None, 1),
        (903, some.text, some.lang, some.source, 1), (903, some.text, some.lang, some.source, 1), (904, "123 456", "en", "src0", 7),
    ]
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    # names that the operators use inside
    return more.select("*", *[F.lit(1).alias(c) for c in ("id", "key", "score", "token", "bin", "component", "_rejected_doc_id", "kept")])


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows_and_none(spark, name, stage):
    docs = odd_documents(spark)
    found = stage(spark, docs, SF_DIR)
    if name != "best-fit packing":
        assert found.columns == docs.columns
        before = {tuple(r) for r in docs.collect()}
        after = found.collect()
        assert after and {tuple(r) for r in after} <= before
    else:
        assert {r.doc_id for r in found.collect()} == {r.doc_id for r in docs.collect()}
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_near_dedup_tells_rows_apart(spark):
    """Null and repeated ids: what is no copy stays, and one of each group stays, that with the smallest id."""
    text = {name: " ".join(f"{name}{n}" for n in range(40)) for name in "abcdefg"}
    rows = [
        (1, text["a"]), (None, text["a"]), (None, text["b"]),  # a copy without id, and a text that has nothing to do with it
        (5, text["c"]), (5, text["c"]), (5, text["c"] + " more"),  # repeats under one id
        (None, text["d"]), (None, text["d"]),  # copies that all lack ids
        (7, text["e"]), (7, text["f"]), (3, text["e"]),  # two texts under one id, one of them a copy
        (None, text["g"]), (9, text["g"]), (None, None), (None, None), (8, ""), (8, ""),
    ]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id long, text string, _row int").repartition(5)
    found = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in found.collect()), key=repr)
    of_five = [k for k in kept if k[0] == 5]
    assert len(of_five) == 1 and of_five[0][1].startswith(text["c"])
    expected = [
        (1, text["a"]), (None, text["b"]), (None, text["d"]), (3, text["e"]), (7, text["f"]), (9, text["g"]), (None, None), (None, None), (8, ""), (8, ""),
    ]
    assert sorted((k for k in kept if k[0] != 5), key=repr) == sorted(expected, key=repr)
