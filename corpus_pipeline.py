"""From raw documents to packed sequences, as stages that each read what the one before has written."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailoom.llm.decontaminate import contamination
from retailoom.llm.language import languages_of
from retailoom.llm.near_dedup import near_duplicates
from retailoom.llm.quality import accepted_only, train
from retailoom.llm.queries import LEAST_QUALITY, held_out, packed, table
from retailoom.llm.store import Scratch


def _without(spark: SparkSession, docs: DataFrame, rejected: DataFrame, name: str, **keys) -> DataFrame:
    """The documents that no row of ``rejected`` names; keys: its column, and what it equals in the documents."""
    rejected = rejected.select(*[F.col(k).alias(f"_rejected_{k}") for k in keys]).distinct()
    rejected = Scratch(spark, "pipeline").settle(rejected, name)
    same = None
    for k, value in keys.items():
        equal = value.eqNullSafe(rejected[f"_rejected_{k}"])
        same = equal if same is None else same & equal
    return docs.join(rejected, same, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores at least ``LEAST_QUALITY`` stay."""
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return accepted_only(docs, model, LEAST_QUALITY)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus' languages stay, if it is the one they declare (or they declare none)."""
    judged = languages_of(docs, declared=docs["lang"], host=docs["source"]).where("not accepted or contradicted")
    return _without(spark, docs, judged, "languages", doc_id=docs["doc_id"], row_key=F.xxhash64(docs["text"], docs["lang"], docs["source"]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays, that with the smallest id (null last).

    Rows are told apart by a number that is stored before anything is compared, so ids may be null or repeated.
    """
    number = "_row"
    while number in docs.columns:
        number += "_"
    numbered = Scratch(spark, "pipeline").settle(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, id_column=number, shingle=5, percent=80).select(number, "component_id")
    found = found.join(numbered.select(number, "doc_id"), number)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", number))
    kept = found.groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{number}").alias(number))
    return _without(spark, numbered, found.join(kept, number, "left_anti"), "copies", **{number: numbered[number]}).drop(number)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    found = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    return _without(spark, docs, found, "contaminated", doc_id=docs["doc_id"], text_key=F.xxhash64(docs["text"]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each part of each document goes."""
    return packed(docs)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", packing),
]

# the classifiers and the packing have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; rows of the last."""
    scratch = Scratch(spark, "run")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.settle(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
