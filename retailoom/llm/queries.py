"""Registered queries over the documents, pages, benchmark, labels and embeddings tables."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailoom.llm.centroids import cluster_vectors, with_inertia
from retailoom.llm.decontaminate import contamination
from retailoom.llm.fill_middle import digests
from retailoom.llm.language import languages_of_pages
from retailoom.llm.licenses import license_scan
from retailoom.llm.main_text import main_texts
from retailoom.llm.near_dedup import near_duplicates
from retailoom.llm.packing import pack
from retailoom.llm.quality import quality_scores, train
from retailoom.llm.token_counts import token_counts
from retailoom.llm.top_k import top_k
from retailoom.llm.toxicity import toxicity_scores
from retailoom.llm.toxicity import train as train_toxicity
from retailoom.llm.url_filter import judged_urls

SEQUENCE_BYTES = 8192
LEAST_QUALITY = 0.3
LEAST_TOXICITY = 0.5
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_column: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(5)) == 0


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def packed(docs: DataFrame) -> DataFrame:
    """Sequences of ``SEQUENCE_BYTES`` bytes, no two pieces of one source or of equal texts (but for case) in one."""
    return pack(docs, F.octet_length("text"), SEQUENCE_BYTES, source=F.col("source"), cluster=F.xxhash64(F.lower("text")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has no paths: a hundred documents of a source are taken as a directory below the source's."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    return license_scan(table(spark, sf_dir, "documents"), path)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_of_pages(table(spark, sf_dir, "pages")).drop("row_key")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scores = quality_scores(docs, model)
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"), k=16, rounds=3, width=64, scale=64, seed=1)
    return with_inertia(found, centroids)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), seed=1)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scores = toxicity_scores(docs, model)
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= LEAST_TOXICITY).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_license_scan": op3_license_scan,
    "op4_main_text": op4_main_text,
    "op5_language_id": op5_language_id,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_url_filter": op8_url_filter,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_toxicity": op13_toxicity,
}
