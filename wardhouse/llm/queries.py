"""The registered queries: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardhouse.llm import ann, bpe, clusters, exact_dedup, html, langid, lexical, lm, licenses, packing, simhash, toxicity, warc
from wardhouse.llm.common import fold, read, scratch_folder


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(read(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lm.score(docs, held_out=fold(docs["doc_id"], 5) == 1)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def language_model(docs: DataFrame) -> langid.Model:
    return langid.fit(docs.where(fold(docs["doc_id"], 5) != 0))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.predict(docs, language_model(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors["vec_id"] % 100 == 0, k=10)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col("doc_id").alias("id"), "text", "lang").where(fold(docs["doc_id"], 4) != 2)
    return toxicity.fit(rows, known.withColumnRenamed("doc_id", "id"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted", "threshold", "flagged")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark)
    warc.write_archive(read(spark, sf_dir, "pages"), folder, min_bytes=100)
    return warc.read_archive(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(read(spark, sf_dir, "embeddings"), size=64, k=8, rounds=10, seed=3, scale=1024)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


QUERIES = {
    name: function
    for name, function in globals().items()
    if name.startswith("op") and callable(function)
}
