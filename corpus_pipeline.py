"""The corpus pipeline: language ID, toxicity, exact duplicates, near duplicates, packing.

Every stage reads what its predecessor wrote and, but for the last, returns the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardhouse.llm import exact_dedup, langid, packing, queries, simhash, toxicity
from wardhouse.llm.common import cut, read
from wardhouse.session import configure

# SQL expresses neither the classifiers nor the fingerprints.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a language go: their text is null or has no letter. Without labels to learn from, rows with a
    letter stay."""
    configure(spark)
    model = queries.language_model(docs)
    if not model.languages:
        return docs.where(langid.has_letter(docs["text"]))
    return langid.predict(docs, model, carry=True).where("lang_pred <> 'und'").select("doc_id.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that reach the threshold of their language go."""
    configure(spark)
    model = queries.toxicity_model(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, carry=True).where("not flagged").select("doc_id.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest id stays."""
    configure(spark)
    return simhash.keep_one_per_group(docs, shingle=3, max_bits=2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
