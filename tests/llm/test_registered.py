"""The registered queries: against SQL where there is some, else their folds; the pipeline against brute force."""

import os
import zlib
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.test_duplicates import plain_fingerprint, plain_groups
from tests.llm.test_tokens import check_packing
from wardhouse.catalog import check
from wardhouse.llm import queries, toxicity
from wardhouse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_all_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(contract.oracle_sql())))
def test_sql(spark, name):
    assert check.compare(contract.queries()[name](spark, FOLDER), check.connect(FOLDER), contract.oracle_sql()[name]) is None

def test_pipeline_stage_by_stage(spark, edge_docs):
    """Every stage on what its predecessor kept, against brute force or the model's own verdicts, row by row."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    twins = docs.limit(5).withColumn("doc_id", docs["doc_id"] + 1_000_000)
    odd = edge_docs.select(*docs.columns).where("doc_id not in (4, 9, 11, 16)")
    docs = docs.unionByName(twins).unionByName(odd.withColumn("doc_id", odd["doc_id"] + 2_000_000)).cache()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "toxicity", "exact_dedup", "simhash_near_dedup", "best_fit_packing"]
    as_rows = lambda df: Counter(tuple(r[c] for c in docs.columns) for r in df.collect())

    spoken = stages["language_id"](spark, docs, FOLDER).cache()
    assert spoken.columns == docs.columns
    assert as_rows(spoken) == Counter({r: n for r, n in as_rows(docs).items() if r[1] and any(c.isalpha() for c in r[1])})

    kept = stages["toxicity"](spark, spoken, FOLDER).cache()
    model = queries.toxicity_model(spoken, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    flagged = {(r["doc_id"], r["flagged"]) for r in toxicity.score(spoken, model).select("doc_id", "flagged").collect()}
    assert kept.columns == docs.columns and not as_rows(kept) - as_rows(spoken)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, bad in flagged if not bad} and any(bad for _, bad in flagged)

    once = stages["exact_dedup"](spark, kept, FOLDER).cache()
    low = lambda t: (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    groups = defaultdict(list)
    for r in kept.collect():
        groups[low(r["text"])].append(r["doc_id"])
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert Counter((low(r["text"]), r["doc_id"]) for r in once.collect()) == Counter(best.items())

    apart = stages["simhash_near_dedup"](spark, once, FOLDER).cache()
    rows = [(r["doc_id"], plain_fingerprint(r["text"], 3)) for r in once.collect()]
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted({c for _, _, c in plain_groups(rows, 2)}) and apart.columns == docs.columns

    packed = stages["best_fit_packing"](spark, apart, FOLDER).collect()
    check_packing(packed, [(r["doc_id"], r["text"]) for r in apart.collect()], 2048)


@pytest.mark.parametrize("name, parts, rest", [("op7_language_id", 5, 0), ("op10_toxicity", 4, 2), ("op5_lm_score", 5, 1)])
def test_folds_of_the_registered_queries(spark, name, parts, rest):
    """Every document once, the held-out flag by its rule."""
    got = QUERIES[name](spark, FOLDER).select("doc_id", "held_out", "score").collect()
    ids = [r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in got) == sorted(ids)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == rest) for r in got)
    assert all(r["score"] is not None for r in got)


def test_pipeline(spark):
    rows = contract.queries()["pipeline"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0 < len({r["doc_id"] for r in rows}) <= docs
