import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardhouse.llm import exact_dedup, simhash
from wardhouse.llm.common import join_counted
from wardhouse.llm.components import components


def expected_exact(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[(t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, max(known, default=None), len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("mask", [-1, 3])
def test_exact_edges(edge_docs, mask):
    """`mask` 3 gives all blocks one of four hashes, so that names must tell them apart by their bytes."""
    got = exact_dedup.exact_dedup(edge_docs, hash_mask=mask).collect()
    want = expected_exact([(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()])
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({k[3] for k in want})
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_blocks(spark):
    """Texts around the block size that share blocks in other orders."""
    n = exact_dedup.BLOCK_BYTES
    a, b, c = "a" * n, "b" * n, "c" * n
    texts = [a, a + b, b + a, a + b + c, a + b + "c", a + a, a + a + a, a[:-1], a + b + c, "é" * (n // 2) + "x", a * 5 + b, a * 5 + b]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = exact_dedup.exact_dedup(df).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == expected_exact(list(enumerate(texts)))


def test_exact_empty(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    assert exact_dedup.keep_distinct(no_docs).columns == no_docs.columns


def test_keep_distinct(edge_docs):
    out = exact_dedup.keep_distinct(edge_docs)
    assert out.columns == edge_docs.columns
    want = {k[3] for k in expected_exact([(r["doc_id"], r["text"]) for r in edge_docs.collect()])}
    got = [k[3] for k in expected_exact([(r["doc_id"], r["text"]) for r in out.collect()]).elements()]
    assert sorted(got) == sorted(want)


def plain_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    value = 0
    for bit in range(64):
        if grams and sum(xxhash.xxh64_intdigest(g, 42) >> bit & 1 for g in grams) * 2 > len(grams):
            value |= 1 << bit
    return value


def plain_groups(rows, bits):
    """All pairs of fingerprints compared, then the least id that links reach."""
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                parent[top(i)] = top(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return Counter((i, f"{fp:016x}", least.get(top(k))) for k, (i, fp) in enumerate(rows))


def test_simhash_edges(edge_docs):
    rows = [(r["doc_id"], plain_fingerprint(r["text"], 3)) for r in edge_docs.collect()]
    got = Counter(tuple(r) for r in simhash.simhash_groups(edge_docs).collect())
    assert got == plain_groups(rows, 2)


def test_simhash_near(spark):
    """Long texts with a few words changed, some of which link and some of which do not."""
    rng = random.Random(5)
    docs = []
    for k in range(40):
        words = [rng.choice("abcdefghijklmnop") * rng.randint(1, 6) + str(rng.randint(0, 99)) for _ in range(300)]
        for copy in range(5):
            docs.append((len(docs), " ".join(words)))
            words[rng.randrange(300)] = "changed"
    got = Counter(tuple(r) for r in simhash.simhash_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    want = plain_groups([(i, plain_fingerprint(t, 3)) for i, t in docs], 2)
    assert got == want and len({c for _, _, c in want}) < len({f for _, f, _ in want})


def test_simhash_keeps_one(edge_docs, no_docs):
    kept = simhash.keep_one_per_group(edge_docs)
    rows = [(r["doc_id"], plain_fingerprint(r["text"], 3)) for r in edge_docs.collect()]
    groups = {c for _, _, c in plain_groups(rows, 2)}
    assert kept.columns == edge_docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) >= Counter({c: 1 for c in groups if c is not None})
    assert simhash.simhash_groups(no_docs).count() == 0 and simhash.keep_one_per_group(no_docs).count() == 0


def test_anchors_meet_every_close_pair():
    """Every fingerprint has one home, and fingerprints at distance 2 or less meet at each other's home."""
    rng = np.random.default_rng(1)
    a = rng.integers(-(2**63), 2**63 - 1, 400)
    b = a.copy()
    for k in range(400):
        for bit in rng.choice(64, k % 3, replace=False):
            b[k] ^= np.int64(np.uint64(1) << np.uint64(bit))
    row, home = simhash.anchors(a, 0)
    assert (row == np.arange(400)).all()
    row, reach = simhash.anchors(b, 2)
    met = set(zip(row.tolist(), reach.tolist()))
    assert all((k, h) in met for k, h in enumerate(home.tolist()))


def test_links_are_all_close_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63 - 1, 30).tolist()
    fps = set()
    for x in base:
        for _ in range(12):
            y = x
            for bit in rng.choice(63, rng.integers(0, 4), replace=False).tolist():
                y ^= 1 << bit
            fps.add(y)
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 2).collect()}
    want = {(x, y) for x in fps for y in fps if x < y and ((x ^ y) & (2**64 - 1)).bit_count() <= 2}
    assert got == want and len(want) > 50


def test_copies_are_not_broadcast(spark):
    """A fingerprint has some 60 copies, which the estimate of their size does not count."""
    fps = spark.range(100).select(F.xxhash64("id").alias("fp"))
    assert simhash._placed(fps, 2).count() > 40 * fps.count()
    found = simhash.links(fps, 2)
    assert found.collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_block_names_are_not_broadcast(spark, monkeypatch):
    """Every text has blocks of its own and pairs of their names, so what names them grows as the texts do."""
    plans, write = [], exact_dedup.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(exact_dedup, "cut", seen)
    texts = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.col("id").cast("string"), F.lit(" ")), 1_500).alias("text"))
    assert exact_dedup.exact_dedup(texts).where("kept and group_size = 1").count() == 40
    joins = [p for p in plans if "Join" in p]
    assert len(joins) > 3 and not any("Broadcast" in p for p in joins)


def test_hot_keys_do_not_pass_the_shuffle(spark):
    """A third of the rows have one key, 3,000 keys have one row each; every row is found, hot ones by broadcast."""
    left = spark.range(6_000).select(F.when(F.col("id") < 2_000, 0).when(F.col("id") < 3_000, 1 + F.col("id") % 5).otherwise(F.col("id")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    joined = join_counted(left, right, ["k"], "n", 6_000)
    got = joined.select("k", "id", "n", "least").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, left.join(right, "k").select("k", "id", "n", "least").collect()))
    assert joined.where("n * 1000 >= 6000").count() == 3_000
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_components_of_a_chain_a_star_and_none(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(300)}, 5000: 5000, 5001: 5000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
