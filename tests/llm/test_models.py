import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardhouse.llm import langid, lm, toxicity
from wardhouse.llm.common import fold

SF = "/root/testdata/sf0.01"


def segmentations(text, pieces):
    """All ways to cut the text, by brute force."""
    for cuts in itertools.product((0, 1), repeat=len(text) - 1):
        parts, last = [], 0
        for k, c in enumerate(cuts, 1):
            if c:
                parts.append(text[last:k])
                last = k
        parts.append(text[last:])
        if all(p in pieces or len(p) == 1 for p in parts):
            yield parts


def test_forward_sums_all_segmentations():
    pieces = langid.Pieces(langid.VOCABULARY)
    number = {s: k for k, s in enumerate(pieces.strings)}
    rng = np.random.default_rng(0)
    weight = rng.random(len(pieces) + 1)
    words = [w.encode() for w in ("the", "und", "x", "ñandú", "§§q", "station")]
    lattice = langid.Lattices(["▁" + w.decode() for w in words], pieces)
    alpha = lattice.forward(weight[lattice.piece])
    used = lattice.usage(weight[lattice.piece])
    for k, word in enumerate(words):
        text = "▁" + word.decode()
        total, count = 0.0, Counter()
        for parts in segmentations(text, number):
            p = math.prod(weight[number.get(x, len(pieces))] for x in parts)
            total += p
            for x in parts:
                count[number.get(x, len(pieces))] += p
        assert alpha[k, lattice.length[k]] == pytest.approx(total)
        got = np.bincount(lattice.piece[lattice.row == k], used[lattice.row == k], len(pieces) + 1)
        for piece, p in count.items():
            assert got[piece] == pytest.approx(p / total)


def log_sum(values):
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def plain_chain(text, number, log_weight):
    """Log probability of a text over all segmentations, and the expected uses of each piece, position by position."""
    unknown, longest = len(number), max(map(len, number))
    edges = [(j, i, number.get(text[j:i], unknown if i - j == 1 else None)) for i in range(1, len(text) + 1) for j in range(max(0, i - longest), i)]
    edges = [e for e in edges if e[2] is not None]
    alpha, beta = [0.0] + [None] * len(text), [None] * len(text) + [0.0]
    for i in range(1, len(text) + 1):
        alpha[i] = log_sum([alpha[j] + log_weight[p] for j, end, p in edges if end == i])
    for j in range(len(text) - 1, -1, -1):
        beta[j] = log_sum([beta[i] + log_weight[p] for start, i, p in edges if start == j])
    used = Counter()
    for j, i, p in edges:
        used[p] += math.exp(alpha[j] + log_weight[p] + beta[i] - alpha[-1])
    return alpha[-1], used


@pytest.mark.parametrize("window", [langid.WINDOW, 7])
def test_words_of_any_length(window, monkeypatch):
    """No cut: the segmentations across every place of a long word are summed."""
    monkeypatch.setattr(langid, "WINDOW", window)
    pieces = langid.Pieces(langid.VOCABULARY)
    number = {s: k for k, s in enumerate(pieces.strings)}
    log_weight = np.log(np.random.default_rng(3).random((len(pieces) + 1, 2)) * 1e-3 + 1e-9)
    words = [("station" * 43)[:300], "a" * 60, "日本語テキスト" * 8, "x" * 48, "§" * 49 + "and"]
    texts = ["▁" + w for w in words]
    long = langid.LongWords(texts, pieces)
    totals = long.totals(log_weight)
    sums, lang, count = np.zeros((2, len(pieces) + 1)), np.array([0, 1, 0, 1, 1]), np.array([1, 2, 3, 1, 5])
    long.usage(log_weight, lang, count, sums)
    want = np.zeros_like(sums)
    for k, text in enumerate(texts):
        for j in range(2):
            total, used = plain_chain(text, number, log_weight[:, j])
            assert totals[k, j] == pytest.approx(total)
            if j == lang[k]:
                for p, n in used.items():
                    want[j, p] += n * count[k]
    np.testing.assert_allclose(sums, want, rtol=1e-6, atol=1e-12)
    # At the length where doubles end, both ways agree.
    short, texts, groups = langid.by_length([("station" * 7)[:47].encode(), ("station" * 7)[:48].encode(), b"a" * 500])
    assert short == [0] and [g[0] for g in groups] == [[2, 1]]
    lattice = langid.Lattices(texts, pieces)
    alpha = lattice.forward(np.exp(log_weight)[lattice.piece])
    np.testing.assert_allclose(np.log(alpha[0, 48]), langid.LongWords(texts, pieces).totals(log_weight)[0])


def test_pieces_find_every_string_and_no_other():
    pieces = langid.Pieces(langid.VOCABULARY)
    known = set(pieces.strings)
    rng = random.Random(1)
    probes = rng.sample(pieces.strings, 500) + ["".join(rng.choices("abcdefgh▁é", k=rng.randint(1, 9))) for _ in range(3000)]
    for text in probes:
        *_, last = pieces.rolling(np.array(list(map(ord, text)), np.uint64))
        found = int(pieces.find(last)[0])
        assert (pieces.strings[found] == text) if text in known else found == -1


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where(fold(docs["doc_id"], 5) != 0))
    found = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where(fold(F.col("doc_id"), 5) == 0)
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert found.where("score < 0 or score > 1 or score is null").count() == 0


def test_language_edges(spark, edge_docs, no_docs):
    model = langid.fit(edge_docs)
    assert model.languages == ["de", "en"]
    found = langid.predict(edge_docs, model, carry=True)
    rows = found.collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        text = r["doc_id"]["text"]
        assert (r["lang_pred"] == "und") == (text is None or not any(c.isalpha() for c in text))
    assert found.select("doc_id.*").columns == edge_docs.columns
    assert langid.predict(no_docs, model).count() == 0
    nothing = langid.fit(no_docs)
    assert nothing.languages == [] and {r["lang_pred"] for r in langid.predict(edge_docs, nothing).collect()} == {"und"}


def direct_score(net, text):
    """The network without shared sums, segments or caches."""
    rows = toxicity._padded(toxicity.rows_of(toxicity.plain_words(text)))
    words = net.table[rows].sum(axis=1)
    n = len(rows) - max(toxicity.WIDTHS) + 1
    pooled = [(sum(words[j : j + n] @ f[j] for j in range(len(f))) + b).max(axis=0) for f, b in zip(net.filters, net.bias)]
    return 1 / (1 + np.exp(-(np.tanh(np.concatenate(pooled)) @ net.out + net.shift)))


def test_toxicity_score_is_the_networks(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta!", "Ünïc"], k=n)).encode() for n in (0, 1, 2, 3, 40, 700)]
    net = toxicity.train([toxicity.rows_of(toxicity.plain_words(t)) for t in texts], np.array([0, 1, 0, 1, 0, 1.0]), epochs=2)
    want = [direct_score(net, t) for t in texts]
    assert toxicity.Scorer(net)(texts) == pytest.approx(want, abs=1e-4)
    monkeypatch.setattr(toxicity, "SEGMENT_WORDS", 7)
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 9)
    assert toxicity.Scorer(net)(texts) == pytest.approx(want, abs=1e-4)


def test_toxicity_training_follows_the_gradient():
    """Loss falls on separable texts, and the classes come apart."""
    texts = [b"a b c d bad e", b"a b c d e", b"bad", b"c d", b"x y bad z", b"x y z"] * 20
    labels = np.array([1, 0, 1, 0, 1, 0] * 20, float)
    net = toxicity.train([toxicity.rows_of(toxicity.plain_words(t)) for t in texts], labels, epochs=5)
    got = toxicity.Scorer(net)(texts)
    assert got[labels == 1].min() > 0.7 and got[labels == 0].max() < 0.3


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = docs.join(labels, "doc_id")
    model = toxicity.fit(rows.where(fold(F.col("doc_id"), 4) != 2).withColumnRenamed("doc_id", "id"))
    held = rows.where(fold(F.col("doc_id"), 4) == 2)
    found = toxicity.score(held, model).join(labels, "doc_id").toPandas()
    assert found[found.toxic == 1].predicted.mean() > 0.85 and found[found.toxic == 0].predicted.mean() < 0.03


def test_toxicity_edges(spark, edge_docs, no_docs):
    rows = edge_docs.select(F.col("doc_id").alias("id"), "text", "lang", F.expr("case when text like '%idiot%' then 1 when doc_id is null then null else 0 end").alias("toxic"))
    model = toxicity.fit(rows)
    found = toxicity.score(edge_docs, model, carry=True)
    assert found.count() == edge_docs.count() and found.where("score is null or score < 0 or score > 1").count() == 0
    assert found.where("predicted <> cast(score >= 0.3 as int) or flagged <> (score >= threshold)").count() == 0
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.fit(rows.where("false"))
    assert {r["predicted"] for r in toxicity.score(edge_docs, none).collect()} == {0}


def test_thresholds_by_language():
    scores = np.array([0.9, 0.8, 0.6, 0.2, 0.1, 0.7, 0.6, 0.4])
    got = toxicity.thresholds(["a"] * 5 + ["b"] * 2 + [None], scores, np.array([1, 1, 0, 0, 0, 1, 1, 1]))
    assert set(got) == {"a"} and 0.6 < got["a"] <= 0.8


def table_weights(c, d, strength, others, parent):
    """Chances of 1..c tables: S(c, t), from its recursion in plain numbers, times the weights of t new tables."""
    s = np.zeros((c + 2, c + 2))
    s[0, 0] = 1.0
    for n in range(c):
        for t in range(1, n + 2):
            s[n + 1, t] = s[n, t - 1] + (n - t * d) * s[n, t]
        s[n + 1] /= max(n, 1)
    weight, mass = np.zeros(c), 1.0
    for t in range(1, c + 1):
        mass *= (strength + d * (others + t - 1)) * parent
        weight[t - 1] = s[c, t] * mass
    return weight / weight.sum()


@pytest.mark.parametrize("c, strength, others, parent", [
    (2, 1.0, 5, 0.2), (6, 0.8, 0, 1.0), (6, 10.0, 50, 0.01), (64, 1.0, 3, 0.3), (65, 1.0, 3, 0.3), (120, 10.0, 900, 0.01), (120, 10.0, 40, 1e-4), (150, 1.0, 30, 0.9),
    (40, 1.0, 10**6, 0.9),
])
def test_seating_follows_the_exact_distribution(c, strength, others, parent):
    want, n = table_weights(c, lm.DISCOUNT, strength, others, parent), 40_000
    drawn = lm.seat(np.full(n, c), np.full(n, others), np.full(n, parent), strength, np.random.default_rng(3))
    got = np.bincount(drawn, minlength=c + 1)[1:] / n
    assert np.abs(got - want).sum() / 2 < 0.02 and drawn.mean() == pytest.approx(want @ np.arange(1, c + 1), rel=0.01)


def test_seating_of_very_large_dishes():
    """One exact way for any number of customers: repeated draws have the mean and spread of the weights around the mode."""
    few = np.array([0, 1, 500, 10**12])
    many = lm.seat(few, np.zeros(4), np.array([1.0, 1.0, 1e-300, 1e-6]), 1.0, np.random.default_rng(1))
    assert many[:3].tolist() == [0, 1, 1] and 1 <= many[3] < 10**5
    c, others, p, strength = 10**6, 10**4, 1e-2, 10.0
    t = np.arange(1, 5000, dtype=float)
    log = np.concatenate([[0], np.log(2 * p * (2 * strength + others + t) * (c - t) / ((2 * c - t - 1) * t)).cumsum()[:-1]])
    weight = np.exp(log - log.max())
    mean = weight @ t / weight.sum()
    spread = math.sqrt(weight @ (t - mean) ** 2 / weight.sum())
    drawn = lm.seat(np.full(4000, c), np.full(4000, others), np.full(4000, p), strength, np.random.default_rng(2))
    assert abs(drawn.mean() - mean) < 5 * spread / math.sqrt(4000) and drawn.std() == pytest.approx(spread, rel=0.06)


def test_speller_by_plain_loops():
    """Predictive probabilities from the root down, for contexts whose every dish has one customer (so one table)."""
    words = [b"ab", b"c"]
    context, symbol, _ = lm.symbols(words)
    model = lm.speller(dict(Counter(zip(context.tolist(), symbol.tolist()))), np.random.default_rng(0))

    def chance(rows, depth, below):
        d, strength = lm.DISCOUNT, lm.BYTE_STRENGTHS[depth]
        n = sum(rows.values())
        return [(max(rows.get(s, 0) - (d if s in rows else 0), 0) + (strength + d * len(rows)) * below[s]) / (strength + n) for s in range(lm.SYMBOLS)]

    a, b, c = b"abc"
    root, d, strength = model.values[0], lm.DISCOUNT, lm.BYTE_STRENGTHS[0]
    # Without context the end has two customers, at one table or two.
    uniform = 1 / lm.SYMBOLS
    either = [(2 * (s == lm.END) + (s in (a, b, c)) - d * (t * (s == lm.END) + (s in (a, b, c))) + (strength + d * (3 + t)) * uniform) / (strength + 5) for t in (1, 2) for s in range(lm.SYMBOLS)]
    assert any(np.allclose(root, either[k * lm.SYMBOLS : (k + 1) * lm.SYMBOLS]) for k in (0, 1))
    one = chance({lm.END: 1}, 1, root.tolist())
    assert model.values[model.rows[-1 - b]] == pytest.approx(np.array(one))
    assert model.values[model.rows[a * lm.SYMBOLS + b]] == pytest.approx(np.array(chance({lm.END: 1}, 2, one)))


def test_speller_is_a_distribution():
    words = [b"abc", b"abd", b"", b"xyz", b"ab"]
    context, symbol, owner = lm.symbols(words)
    assert Counter(owner.tolist()) == {0: 4, 1: 4, 2: 1, 3: 4, 4: 3}
    model = lm.speller(dict(Counter(zip(context.tolist(), symbol.tolist()))), np.random.default_rng(0))
    assert model.values.sum(axis=1) == pytest.approx(np.ones(len(model.values)))
    known, other = model.log_probability([b"abc", b"qqq"])
    assert known > other
    assert lm.speller({}, np.random.default_rng(0)).values.sum() == pytest.approx(1)


def test_model_counts_and_gain(spark):
    """Counts and base against a plain loop; held-out texts are likelier than under the base."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in lm.score(docs, fold(docs["doc_id"], 5) == 1).collect()}
    import zlib

    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [b""] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    c = Counter(w for i, ws in texts.items() if not held[i] for w in ws)
    total = sum(c.values())
    low = math.log10(total + 0.5 * (len(c) + 1))
    for i, ws in texts.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(c[w] > 0 for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10(c[w] + 0.5) - low for w in ws), rel=1e-9)
    assert sum(got[i]["score"] for i in texts if held[i]) > sum(got[i]["base_score"] for i in texts if held[i])


def test_model_chunks_do_not_matter(spark, edge_docs, no_docs, monkeypatch):
    held = edge_docs["doc_id"] == 7
    rows = lm.score(edge_docs, held).collect()
    assert len(rows) == edge_docs.count() and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert lm.score(no_docs, no_docs["doc_id"] == 1).count() == 0
    assert all(r["n_known"] == 0 for r in lm.score(edge_docs, edge_docs["row"] >= 0).collect())


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """No row is left out by a sample: a word that one row alone of very many has still moves the score, over shards too."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 2_000)
    seen = spark.range(12_000).select("id", F.lit("en").alias("lang"), (F.col("id") % 3 == 0).cast("int").alias("toxic"), F.concat(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("bad ugly vile w"), "id")).otherwise(F.concat(F.lit("good fine kind w"), "id"))).alias("text"))
    before = toxicity.fresh()
    model = toxicity.fit(seen)
    h = seen.select("text", F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("toxic")), F.lit(5)).alias("h")).toPandas()
    rows = toxicity.rows_of([t.split()[-1].encode() for t in h.text[h.h < 4]])
    moved = (model.net.table != before.table.astype(np.float32)).any(axis=1)
    assert len(rows) > 9_000 and moved[rows[:, :2]].any(axis=1).mean() > 0.95
    again = toxicity.fit(seen.repartition(7))
    assert (again.net.table == model.net.table).all() and again.net.shift == model.net.shift and again.thresholds == model.thresholds
    scored = toxicity.score(seen.withColumnRenamed("id", "doc_id"), model).toPandas()
    assert (scored.flagged == (scored.doc_id % 3 == 0)).mean() > 0.99


def test_toxicity_trains_long_texts_by_segments(monkeypatch):
    rng = random.Random(5)
    texts = [toxicity.rows_of([rng.choice([b"alpha", b"beta", b"gamma", b"delta"]) + bytes([rng.randrange(97, 123)]) for _ in range(n)]) for n in (1, 9, 40, 90)]
    whole = toxicity.train(texts, np.array([0, 1, 0, 1.0]))
    monkeypatch.setattr(toxicity, "SEGMENT_WORDS", 7)
    parts = toxicity.train(texts, np.array([0, 1, 0, 1.0]))
    assert np.allclose(whole.table, parts.table) and np.allclose(whole.out, parts.out)


def test_thresholds_by_counts():
    scores, labels = np.array([0.9, 0.8, 0.6, 0.6, 0.2, 0.2]), np.array([1, 1, 0, 0, 0, 1])
    counted = toxicity.thresholds(["a"] * 4, np.array([0.9, 0.8, 0.6, 0.2]), np.array([1, 1, 0, 0]), np.array([3, 1, 2, 5]))
    spelled = toxicity.thresholds(["a"] * 11, np.repeat([0.9, 0.8, 0.6, 0.2], [3, 1, 2, 5]), np.repeat([1, 1, 0, 0], [3, 1, 2, 5]))
    assert counted == spelled and set(toxicity.thresholds(["b"] * 6, scores, labels)) == {"b"}


def test_model_scores_words_by_the_word_before(spark):
    """Where every dish has one customer nothing is drawn by chance: the whole score against plain numbers."""
    docs = spark.createDataFrame([(0, "A b"), (1, "a b"), (2, "b a"), (3, "a new b")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.score(docs, docs["doc_id"] > 0).collect()}
    words = [b"", b"a", b"b"]
    context, symbol, _ = lm.symbols(words)
    trigrams = dict(Counter(zip(context.tolist(), symbol.tolist())))
    d, inner, outer = lm.DISCOUNT, lm.CONTEXT_STRENGTH, lm.WORD_STRENGTH
    draws = range(lm.BURN_IN, lm.SWEEPS)
    spelled = [np.exp(lm.speller(trigrams, np.random.default_rng(1_000 + k)).log_probability(words)) for k in draws]
    alone = [dict(zip(words, (1 - d + (outer + 3 * d) * s) / (outer + 3))) | {None: (outer + 3 * d) * (1 - s.sum()) / (outer + 3)} for s in spelled]
    pairs = {(b"", b"a"), (b"a", b"b"), (b"b", b"")}

    def chance(u, w):
        if u is None:
            return sum(p[w] for p in alone) / len(alone)
        return sum((((u, w) in pairs) * (1 - d) + (inner + d) * p[w]) / (inner + 1) for p in alone) / len(alone)

    for doc, text in [(1, [b"a", b"b"]), (2, [b"b", b"a"]), (3, [b"a", None, b"b"])]:
        want = sum(math.log10(chance(u, w)) for u, w in zip([b"", *text], [*text, b""]))
        assert got[doc]["score"] == pytest.approx(want, rel=1e-5)
    assert got[0]["score"] == got[1]["score"] > got[2]["score"]


def test_model_prefers_texts_in_order(spark, monkeypatch):
    """Shuffled words score lower, and chunks and parts do not change the counts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    turned = docs.select((-1 - F.col("doc_id")).alias("doc_id"), F.expr("concat_ws(' ', reverse(split(lower(text), '[ \\t\\n\\r]+')))").alias("text"))
    both = docs.union(turned)
    held = (F.col("doc_id") < 0) | (fold(both["doc_id"], 5) == 1)
    got = {r["doc_id"]: r for r in lm.score(both, held).collect()}
    gains = [got[i]["score"] - got[-1 - i]["score"] for i in got if i >= 0 and got[i]["held_out"]]
    assert np.mean(gains) > 0 and np.mean(np.array(gains) > 0) > 0.6
    monkeypatch.setattr(lm, "PART_BYTES", 100_000)
    parts = {r["doc_id"]: r for r in lm.score(both, held).collect()}
    assert all(parts[i]["n_known"] == r["n_known"] and parts[i]["base_score"] == pytest.approx(r["base_score"]) for i, r in got.items())
    assert sum(r["score"] for r in parts.values()) == pytest.approx(sum(r["score"] for r in got.values()), rel=5e-3)


def test_toxicity_deals_texts_once(spark, monkeypatch):
    """Epochs read what was dealt: no text goes through a shuffle again, and a task's shards send one sum."""
    plans, flow = [], toxicity.arrow_flow

    def seen(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return flow(df, *more)

    monkeypatch.setattr(toxicity, "arrow_flow", seen)
    rows = spark.range(900).select(F.xxhash64("id").alias("h"), F.concat(F.lit("w"), F.col("id") % 50).alias("text"), (F.col("id") % 2).cast("int").alias("toxic"))
    several = toxicity.train_shards(rows, 5, (1.0, 1.0))
    assert len(plans) == toxicity.EPOCHS and not any("Exchange" in p for p in plans)
    again = toxicity.train_shards(rows.repartition(3), 5, (1.0, 1.0))
    assert (several.table == again.table).all() and several.shift == again.shift


def test_toxicity_moves_only_labelled_texts(spark, monkeypatch):
    """Texts without a label stay where they are, the others are dealt to shards by the join itself, and once."""
    rows = spark.range(20_000).select("id", F.xxhash64(F.col("id").cast("string"), F.lit("toxic")).alias("h"))
    labelled = rows.where("id % 40 = 0")
    got = {r["id"] for r in toxicity.perhaps_met(rows, labelled.select("h"), 500).collect()}
    assert got >= set(range(0, 20_000, 40)) and len(got) < 2_500
    seen, deal = [], toxicity.cut_by
    monkeypatch.setattr(toxicity, "cut_by", lambda df, *by: seen.append((df, by)) or deal(df, *by))
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    docs = rows.select("id", F.lit("en").alias("lang"), F.when(F.col("id") % 80 == 0, "bad ugly").otherwise("good fine").alias("text"))
    labels = labelled.select("id", (F.col("id") % 80 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs.union(docs.where("id = 80")), labels.union(spark.range(1).selectExpr("cast(null as long)", "1")))
    ((df, by),) = seen
    assert by == ("body", "shard") and df.count() == 501
    assert df.rdd.glom().map(lambda part: len({r["shard"] for r in part})).max() == 1
    assert model.net.out.any() and model.thresholds.keys() == {"en"}


def test_model_keeps_pairs_in_their_parts(spark, monkeypatch):
    """Sweeps move a packet per part, no row per pair, and draws do not follow the layout of tasks."""
    seen, seat = [], lm._seat_pairs
    monkeypatch.setattr(lm, "_seat_pairs", lambda pairs, *more: seen.append(pairs.count()) or seat(pairs, *more))
    monkeypatch.setattr(lm, "PART_BYTES", 20_000)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 60), x -> concat('w', (id * 7 + x * x) % 53)))").alias("text"))
    held, rows, usual = docs["doc_id"] % 5 == 1, [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (2, 5):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            rows.append({r["doc_id"]: r["score"] for r in lm.score(docs.coalesce(1), held).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert rows[0] == rows[1] and len(rows[0]) == 400
    assert len(seen) == 2 * lm.SWEEPS and 1 < max(seen) <= 1 + 400 * 240 // 20_000
