"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of a row from each of three hashed tables: two by the whole word, so that two words share
both rows almost never, and one by its first bytes, so that words of one stem are alike.
Filters of several widths run over the words; each keeps its largest response in the text, and a logistic unit scores
these. Every labelled row trains or calibrates, in shards whose parameters are averaged; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardhouse.llm.common import arrow_flow, arrow_map, carried, cut, plain_words, scratch_folder, text_bytes

THRESHOLD = 0.3
EPOCHS = 3
# Rows that a shard trains in turn; a larger table has more shards.
SHARD_ROWS = 8_000
# Binary logarithm of the bits that mark labelled ids.
MOST_BITS = 27
# Moves of parameters are added as multiples of 1 / SCALE.
SCALE = float(1 << 32)
# Thresholds that a language may get.
GRID = [k / 20 for k in range(1, 20)]
TABLES, TABLE, SIZE, FILTERS, WIDTHS = 3, 1 << 16, 8, 8, (1, 2, 3)
# Bytes of a word that the third table hashes.
HEAD = 5
PAD = TABLES * TABLE
SEGMENT_WORDS, CACHE_WORDS = 30_000, 120_000

@dataclass
class Network:
    table: np.ndarray  # the hashed tables and the padding row
    filters: list[np.ndarray]  # by width: (width, SIZE, FILTERS)
    bias: np.ndarray  # (len(WIDTHS), FILTERS)
    out: np.ndarray  # (len(WIDTHS) * FILTERS,)
    shift: float


def rows_of(words: list[bytes]) -> np.ndarray:
    """Each word's row in each of the tables."""
    h = np.frombuffer(b"".join([xxhash.xxh64_digest(w) for w in words]), ">u8")
    head = np.frombuffer(b"".join([xxhash.xxh32_digest(w[:HEAD]) for w in words]), ">u4")
    parts = [h % TABLE, (h >> 32) % TABLE + TABLE, head.astype(np.uint64) % TABLE + 2 * TABLE]
    return np.stack(parts, axis=1).astype(np.int64).reshape(-1, TABLES)


def _padded(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.full((max(WIDTHS) - 1 + (len(rows) == 0), TABLES), PAD)])


def fresh(seed: int = 7) -> Network:
    """A network before training, and the generator that drew it goes on in `train`."""
    return _drawn(np.random.default_rng(seed))


def _drawn(rng: np.random.Generator) -> Network:
    return Network(
        np.r_[rng.normal(0, 0.02, (PAD, SIZE)), np.zeros((1, SIZE))],
        [rng.normal(0, 0.5 / np.sqrt(w * SIZE), (w, SIZE, FILTERS)) for w in WIDTHS],
        np.zeros((len(WIDTHS), FILTERS)),
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS),
        0.0,
    )


class Trainer:
    """Adagrad on the logistic loss, one text at a time; a maximum passes its gradient to the window it came from."""

    def __init__(self, net: Network, steps: Network | None = None, rate: float = 0.1):
        self.net, self.rate = net, rate
        self.steps = steps or first_steps()
        self.touched = np.zeros(PAD + 1, bool)

    def _windows(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The largest response of every filter, and by width the table rows of its window: (FILTERS, width, TABLES). Texts
        are cut into segments that overlap by the widest filter, so memory does not follow their length."""
        net, best, windows = self.net, None, []
        total = len(rows) - max(WIDTHS) + 1
        for start in range(0, total, SEGMENT_WORDS):
            n = min(SEGMENT_WORDS, total - start)
            part = rows[start : start + n + max(WIDTHS) - 1]
            words = net.table[part].sum(axis=1)
            pooled, found = [], []
            for f, b in zip(net.filters, net.bias):
                response = sum(words[j : j + n] @ f[j] for j in range(len(f))) + b
                at = response.argmax(axis=0)
                pooled.append(response[at, np.arange(FILTERS)])
                found.append(part[at[:, None] + np.arange(len(f))])
            if best is None:
                best, windows = np.array(pooled), found
                continue
            for i, (own, new) in enumerate(zip(windows, found)):
                own[pooled[i] > best[i]] = new[pooled[i] > best[i]]
            best = np.maximum(best, pooled)
        return best, windows

    def step(self, rows: np.ndarray, label: float, weight: float = 1.0) -> None:
        net, steps, rate = self.net, self.steps, self.rate
        pooled, windows = self._windows(_padded(rows))
        hidden = np.tanh(pooled.ravel())
        error = weight * (1 / (1 + np.exp(-np.clip(hidden @ net.out + net.shift, -30, 30))) - label)
        back = (error * net.out * (1 - hidden**2)).reshape(len(WIDTHS), FILTERS)
        g_out = error * hidden
        steps.out += g_out**2
        net.out -= rate * g_out / np.sqrt(steps.out)
        steps.shift += error**2
        net.shift -= rate * error / np.sqrt(steps.shift)
        steps.bias += back**2
        net.bias -= rate * back / np.sqrt(steps.bias)
        touched, grads = [], []
        for i, (f, window) in enumerate(zip(net.filters, windows)):
            g = np.zeros(f.shape)
            for j in range(len(f)):
                g[j] = net.table[window[:, j]].sum(axis=1).T * back[i]
                touched.append(window[:, j])
                grads.append(back[i][:, None] * f[j].T)
            steps.filters[i] += g**2
            f -= rate * g / np.sqrt(steps.filters[i])
        touched, grads = np.concatenate(touched), np.concatenate(grads)
        unique, place = np.unique(touched.ravel(), return_inverse=True)
        g = np.zeros((len(unique), SIZE))
        np.add.at(g, place, np.repeat(grads, TABLES, axis=0))
        g[unique == PAD] = 0
        steps.table[unique] += g**2
        net.table[unique] -= rate * g / np.sqrt(steps.table[unique])
        self.touched[unique] = True


def first_steps() -> Network:
    """Sums of squared gradients before training, in the shape of the network."""
    return Network(
        np.full((PAD + 1, SIZE), 1e-4),
        [np.full((w, SIZE, FILTERS), 1e-4) for w in WIDTHS],
        np.full((len(WIDTHS), FILTERS), 1e-4),
        np.full(len(WIDTHS) * FILTERS, 1e-4),
        1e-4,
    )


def train(samples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, seed: int = 7) -> Network:
    """In one process, over texts in a random order in every epoch."""
    rng = np.random.default_rng(seed)
    trainer = Trainer(_drawn(rng), rate=rate)
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            trainer.step(samples[k], labels[k])
    trainer.net.table = trainer.net.table.astype(np.float32)
    return trainer.net


def _flat(net: Network) -> np.ndarray:
    """All parameters as rows of SIZE: the table first, then the rest, filled up with zeros."""
    rest = np.concatenate([*[f.ravel() for f in net.filters], net.bias.ravel(), net.out, [net.shift]])
    rest = np.concatenate([rest, np.zeros(-len(rest) % SIZE)])
    return np.concatenate([net.table, rest.reshape(-1, SIZE)])


def _network(flat: np.ndarray) -> Network:
    rest = flat[PAD + 1 :].ravel().copy()
    sizes = [w * SIZE * FILTERS for w in WIDTHS] + [len(WIDTHS) * FILTERS] * 2
    *filters, bias, out, shift = np.split(rest, np.cumsum(sizes))
    shapes = [(w, SIZE, FILTERS) for w in WIDTHS]
    filters = [f.reshape(shape) for f, shape in zip(filters, shapes)]
    return Network(flat[: PAD + 1].copy(), filters, bias.reshape(len(WIDTHS), FILTERS), out, float(shift[0]))


def cut_by(df: DataFrame, *columns: str) -> DataFrame:
    """As `cut`, for rows dealt so that a value of `columns` is in one task only: each value's rows are one row group of a
    file of their own, so one task reads them together again, in every pass and without a shuffle."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.partitionBy(*columns).option("parquet.block.size", 1 << 30).parquet(folder, compression="zstd")
    return spark.read.schema(df.schema).parquet(folder).select(df.columns)


def perhaps_met(rows: DataFrame, hashes: DataFrame, n: int) -> DataFrame:
    """The `rows` whose h is one of the `n` distinct values in `hashes` (h), and few others: a bitmap of the hashes, at most
    16 MB of it, is broadcast, so that rows are left out before they pass a shuffle. A join must follow."""
    bits = 1 << min(MOST_BITS, max(15, (16 * n).bit_length()))
    place = F.pmod("h", F.lit(bits))
    block, bit = F.shiftright(place, 15).alias("_block"), F.pmod(place, F.lit(1 << 15))
    bitmap = hashes.groupBy(block).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    marked = rows.select("*", block, bit.alias("_bit")).join(F.broadcast(bitmap), "_block")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return marked.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 as int))")) != 0).select(*rows.columns)


def train_shards(rows: DataFrame, shards: int, weights: tuple[float, float], epochs: int = EPOCHS) -> Network:
    """Trains on every row of `rows` (h, text, toxic), in `shards` of equal hash ranges, or as a column `shard` says of rows
    that `cut_by` wrote.

    In each epoch every shard goes on from the common network, text by text in an order of its own; then each parameter
    moves by the mean move of the shards that touched it. Moves are added as integers, so the result does not depend on
    the order in which shards end. `weights` are those of the classes' gradients. Tasks hold one text, the network and the
    sum of their shards' moves, so what they send does not grow with the number of shards. Rows are dealt once.
    """
    flat, steps = _flat(fresh()), _flat(first_steps())
    columns = [f"v{i}" for i in range(2 * SIZE)]
    schema = ", ".join(["row int", "n long", *[f"{c} long" for c in columns]])
    # More ranges than shards: bounds fall between all shards, while hashes would put several into one task.
    dealt = rows
    if "shard" not in rows.columns:
        dealt = rows.select(F.pmod(F.shiftright("h", 8), F.lit(shards)).alias("shard"), "h", "text", "toxic")
        dealt = cut_by(dealt.repartitionByRange(4 * shards, "shard"), "shard")
    for epoch in range(epochs):

        def flow(batches: Iterator[pa.RecordBatch], flat=flat, steps=steps) -> Iterator[dict]:
            trainer, shard = None, None
            times, sums = np.zeros(len(flat), np.int64), np.zeros((len(flat), 2 * SIZE), np.int64)

            def add_moves() -> None:
                touched = np.flatnonzero(np.r_[trainer.touched, np.ones(len(flat) - PAD - 1, bool)])
                moved = np.c_[_flat(trainer.net)[touched] - flat[touched], _flat(trainer.steps)[touched] - steps[touched]]
                times[touched] += 1
                sums[touched] += np.rint(moved * SCALE).astype(np.int64)

            for batch in batches:
                for own, text, label in zip(*(batch.column(c) for c in ("shard", "text", "toxic"))):
                    own, label = own.as_py(), label.as_py()
                    if own != shard:
                        if trainer is not None:
                            add_moves()
                        trainer, shard = Trainer(_network(flat), _network(steps)), own
                    trainer.step(rows_of(plain_words(text.as_py())), float(label), weights[label])
            if trainer is not None:
                add_moves()
                met = np.flatnonzero(times)
                yield {"row": met.astype(np.int32), "n": times[met], **{c: sums[met, i] for i, c in enumerate(columns)}}

        turn = dealt.withColumn("turn", F.xxhash64("h", F.lit(epoch)))
        placed = turn.sortWithinPartitions("shard", "turn", "text", "toxic")
        found = arrow_flow(placed.select("shard", "text", "toxic"), flow, schema)
        sums = found.groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns]).toArrow()
        at, n = sums.column("row").to_numpy(), sums.column("n").to_numpy()
        for i, c in enumerate(columns):
            (flat if i < SIZE else steps)[at, i % SIZE] += sums.column(c).to_numpy() / n / SCALE
    net = _network(flat)
    net.table = net.table.astype(np.float32)
    return net


class Scorer:
    """Scores texts; for each word met it keeps the sums of its embedding with every filter column, up to CACHE_WORDS."""

    def __init__(self, net: Network):
        self.net = net
        columns = np.concatenate([f[j] for f in net.filters for j in range(len(f))], axis=1)
        self.shares = net.table.astype(np.float32) @ columns.astype(np.float32)
        # Row 0 is the padding word.
        self.known = np.empty((1 + CACHE_WORDS + SEGMENT_WORDS * 2, self.shares.shape[1]), np.float32)
        self.known[0] = self.shares[PAD] * TABLES
        self.number: dict[bytes, int] = {}

    def learn(self, words: list[list[bytes]]) -> None:
        new = [w for w in set().union(*words) if w not in self.number]
        if len(self.number) + len(new) > CACHE_WORDS:
            self.number.clear()
            new = list(set().union(*words))
        if new:
            at, rows = len(self.number) + 1, rows_of(new)
            self.known[at : at + len(new)] = sum(self.shares[rows[:, t]] for t in range(TABLES))
            self.number.update(zip(new, range(at, at + len(new))))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """Texts are cut into segments that overlap by the widest filter, so memory does not follow their length."""
        best = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, np.float32)
        todo, held = [], 0
        for k, text in enumerate(texts):
            words = plain_words(text)
            for at in range(0, max(1, len(words)), SEGMENT_WORDS):
                part = words[at : at + SEGMENT_WORDS + max(WIDTHS) - 1]
                todo.append((k, part))
                held += len(part)
                if held >= SEGMENT_WORDS:
                    self._pool(todo, best)
                    todo, held = [], 0
        if todo:
            self._pool(todo, best)
        z = np.tanh(best.astype(float)) @ self.net.out + self.net.shift
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def _pool(self, todo: list[tuple[int, list[bytes]]], best: np.ndarray) -> None:
        self.learn([part for _, part in todo])
        # Between texts stand padding words, so that no window has words of two; a window that starts with one is none.
        gap = [0] * (max(WIDTHS) - 1)
        flat, starts = [], []
        for _, part in todo:
            starts.append(len(flat))
            flat += map(self.number.__getitem__, part)
            flat += gap if part else [0, *gap]
        flat = np.array(flat)
        n = len(flat) - len(gap)
        none = flat[:n] == 0
        none[[s for s, (_, part) in zip(starts, todo) if not part]] = False
        sums, column = self.known[flat], 0
        owner = np.array([k for k, _ in todo])
        for i, width in enumerate(WIDTHS):
            response = self.net.bias[i].astype(np.float32)
            for j in range(width):
                response = response + sums[j : j + n, column : column + FILTERS]
                column += FILTERS
            response[none] = -np.inf
            np.maximum.at(best[:, i * FILTERS : (i + 1) * FILTERS], owner, np.maximum.reduceat(response, starts, axis=0))


@dataclass
class Model:
    net: Network
    offset: float  # added to the score's logit: classes weigh the same in training, the corpus has shares
    thresholds: dict[str, float]  # by language


def _logit_shift(p: np.ndarray, offset: float) -> np.ndarray:
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return 1 / (1 + np.exp(-(np.log(p / (1 - p)) + offset)))


def fit(rows: DataFrame, labels: DataFrame | None = None) -> Model:
    """Learns from `rows` (id, text, lang) and `labels` (id, toxic), or from `rows` that hold `toxic` themselves.

    Rows with a null label or id are not used, rows with an id hash of 4 modulo 5 only calibrate: for each language the
    threshold with the best F1, its ties resolved towards THRESHOLD. All others train, each with its whole text; the classes
    weigh the same. Only parameters of the network and counts by language and score reach the driver. Without training
    rows of both classes every score is the share of label 1 (0 without labels).
    """
    if labels is None:
        labels = rows.where("id is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = labels.select("id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    # Texts and labels are dealt by the same hash of the id, so they need its common type.
    kind = rows.select("id").union(known.select("id")).schema["id"].dataType
    hashed = F.xxhash64(F.col("id").cast("string"), F.lit("toxic")).alias("h")
    texts = rows.where("id is not null").select(F.col("id").cast(kind).alias("id"), hashed, F.col("lang").cast("string").alias("lang"), text_bytes(rows, "text").alias("text"))
    known = known.select(F.col("id").cast(kind).alias("id"), "toxic")
    # Ids alone are met first: they tell how many shards there are, and which texts need to pass the shuffle.
    # Labels grow with the texts and are small only as a compressed file, so they are not broadcast.
    met = cut(texts.select("id", "h").join(known.hint("merge"), "id").select("h", "toxic"))
    body = F.pmod("h", F.lit(5)) < 4
    counted = {(r["toxic"], r["body"]): r["n"] for r in met.groupBy("toxic", body.alias("body")).agg(F.count(F.lit(1)).alias("n")).collect()}
    one, zero = (counted.get((label, True), 0) + counted.get((label, False), 0) for label in (1, 0))
    ones, zeros = counted.get((1, True), 0), counted.get((0, True), 0)
    if not ones or not zeros:
        net = train([], np.zeros(0), epochs=0)
        net.out[:] = 0
        net.shift = -30.0 if not one else 30.0 if not zero else float(np.log(one / zero))
        return Model(net, 0.0, {})
    weights = ((ones + zeros) / (2 * zeros), (ones + zeros) / (2 * ones))
    shards = -(-(ones + zeros) // SHARD_ROWS)
    # Texts and labels pass one shuffle, to the task of their shard, and meet there by a window instead of a join.
    shard = F.pmod(F.hash("id"), F.lit(shards)).alias("shard")
    both = perhaps_met(texts, met.select("h"), one + zero).unionByName(known, allowMissingColumns=True).select("*", shard)
    own = F.collect_list("toxic").over(Window.partitionBy("shard", "id"))
    labelled = both.repartitionById(shards, "shard").select("shard", "h", "lang", "text", own.alias("own")).where("text is not null")
    labelled = cut_by(labelled.select(body.alias("body"), "shard", "h", "lang", "text", F.explode("own").alias("toxic")), "body", "shard")
    net = train_shards(labelled.where("body").select("shard", "h", "text", "toxic"), shards, weights)
    offset = float(np.log(one / zero))
    grid = np.array(GRID)

    def per_task():
        scorer = Scorer(net)

        def step(batch: pa.RecordBatch) -> dict:
            found = _logit_shift(scorer(batch.column("text").to_pylist()), offset)
            reached = np.searchsorted(grid, found, side="right")
            return {"lang": batch.column("lang"), "reached": reached.astype(np.int32), "toxic": batch.column("toxic")}

        return step

    held = labelled.where(~F.col("body") & F.col("lang").isNotNull()).select("lang", "text", "toxic")
    bins = arrow_map(held, per_task, "lang string, reached int, toxic int").groupBy("lang", "reached", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    # The largest threshold that a score reaches stands for it.
    scores = np.array([0.0, *GRID])[[r["reached"] for r in bins]]
    return Model(net, offset, thresholds([r["lang"] for r in bins], scores, np.array([r["toxic"] for r in bins]), np.array([r["n"] for r in bins])))


def thresholds(langs: list[str | None], scores: np.ndarray, labels: np.ndarray, times: np.ndarray | None = None) -> dict[str, float]:
    """The best threshold by language; a row counts as many `times`."""
    out = {}
    times = np.ones(len(labels), np.int64) if times is None else times
    for lang in {x for x in langs if x is not None}:
        mine = np.array([x == lang for x in langs])
        s, y, n = scores[mine], labels[mine], times[mine]
        if 0 < (y * n).sum() < n.sum():
            best = max(
                GRID,
                key=lambda t: (round(2 * (y * n)[s >= t].sum() / (n[s >= t].sum() + (y * n).sum()), 9), -round(abs(t - THRESHOLD), 9)),
            )
            out[lang] = best
    return out


def score(
    df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", carry: bool = False
) -> DataFrame:
    """One row per row of `df`: id (with `carry` all its columns, as a struct), `score` (of the whole text alone), `predicted` (score >= 0.3), `threshold` of the
    row's language (0.3 where none was calibrated) and `flagged` (score >= threshold).

    Null and empty texts are scored as a text without words. Ids may be null or repeated; other columns are ignored.
    """

    def per_task():
        scorer = Scorer(model.net)

        def step(batch: pa.RecordBatch) -> dict:
            found = _logit_shift(scorer(batch.column("text").to_pylist()), model.offset)
            limit = [model.thresholds.get(x, THRESHOLD) for x in batch.column("lang").to_pylist()]
            return {
                "id": batch.column("id"),
                "score": found,
                "predicted": (found >= THRESHOLD).astype(np.int32),
                "threshold": limit,
                "flagged": found >= np.array(limit),
            }

        return step

    kept, field = carried(df, id_col, carry)
    source = df.select(kept, text_bytes(df, text_col).alias("text"), df[lang_col].cast("string").alias("lang"))
    columns = "score double, predicted int, threshold double, flagged boolean"
    return arrow_map(source, per_task, T.StructType([field, *T.StructType.fromDDL(columns)])).withColumnRenamed("id", id_col)
