"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at a small Hamming distance. Anchors are the codewords of a covering code, here the product
of two perfect Golay codes over bits 63..41 and 40..18: every word of 23 bits has exactly one codeword within 3 bits.
A fingerprint's home is its nearest anchor. If two fingerprints differ in d bits, the second lies within 3 + d_i bits of
the first one's home in each half, with d_1 + d_2 <= d. So each distinct fingerprint is copied to every anchor within
that reach, and an equi-join of homes with copies meets every link; the distance is then checked on all 64 bits.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardhouse.llm.common import arrow_map, cut, text_bytes
from wardhouse.llm.components import components
from wardhouse.llm.exact_dedup import take

SEED = 42
WIDTH, RADIUS = 23, 3
# Generator polynomial of the binary Golay code (fixed value): x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101


def fingerprint(data: bytes, shingle: int) -> int:
    """As a signed 64-bit number. Words are split at ASCII white space and A-Z lowered; no words give 0."""
    words = data.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        starts, ends = [0], [len(line)]
    else:
        after = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *after[: len(words) - shingle].tolist()]
        ends = (after[shingle - 1 :] - 1).tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for k in range(0, len(starts), 65536):
        hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[k : k + 65536], ends[k : k + 65536])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Columns id, sha (of the whole text), fp."""

    def per_task():
        return lambda batch: {
            "id": batch.column("id"),
            "sha": batch.column("sha"),
            "fp": [fingerprint(t, shingle) for t in batch.column("text").to_pylist()],
        }

    body = text_bytes(df, text_col)
    source = df.select(df[id_col].alias("id"), F.sha2(body, 256).alias("sha"), body.alias("text"))
    return arrow_map(source, per_task, f"id {df.schema[id_col].dataType.simpleString()}, sha string, fp long")


@functools.cache
def _coset_table(reach: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For each syndrome the error vectors of weight up to RADIUS + reach, padded, with their weight above RADIUS
    (padding has a large one); and tables that give a word's syndrome by its bytes."""
    rest = [1 << i for i in range(WIDTH)]
    for i in range(WIDTH):
        for j in range(WIDTH - 1, 10, -1):
            if rest[i] >> j & 1:
                rest[i] ^= GOLAY << (j - 11)
    by_byte = [np.zeros(256, np.int64) for _ in range(3)]
    for k in range(3):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and 8 * k + bit < WIDTH:
                    by_byte[k][value] ^= rest[8 * k + bit]
    found: list[list[tuple[int, int]]] = [[] for _ in range(2048)]
    for weight in range(RADIUS + reach + 1):
        for bits in combinations(range(WIDTH), weight):
            syndrome = functools.reduce(lambda s, i: s ^ rest[i], bits, 0)
            found[syndrome].append((sum(1 << i for i in bits), max(0, weight - RADIUS)))
    widest = max(map(len, found))
    errors, excess = np.zeros((2048, widest), np.int64), np.full((2048, widest), 99, np.int64)
    for s, entries in enumerate(found):
        errors[s, : len(entries)] = [e for e, _ in entries]
        excess[s, : len(entries)] = [x for _, x in entries]
    return errors, excess, by_byte


def anchors(fps: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into fps, anchor) of every anchor within the covering radius plus `reach`; reach 0 gives the home only."""
    errors, excess, by_byte = _coset_table(reach)
    words, above = [], []
    for shift in (41, 18):
        word = fps >> shift & ((1 << WIDTH) - 1)
        syndrome = by_byte[0][word & 255] ^ by_byte[1][word >> 8 & 255] ^ by_byte[2][word >> 16]
        words.append(word[:, None] ^ errors[syndrome])
        above.append(excess[syndrome])
    row, i, j = np.nonzero(above[0][:, :, None] + above[1][:, None, :] <= reach)
    return row, words[0][row, i] << WIDTH | words[1][row, j]


def _placed(fps: DataFrame, reach: int) -> DataFrame:
    def per_task():
        def step(batch: pa.RecordBatch) -> dict:
            values = batch.column("fp").to_numpy()
            row, anchor = anchors(values, reach)
            return {"anchor": anchor, "fp": values[row]}

        return step

    return arrow_map(fps.select("fp"), per_task, "anchor long, fp long")


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Pairs a < b of the distinct fingerprints in `fps` that differ in at most `max_bits` bits, each once.

    The anchor of the join is the smaller one's home. A fingerprint has a bounded number of neighbours within the
    distance, so the pairs stay in proportion to distinct fingerprints, however many documents share one.

    Spark takes the copies for as many rows as there are fingerprints (they are some 60 times as many) and would broadcast
    them, so both sides are shuffled whatever their estimate.
    """
    homes = _placed(fps, 0).withColumnRenamed("fp", "a")
    copies = _placed(fps, max_bits).withColumnRenamed("fp", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return homes.join(copies.hint("merge"), "anchor").where((F.col("a") < F.col("b")) & close).select("a", "b")


def _grouped(df: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    rows = cut(fingerprints(df, id_col, text_col, shingle))
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    labels = components(links(rows.select("fp").distinct(), max_bits))
    own = least.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    own = cut(own.select("fp", "least", F.coalesce("label", "fp").alias("label")))
    ids = own.groupBy("label").agg(F.min("least").alias("component_id"))
    return rows.join(own.join(ids, "label").select("fp", "label", "component_id"), "fp")


def simhash_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """One row per row of `df`: id, `fingerprint` (16 hex digits), `component_id`.

    A bit of the fingerprint is 1 if set in over half of the hashes (XXH64, seed 42) of all word shingles, repeats
    included. Fewer words than a shingle: one shingle of all; none (null and empty texts): zero, linked like any other.
    `component_id` is the smallest id that links reach; null ids count only if a component has no other, and then it
    is null. Repeated rows are rows of the same component. Other columns are ignored; no rows give no rows.
    """
    out = _grouped(df, id_col, text_col, shingle, max_bits)
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """The rows of `docs` with the smallest id of their component, one each, with all their columns."""
    members = _grouped(docs, id_col, text_col, shingle, max_bits).where("id <=> component_id")
    # Rows that repeat the smallest id, with any text, count once: the least text digest stays.
    chosen = members.groupBy("id", "label").agg(F.min("sha").alias("sha"))
    return take(docs, chosen, F.sha2(text_bytes(docs, text_col), 256), id_col, text_col)
