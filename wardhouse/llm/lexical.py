"""Ranked lexical search, reversed: the items are indexed, the documents stream through.

The inverted index over the items' terms is broadcast in blocks of items of bounded size. A task counts the items' terms
in each of its documents, adds the scores of all items that share one, and keeps the best documents of every item in a
bounded heap. Heaps are merged in two steps, so that no task gets the heaps of all others for an item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.llm.common import arrow_flow, cut, plain_words, text_bytes

# What the index of a block of items may take, and what an item and a term in it count for besides the term's bytes.
INDEX_BYTES, ITEM_COST, TERM_COST = 64 << 20, 1_000, 100
# Scores and hits held at once, bytes of a text whose words are held at once.
SCORES, HITS, SLICE = 1 << 21, 1 << 20, 1 << 20
MERGE_PARTS = 64


def slices(text: bytes, most: int = SLICE) -> Iterator[list[bytes]]:
    """The terms of a text of any length, some at a time: ASCII but letters and digits separates, A-Z are lowered."""
    at = 0
    while at < len(text):
        stop = at + most
        # Bytes above 127 and alphanumerics belong to terms; a slice ends where a term does.
        while stop < len(text) and (text[stop] > 127 or chr(text[stop]).isalnum()):
            stop += 1
        yield plain_words(text[at:stop])
        at = stop


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Written rows of (row, item, terms, counts, cost); items without a term are left out."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            terms, counts = [], []
            for text in batch.column("text"):
                found: dict[bytes, int] = {}
                for words in slices(text.as_py()):
                    for word in words:
                        found[word] = found.get(word, 0) + 1
                terms.append(list(found))
                counts.append(list(found.values()))
            cost = [ITEM_COST + sum(map(len, t)) + TERM_COST * len(t) for t in terms]
            yield {"row": batch.column("row"), "item": batch.column("item"), "terms": terms, "counts": counts, "cost": cost}

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("row"), items[id_col].alias("item"), text_bytes(items, text_col).alias("text"))
    made = arrow_flow(rows, flow, f"row long, item {kind}, terms array<binary>, counts array<long>, cost long")
    return cut(made.where(F.size("terms") > 0))


def _blocks(items: DataFrame, most: int) -> tuple[DataFrame, list[int]]:
    """The items with a `block` each, whose index costs at most `most`; an item that costs more is alone in its block."""
    total, large = items.agg(F.sum("cost"), F.count(F.when(F.col("cost") > most, 1))).first()
    if not total:
        return items.withColumn("block", F.lit(0).cast("long")), []
    small, n = F.col("cost") <= most, max(1, math.ceil(total / most))
    while True:
        # Blocks of large items have numbers of their own, below zero.
        block = F.when(small, F.pmod(F.xxhash64("row"), F.lit(n))).otherwise(-1 - F.col("row"))
        dealt = items.withColumn("block", block)
        sizes = dealt.groupBy("block").agg(F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("n"))
        if sizes.where((F.col("cost") > most) & (F.col("n") > 1)).isEmpty():
            return dealt, sorted(r["block"] for r in sizes.select("block").collect())
        n *= 2


class Index:
    """Terms of a block of items, and for each term the items that have it and how often."""

    def __init__(self, rows: list):
        self.rows = np.array([r["row"] for r in rows], np.int64)
        self.numbers: dict[bytes, int] = {}
        term, item, count = [], [], []
        for j, r in enumerate(rows):
            for t, c in zip(r["terms"], r["counts"]):
                term.append(self.numbers.setdefault(bytes(t), len(self.numbers)))
                item.append(j)
                count.append(c)
        term_of = np.array(term, np.int64)
        order = np.argsort(term_of, kind="stable")
        self.items, self.counts = np.array(item, np.int64)[order], np.array(count, np.int64)[order]
        self.sizes = np.bincount(term_of, minlength=len(self.numbers))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = int(np.bincount(np.array(item, np.int64), weights=np.array(count)).max(initial=0))

    def numbers_of(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """(number of all terms, numbers of the known ones, their counts) of a document."""
        size, found, times = 0, [], []
        for words in slices(text):
            size += len(words)
            known = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int32, len(words))
            number, count = np.unique(known[known >= 0], return_counts=True)
            found.append(number)
            times.append(count)
        if len(found) > 1:
            number, back = np.unique(np.concatenate(found), return_inverse=True)
            return size, number, np.bincount(back, weights=np.concatenate(times)).astype(np.int64)
        return (size, found[0], times[0]) if found else (0, np.zeros(0, np.int32), np.zeros(0, np.int64))


class Heaps:
    """Per item its `k` best documents, best first: larger score, then smaller id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores, self.ids = np.zeros((items, k), np.int64), np.zeros((items, k), np.int64)
        self.nulls = np.ones((items, k), bool)

    def update(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        """`scores` of documents by items; zero means no match."""
        doc, item = np.nonzero((scores >= self.scores[:, -1]) & (scores > 0))
        if not len(doc):
            return
        touched = np.unique(item)
        item_all = np.concatenate([item, np.repeat(touched, self.k)])
        score_all = np.concatenate([scores[doc, item], self.scores[touched].ravel()])
        id_all = np.concatenate([ids[doc], self.ids[touched].ravel()])
        null_all = np.concatenate([nulls[doc], self.nulls[touched].ravel()])
        order = np.lexsort((id_all, null_all, -score_all, item_all))
        start = np.searchsorted(item_all[order], touched)
        best = order[(start[:, None] + np.arange(self.k)[None, :])]
        self.scores[touched], self.ids[touched], self.nulls[touched] = score_all[best], id_all[best], null_all[best]


def _counted(docs: DataFrame, held, id_col: str, text_col: str) -> DataFrame:
    """Written rows of (id, n, terms, counts): a document's number of terms, and the index's terms in it."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        index = held.value
        for batch in batches:
            found = [index.numbers_of(text.as_py()) for text in batch.column("text")]
            offsets = pa.array(np.cumsum([0, *(len(x[1]) for x in found)]), pa.int32())
            yield {
                "id": batch.column("id"),
                "n": [x[0] for x in found],
                "terms": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[1] for x in found]), pa.int32())),
                "counts": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[2] for x in found]), pa.int32())),
            }

    rows = docs.select(docs[id_col].cast("long").alias("id"), text_bytes(docs, text_col).alias("text"))
    return cut(arrow_flow(rows, flow, "id long, n long, terms array<int>, counts array<int>"))


def _document_counts(counted: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term of the index is; every task counts its documents first."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
        met = np.flatnonzero(total)
        yield {"term": pa.array(met), "df": pa.array(total[met])}

    out = np.zeros(terms, np.int64)
    for r in arrow_flow(counted.select("terms"), flow, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def _best(counted: DataFrame, held, docs: int, words: int, weights: np.ndarray, k: int) -> DataFrame:
    """(row, part, id, score): every task's heaps."""

    def contributions(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = batch.column("terms")
        sizes = np.diff(lists.offsets.to_numpy())
        term, tf = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy().astype(np.int64)
        # Python numbers: the product may leave the longs where the quotient does not.
        length = np.array([75 + 25 * n * docs // words for n in batch.column("n").to_pylist()], np.int64)
        return sizes, term, weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(length, sizes)))

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        index = held.value
        heaps, items = Heaps(len(index.rows), k), len(index.rows)
        exact_in_doubles = index.words * int(weights.max(initial=0)) * 10**6 < 2**53
        for batch in batches:
            sizes, term, share = contributions(batch)
            ids = batch.column("id")
            nulls, ids = np.array(ids.is_null()), ids.fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            hits = np.cumsum(index.sizes[term])
            hits = np.r_[0, hits][ends]
            at, most = 0, max(1, SCORES // items)
            while at < len(sizes):
                before = hits[at - 1] if at else 0
                stop = min(max(int(np.searchsorted(hits, before + HITS, "right")), at + 1), at + most, len(sizes))
                span = slice(ends[at] - sizes[at], ends[stop - 1])
                fan = index.sizes[term[span]]
                doc = np.repeat(np.repeat(np.arange(stop - at), sizes[at:stop]), fan)
                place = np.repeat(index.starts[term[span]] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
                value = np.repeat(share[span], fan) * index.counts[place]
                cell = doc * items + index.items[place]
                if exact_in_doubles:
                    scores = np.bincount(cell, weights=value, minlength=(stop - at) * items).astype(np.int64)
                else:
                    scores = np.zeros((stop - at) * items, np.int64)
                    np.add.at(scores, cell, value)
                heaps.update(scores.reshape(-1, items), ids[at:stop], nulls[at:stop])
                at = stop
        item, place = np.nonzero(heaps.scores)
        yield {
            "row": pa.array(index.rows[item]),
            "id": pa.array(heaps.ids[item, place], mask=heaps.nulls[item, place]),
            "score": pa.array(heaps.scores[item, place]),
        }

    tops = arrow_flow(counted, flow, "row long, id long, score long")
    return tops.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)))


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """The `k` best documents with a score above 0 for each item: the item's id, rank, the document's id, score.

    Terms are maximal runs of letters, digits and other characters beyond ASCII, A-Z lowered; null texts have none, and items
    without terms give no rows. Equal scores rank by ascending id, null ids last. Documents that repeat an id, and items that
    do, each count and rank for themselves. Document ids are integers. Other columns are ignored; empty tables give no rows.
    Items whose index would exceed `index_bytes` go in blocks, each a pass over the documents; results do not change.
    """
    spark = docs.sparkSession
    dealt, blocks = _blocks(_item_terms(items, item_col, item_text_col), index_bytes)
    found = spark.createDataFrame([], "row long, part int, id long, score long")
    size = None
    for block in blocks:
        index = Index(dealt.where(F.col("block") == block).select("row", "terms", "counts").orderBy("row").collect())
        held = spark.sparkContext.broadcast(index)
        counted = _counted(docs, held, id_col, text_col)
        size = size or counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not size[0]:
            break
        in_docs = _document_counts(counted, len(index.numbers))
        weights = np.array([math.floor(1000 * math.log((2 * size[0] + 2) / (2 * int(d) + 1))) for d in in_docs], np.int64)
        tops = _best(counted.where("size(terms) > 0"), held, size[0], size[1], weights, k)
        found = found.unionByName(cut(tops) if len(blocks) > 1 else tops)

    order = (F.desc("score"), F.asc_nulls_last("id"))
    for keys in (("row", "part"), ("row",)):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    names = dealt.select("row", F.col("item").alias(item_col))
    return names.join(found, "row").select(item_col, "rank", F.col("id").alias(id_col), "score")
