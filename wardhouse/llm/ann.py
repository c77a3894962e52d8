"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Points join a shard's graph in blocks. For each point a greedy search proposes neighbours; relaxed distance pruning
keeps a diverse few: a candidate goes when a nearer kept one is closer to it, by a factor, than the point itself is.
Edges back are added and pruned alike. Queries run a beam search in every shard, and the shards' results are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.llm.common import cut

# Distinct vectors of a shard, and queries of a block: what one task holds.
SHARD_ROWS, QUERY_ROWS = 8_192, 50_000
DEGREE, BUILD_BEAM, BEAM, RELAX, BLOCK = 24, 48, 96, 1.2, 256
COPIES_PARTS = 16


def usable(vector: Column) -> Column:
    """Not null, not zero, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _search(points: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int):
    """Greedy search of all queries in lockstep: (nodes, distances) of the `beam` best met, nearest first; -1 pads."""
    n, rows = len(queries), np.arange(len(queries))
    norms = np.einsum("ij,ij->i", points, points)
    own = np.einsum("ij,ij->i", queries, queries)
    nodes, dist = np.full((n, beam), -1), np.full((n, beam), np.inf)
    nodes[:, 0] = start
    dist[:, 0] = norms[start] + own - 2 * queries @ points[start]
    done = np.zeros((n, beam), bool)
    met = np.zeros((n, len(points)), bool)
    met[:, start] = True
    while True:
        open_dist = np.where(done | (nodes < 0), np.inf, dist)
        pick = open_dist.argmin(axis=1)
        busy = np.flatnonzero(np.isfinite(open_dist[rows, pick]))
        if not len(busy):
            return nodes, dist
        done[busy, pick[busy]] = True
        near = graph[nodes[busy, pick[busy]]]
        fresh = (near >= 0) & ~met[busy[:, None], near]
        met[busy[:, None], np.where(fresh, near, start)] = True
        d = norms[near] + own[busy, None] - 2 * np.einsum("ikj,ij->ik", points[near], queries[busy])
        d[~fresh] = np.inf
        all_nodes = np.concatenate([nodes[busy], np.where(fresh, near, -1)], axis=1)
        all_dist = np.concatenate([dist[busy], d], axis=1)
        all_done = np.concatenate([done[busy], np.zeros(near.shape, bool)], axis=1)
        keep = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
        nodes[busy] = np.take_along_axis(all_nodes, keep, 1)
        dist[busy] = np.take_along_axis(all_dist, keep, 1)
        done[busy] = np.take_along_axis(all_done, keep, 1)


def _prune(points: np.ndarray, centers: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """For each center the diverse few of its candidates (-1 pads), nearest first."""
    n, rows = len(centers), np.arange(len(centers))
    vectors = points[candidates]
    norms = np.einsum("ikj,ikj->ik", vectors, vectors)
    products = vectors @ vectors.transpose(0, 2, 1)
    own = points[centers]
    d = norms + np.einsum("ij,ij->i", own, own)[:, None] - 2 * (vectors @ own[:, :, None])[:, :, 0]
    d[(candidates < 0) | (candidates == centers[:, None])] = np.inf
    kept = np.full((n, degree), -1)
    for k in range(degree):
        best = d.argmin(axis=1)
        ok = np.isfinite(d[rows, best])
        if not ok.any():
            break
        kept[ok, k] = candidates[rows, best][ok]
        between = norms + norms[rows, best][:, None] - 2 * products[rows, best]
        d[(relax**2 * between <= d) & ok[:, None]] = np.inf
        d[rows, best] = np.inf
    return kept


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX) -> tuple[np.ndarray, int]:
    """(neighbours by point, start point) of distinct points. A point chooses `degree` neighbours; edges back may double
    them before it is pruned again."""
    points = points.astype(np.float32)
    n = len(points)
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    graph = np.full((n, 2 * degree), -1)
    order = np.random.default_rng(5).permutation(n)
    # The start knows some points from the first, so that the blocks that follow have somewhere to go.
    first = order[order != start][:degree]
    graph[start, : len(first)] = first
    at = 0
    while at < n:
        # Blocks grow with the graph, so that a block's points find neighbours that are linked already.
        block = order[at : at + min(BLOCK, max(16, at))]
        at += len(block)
        found, _ = _search(points, graph, start, points[block], beam)
        chosen = _prune(points, block, _unique(np.concatenate([found, graph[block]], axis=1)), degree, relax)
        graph[block] = -1
        graph[block, :degree] = chosen
        heads, tails = np.repeat(block, degree), chosen.ravel()
        heads, tails = heads[tails >= 0], tails[tails >= 0]
        by_tail = np.argsort(tails, kind="stable")
        heads, tails = heads[by_tail], tails[by_tail]
        unique, place, count = np.unique(tails, return_index=True, return_counts=True)
        extra = np.full((len(unique), count.max(initial=0)), -1)
        extra[np.repeat(np.arange(len(unique)), count), np.arange(len(tails)) - np.repeat(place, count)] = heads
        # Largest first, so that the gaps (-1) are last.
        merged = -np.sort(-_unique(np.concatenate([graph[unique], extra], axis=1)), axis=1)
        fits = (merged >= 0).sum(axis=1) <= 2 * degree
        graph[unique[fits], : min(2 * degree, merged.shape[1])] = merged[fits, : 2 * degree]
        over = np.flatnonzero(~fits)
        for k in range(0, len(over), BLOCK):
            part = over[k : k + BLOCK]
            graph[unique[part]] = -1
            graph[unique[part], :degree] = _prune(points, unique[part], merged[part], degree, relax)
    return graph, start


def _unique(nodes: np.ndarray) -> np.ndarray:
    """Repeats within a row become -1."""
    out = np.sort(nodes, axis=1)
    out[:, 1:][out[:, 1:] == out[:, :-1]] = -1
    return out


def _index_shard(frame: pd.DataFrame) -> pd.DataFrame:
    points = np.array(frame["vector"].tolist(), np.float64)
    graph, start = build(points)
    return pd.DataFrame({
        "shard": frame["shard"], "node": np.arange(len(frame)), "point": frame["point"], "vector": frame["vector"],
        "neighbours": list(graph), "start": start,
    })


def index(points: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Written table of the graphs of (point, vector): every distinct vector is a node. Vectors are dealt to shards of
    about `shard_rows` by hash, those of other dimension apart."""
    points = points.withColumn("size", F.size("vector"))
    shards = {r["size"]: -(-r["count"] // shard_rows) for r in points.groupBy("size").count().collect()}
    pieces = F.lit(1)
    for size, n in shards.items():
        pieces = F.when(F.col("size") == size, F.lit(n)).otherwise(pieces)
    shard = F.struct("size", F.pmod(F.xxhash64("point"), pieces).cast("int").alias("part"))
    dealt = points.select(shard.alias("shard"), "point", "vector")
    schema = "shard struct<size: int, part: int>, node int, point long, vector array<double>, neighbours array<int>, start int"
    return cut(dealt.groupBy("shard").applyInPandas(_index_shard, schema))


def search(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """For each row where `is_query` holds, its k nearest other rows: query_id, rank, the found row's id, score.

    Nearness is Euclidean distance in double precision, ties go to the smaller id. Rows of the query's own id are no
    candidates. Null, zero or non-finite vectors and rows with a null id take no part; only vectors of the query's
    dimension are near it. A shard holds about `shard_rows` distinct vectors; larger ones mean fewer searches per query, up to
    what an executor holds. Equal vectors are one node of the graph; of their ids the k + 1 smallest are kept, since no
    other can be among k. A repeated query id with several vectors is searched by the vector that sorts first.
    """
    rows = df.where(usable(df[vector_col]) & df[id_col].isNotNull()).select(
        df[id_col].alias("id"), df[vector_col].cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    # A vector's key is the least id that has it; copies are cut to k + 1 ids in parts first.
    members = rows.select("vector", "id").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(COPIES_PARTS))).distinct()
    for keys in (("vector", "part"), ("vector",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("id"))
        members = members.withColumn("place", place).where(F.col("place") <= k + 1)
    distinct = cut(members.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("point", F.monotonically_increasing_id()))
    nodes = index(distinct.select("point", "vector"), shard_rows)

    queries = rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-queries.count() // QUERY_ROWS)))))
    shards = nodes.select("shard").distinct()
    asked = cut(queries.withColumn("size", F.size("vector")).join(shards, F.col("size") == F.col("shard.size")).drop("size"))
    held = nodes.join(asked.select("shard", F.col("block").alias("turn")).distinct(), "shard")

    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(block):
            return pd.DataFrame({"query_id": [], "point": [], "score": []})
        shard = shard.sort_values("node")
        points, graph = np.array(shard["vector"].tolist()), np.array(shard["neighbours"].tolist())
        rough, out = points.astype(np.float32), []
        for at in range(0, len(block), BLOCK):
            part = block.iloc[at : at + BLOCK]
            vectors = np.array(part["vector"].tolist())
            found, _ = _search(rough, graph, int(shard["start"].iloc[0]), vectors.astype(np.float32), BEAM)
            row, col = np.nonzero(found >= 0)
            hit = found[row, col]
            score = np.sqrt(((points[hit] - vectors[row]) ** 2).sum(axis=1))
            order = np.lexsort((score, row))
            row, hit, score = row[order], hit[order], score[order]
            turn = np.arange(len(row)) - np.searchsorted(row, row)
            # One more than k, and all at the distance of the last: the query's own vector may be among them.
            last = np.full(len(part), np.inf)
            last[row[turn == k]] = score[turn == k]
            near = score <= last[row]
            out.append(pd.DataFrame({"query_id": part["id"].to_numpy()[row[near]], "point": shard["point"].to_numpy()[hit[near]], "score": score[near]}))
        return pd.concat(out)

    schema = f"query_id {df.schema[id_col].dataType.simpleString()}, point long, score double"
    near = held.groupBy("shard", "turn").cogroup(asked.groupBy("shard", "block")).applyInPandas(run, schema)
    found = near.join(distinct.select("point", F.explode("ids").alias(id_col)), "point").where(F.col(id_col) != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", id_col))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")
