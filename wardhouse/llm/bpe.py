"""Byte-level BPE: encoding by segment trees over symbol positions, and decoding.

Many pieces are encoded at once, one tree each, as rows of an array. A leaf holds the rank of the pair that starts at
its position, an inner node the smallest (rank, position) below it, so the root names the leftmost pair of least rank.
A merge gives its left position the new symbol, takes its right position out of the chain of live neighbours, and
updates three leaves with their paths to the root.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wardhouse.llm.common import arrow_map, portions, text_bytes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# Chunks that a worker keeps, and that it learns at once.
CACHE_PIECES, LEARN_PIECES = 700_000, 30_000
# Chunks that a worker keeps spelled and decoded too.
SPELLED_PIECES = 200_000
# Leaves of all trees that are worked on at once.
BATCH_LEAVES = 1 << 19
NONE = np.int64(1) << 62


class Merges:
    """Pairs of symbols with their rank and the symbol they become, looked up by sorted pair keys."""

    def __init__(self, pairs: Iterable[tuple[int, int, int, int]]):
        table = np.array(sorted({(a << 32 | b): (rank, to) for a, b, rank, to in pairs}.items(), key=lambda x: x[0]), object)
        self.keys = np.array([k for k, _ in table], np.int64)
        self.ranks = np.array([v[0] for _, v in table] + [0], np.int64)
        self.to = np.array([v[1] for _, v in table], np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each pair in the table, and whether it is there; a right symbol of -1 makes no pair."""
        keys = left << 32 | right
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return place, (self.keys[place] == keys) & (right >= 0)

    def encode(self, pieces: list[np.ndarray]) -> list[np.ndarray]:
        """The final symbols of each piece, given its first symbols."""
        out: list = [None] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda k: len(pieces[k]))
        k = 0
        while k < len(order):
            width = 1 << max(1, (len(pieces[order[k]]) - 1).bit_length())
            end = k
            while end < len(order) and len(pieces[order[end]]) <= width and (end - k) * width < max(BATCH_LEAVES, width):
                end += 1
            group = order[k:end]
            for g, ids in zip(group, self._trees([pieces[g] for g in group], width)):
                out[g] = ids
            k = end
        return out

    def _trees(self, pieces: list[np.ndarray], width: int) -> list[np.ndarray]:
        n, depth = len(pieces), width.bit_length() - 1
        length = np.array([len(p) for p in pieces])
        symbol = np.full((n, width), -1, np.int64)
        symbol[np.arange(width) < length[:, None]] = np.concatenate(pieces) if n else 0
        live = symbol >= 0
        after = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        after[np.arange(n), np.maximum(length - 1, 0)] = width
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        tree = np.full((n, 2 * width), NONE)
        row, col = np.nonzero(live[:, : width - 1] & live[:, 1:])
        place, ok = self.find(symbol[row, col], symbol[row, col + 1])
        row, col, place = row[ok], col[ok], place[ok]
        tree[row, width + col] = self.ranks[place] << 32 | col
        for level in range(depth - 1, -1, -1):
            at = slice(1 << level, 2 << level)
            tree[:, at] = np.minimum(tree[:, 2 << level : 4 << level : 2], tree[:, (2 << level) + 1 : 4 << level : 2])

        busy = np.flatnonzero(tree[:, 1] != NONE)
        while len(busy):
            left = tree[busy, 1] & 0xFFFFFFFF
            right = after[busy, left]
            place, _ = self.find(symbol[busy, left], symbol[busy, right])
            symbol[busy, left] = self.to[place]
            live[busy, right] = False
            follow = after[busy, right]
            after[busy, left] = follow
            has = follow < width
            before[busy[has], follow[has]] = left[has]
            # Leaves to renew: the right one goes, the pairs at the left one and at its predecessor are new.
            self._renew(tree, busy, right, np.full(len(busy), NONE), depth)
            self._renew(tree, busy, left, self._pair(symbol, busy, left, follow, width), depth)
            ahead = before[busy, left]
            some = ahead >= 0
            rows, ahead = busy[some], ahead[some]
            self._renew(tree, rows, ahead, self._pair(symbol, rows, ahead, left[some], width), depth)
            busy = busy[tree[busy, 1] != NONE]
        flat, ends = symbol[live], np.cumsum(live.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _pair(self, symbol, rows, left, right, width) -> np.ndarray:
        other = np.where(right < width, symbol[rows, np.minimum(right, width - 1)], -1)
        place, ok = self.find(symbol[rows, left], other)
        return np.where(ok, self.ranks[place] << 32 | left, NONE)

    @staticmethod
    def _renew(tree, rows, position, value, depth) -> None:
        node = position + (1 << depth)
        tree[rows, node] = value
        for _ in range(depth):
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])


class ByteBPE:
    """Encodes and decodes by a rank file: any neighbours whose joined bytes are a token may merge, least rank first."""

    def __init__(self, path: str = RANKS, pattern: str = PATTERN):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        self.first = np.array([ranks[bytes([b])] for b in range(256)])
        self.token = {i: t for t, i in ranks.items()}
        self.number = list(range(max(self.token) + 1))
        self.decimal = list(map(str, self.number))
        self.merges = Merges(
            (ranks[t[:k]], ranks[t[k:]], i, i)
            for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        )
        self.cache: dict[str, tuple[int, ...]] = {}
        self.spelled: dict[str, tuple[str, bytes]] = {}

    def _chunks(self, text: str) -> list[str]:
        """Parts of the text that the pattern never matches across: white space and the word after it. Where white
        space is single blanks between words, cutting before each blank does it."""
        if _IRREGULAR(text):
            return _CHUNK(text)
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + w for w in rest]

    def _known(self, texts: list[str]) -> list[list[str]]:
        """The chunks of each text, all in the cache."""
        parts = [self._chunks(t) for t in texts]
        new = [c for c in set().union(*parts) if c not in self.cache]
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            self.spelled.clear()
            new = list(set().union(*parts))
        for at in range(0, len(new), LEARN_PIECES):
            self._learn(new[at : at + LEARN_PIECES])
        return parts

    def encode(self, texts: list[str]) -> list[list[int]]:
        parts = self._known(texts)
        out = []
        for chunks in parts:
            ids: list[int] = []
            for found in map(self.cache.__getitem__, chunks):
                ids += found
            out.append(ids)
        return out

    def _learn(self, chunks: list[str]) -> None:
        pieces = [self.pattern.findall(c) for c in chunks]
        distinct = list(set().union(*pieces))
        symbols = self.merges.encode([self.first[np.frombuffer(p.encode(), np.uint8)] for p in distinct])
        # One number object per id, however many words hold it.
        known = dict(zip(distinct, (tuple(map(self.number.__getitem__, ids.tolist())) for ids in symbols)))
        self.cache.update((chunk, sum(map(known.__getitem__, ps), ())) for chunk, ps in zip(chunks, pieces))

    def digests(self, texts: list[str]) -> list[tuple[int, str, bytes]]:
        """By text, how many ids it has, these in decimal behind a comma each, and what they decode to. Ids are spelled and
        decoded once for each chunk that is known; a text's are those of its chunks in turn."""
        parts, spelled, spell = self._known(texts), self.spelled, self._spell
        out = []
        for chunks in parts:
            found = [spelled.get(c) or spell(c) for c in chunks]
            ids, decoded = "".join([f[0] for f in found]), b"".join([f[1] for f in found])
            out.append((ids.count(","), ids, decoded))
        return out

    def _spell(self, chunk: str) -> tuple[str, bytes]:
        ids = self.cache[chunk]
        found = "," + ",".join(map(self.decimal.__getitem__, ids)), self.decode(ids)
        if len(self.spelled) < SPELLED_PIECES:
            self.spelled[chunk] = found
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@functools.cache
def byte_bpe(path: str, pattern: str) -> ByteBPE:
    """One per Python worker: the tasks that a worker runs in turn share its tables and the chunks it knows."""
    return ByteBPE(path, pattern)


_IRREGULAR: Callable = regex.compile(r"\s\s|^\s|\s$|\s(?<! )(?=\S)").search
_CHUNK: Callable = regex.compile(r"\s*\S+|\s+").findall


def encode_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, pattern: str = PATTERN
) -> DataFrame:
    """One row per row of `df`: id, `ids` (array of int) and `decoded` (the bytes that the ids decode to).

    Null and empty texts have no ids. Ids of rows may be null or repeated; other columns are ignored.
    """

    def whole(bpe: ByteBPE, texts: list[str]) -> dict:
        ids = bpe.encode(texts)
        return {"ids": ids, "decoded": [bpe.decode(i) for i in ids]}

    return _encoded(df, id_col, text_col, ranks, pattern, whole, "ids array<int>, decoded binary")


def encode_digests(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, pattern: str = PATTERN
) -> DataFrame:
    """As `encode_documents`, with the ids and the decoded bytes as digests: n_tokens, ids_sha256, decoded_sha256."""

    def digests(bpe: ByteBPE, texts: list[str]) -> dict:
        n, ids, decoded = zip(*bpe.digests(texts))
        return {
            "n_tokens": n,
            "ids_sha256": [hashlib.sha256(i[1:].encode()).hexdigest() for i in ids],
            "decoded_sha256": [hashlib.sha256(d).hexdigest() for d in decoded],
        }

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(df, id_col, text_col, ranks, pattern, digests, schema)


def _encoded(df, id_col, text_col, ranks, pattern, columns, schema) -> DataFrame:
    def per_task():
        bpe = byte_bpe(ranks, pattern)

        def step(batch: pa.RecordBatch) -> dict:
            out: dict = {}
            for part in portions(batch.column("text").to_pylist()):
                for name, values in columns(bpe, [t.decode("utf-8", "replace") for t in part]).items():
                    out.setdefault(name, []).extend(values)
            return {"id": batch.column("id")} | out

        return step

    source = df.select(df[id_col].alias("id"), text_bytes(df, text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    return arrow_map(source, per_task, f"id {kind}, {schema}").withColumnRenamed("id", id_col)
