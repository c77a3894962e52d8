"""Packs token sequences by a configuration linear program over their length histogram.

A configuration is a multiset of lengths that fits one sequence. The program covers the histogram with as few
configurations as possible. It is solved by multiplicative weights: prices of lengths rise while a length is behind, and
a knapsack dynamic program over the prices proposes, for every length, the best configuration that holds it. The
fractional counts are then rounded, and what is left is placed by best fit. All of this works on the histogram, whose
size is bounded by the capacity; documents are tokenized, ranked and placed by Spark tasks.
"""

from __future__ import annotations

import functools
import heapq
import os
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardhouse.llm.common import arrow_flow, arrow_map, cut, portions, text_bytes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY, END_ID = 2048, 0
# Rounds of the solver, each with one dynamic program; step of the weights; how near a proposal must come to the best.
ROUNDS, STEP, NEAR = 48, 2.0, 0.02
# Words that a worker keeps, in two generations; words encoded as one text; such texts encoded at once.
CACHE_WORDS, LEARN_WORDS, LEARN_TEXTS = 600_000, 500, 16
# A string that the tokenizer knows as special, and how tokens that end a word end.
_SEPARATOR, _WORD_END = b"<|endoftext|>", "</w>"
# ASCII marks other than those of special strings and the apostrophe, which may begin a token group with letters.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "<|>'")
# Rows of one length are ranked in so many parts, so that a frequent length is no single task's work.
RANK_PARTS = 256


class WordTokenizer:
    """Ids of a text as little-endian unsigned 32-bit numbers, made word by word.

    The tokenizer splits at white space and drops it, so the ids of a text are those of its words in turn; frequent
    words are kept. A-Z may be lowered before, as the tokenizer lowers them itself, but for its own special strings.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers

        # A task has one core; threads of its own would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.is_end = np.array([(name or "").endswith(_WORD_END) for name in names])
        self.separator = self.tokenizer.token_to_id(_SEPARATOR.decode())
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Letters are one token group, and so are marks behind them: a word of both has the ids of both in turn. Words
        of a-z are encoded as one text without normalising and parted by their end tokens, others by a special string
        between them."""
        marked = [
            (w, stem, w[len(stem) :])
            for w in words
            if w[-1] in _MARKS and (stem := w.rstrip(_MARKS)) and (stem.isalpha() or stem.decode("utf-8", "replace").isalpha())
        ]
        alone_words = {part for _, *both in marked for part in both}.union(words).difference([w for w, *_ in marked])
        letters, other = [], []
        for w in alone_words.difference(self.cache):
            (letters if w.isalpha() and w.islower() else other).append(w)
        alone = [w for w in other if b"<" in w or b">" in w]
        alone += self._learn_joined(self.plain, letters, b" ", lambda found: self.is_end[found], 1)
        apart = [w for w in other if b"<" not in w and b">" not in w]
        alone += self._learn_joined(self.tokenizer, apart, _SEPARATOR, lambda found: found == self.separator, 0)
        self.cache.update((w, ids.tobytes()) for w, ids in zip(alone, self._encode(self.tokenizer, alone)))
        self.cache.update((w, self.cache[stem] + self.cache[marks]) for w, stem, marks in marked)

    def _learn_joined(self, tokenizer, words: list[bytes], by: bytes, last: Callable, keep: int) -> list[bytes]:
        """`last` marks the ids that end a word, `keep` (0 or 1) whether such an id is the word's. Returns the words of
        texts that do not fall into their words again."""
        failed = []
        blocks = [words[k : k + LEARN_WORDS] for k in range(0, len(words), LEARN_WORDS)]
        for block, found in zip(blocks, self._encode(tokenizer, [by.join(b) for b in blocks])):
            ends = np.flatnonzero(last(found)).tolist()
            ends += [] if keep else [len(found)]
            if len(ends) != len(block) or ends[-1] + keep != len(found):
                failed += block
                continue
            body, at = found.tobytes(), 0
            for word, end in zip(block, ends):
                self.cache[word] = body[4 * at : 4 * (end + keep)]
                at = end + 1
        return failed

    def _encode(self, tokenizer, texts: list[bytes]) -> Iterator[np.ndarray]:
        for k in range(0, len(texts), LEARN_TEXTS):
            part = [t.decode("utf-8", "replace") for t in texts[k : k + LEARN_TEXTS]]
            for e in tokenizer.encode_batch_fast(part, add_special_tokens=False):
                yield np.array(e.ids, "<u4")

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """One look-up per word. When half the room is used, what is kept becomes the older generation; from it words that
        come again move over, and the rest goes."""
        known, out, waiting, gaps = self.cache.get, [], [], []
        for k, text in enumerate(texts):
            words = (text if b"<|" in text else text.lower()).split()
            found = list(map(known, words))
            try:
                out.append(b"".join(found))
            except TypeError:  # a word is not known yet
                out.append(b"")
                waiting.append((k, found))
                gaps += [(found, i, words[i]) for i, ids in enumerate(found) if ids is None]
        if gaps:
            new = {w for _, _, w in gaps}
            again = {w: self.older[w] for w in new if w in self.older}
            self.cache.update(again)
            self._learn([w for w in new if w not in again])
            for found, i, word in gaps:
                found[i] = known(word)
            for k, found in waiting:
                out[k] = b"".join(found)
            if 2 * len(self.cache) > CACHE_WORDS:
                self.older, self.cache = self.cache, {}
        return out


@functools.cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker: the tasks that a worker runs in turn share the words it knows."""
    return WordTokenizer(path)


def pieces(df: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int) -> DataFrame:
    """Columns id, piece, start, length, ids_crc32."""

    def per_task():
        encode = word_tokenizer(tokenizer)
        end, step = np.array([END_ID], "<u4").tobytes(), 4 * capacity

        def run(batch: pa.RecordBatch) -> dict:
            ids, out = iter(batch.column("id").to_pylist()), {k: [] for k in ("id", "piece", "start", "length", "ids_crc32")}
            for texts in portions(batch.column("text").to_pylist()):
                for body in encode(texts):
                    doc = next(ids)
                    body += end
                    for k in range(0, len(body), step):
                        part = body[k : k + step]
                        out["id"].append(doc)
                        out["piece"].append(k // step)
                        out["start"].append(k // 4)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
            return out

        return run

    source = df.select(df[id_col].alias("id"), text_bytes(df, text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    return arrow_map(source, per_task, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def best_values(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack with repetition: for every space the best total price, and the length it takes first (0: none)."""
    value, first = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for space in range(1, capacity + 1):
        offers = value[space - 1 :: -1] + price[1 : space + 1]
        k = int(offers.argmax())
        value[space], first[space] = value[space - 1], 0
        if offers[k] > value[space - 1] + 1e-12:
            value[space], first[space] = offers[k], k + 1
    return value, first


def configurations(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple, float]:
    """Fractional solution: how often to use each configuration, a sorted tuple of (length, times)."""
    lengths = np.flatnonzero(counts)
    covered, use = np.zeros(capacity + 1), Counter()
    for t in range(rounds):
        price = np.zeros(capacity + 1)
        behind = t / rounds - covered[lengths] / counts[lengths]
        price[lengths] = lengths / capacity * np.exp(STEP * np.clip(behind, -1, 1))
        value, first = best_values(price, capacity)
        offered = {l: price[l] + value[capacity - l] for l in lengths.tolist()}
        bar = (1 - NEAR) * max(offered.values(), default=0)
        for l in sorted(offered, reverse=True):
            # A length that is ahead of the round waits; so does one whose best configuration is far from the best.
            want = (t + 1) / rounds * counts[l] - covered[l]
            if want <= 0 or (offered[l] < bar and t + 1 < rounds):
                continue
            items, space = Counter([l]), capacity - l
            while space > 0:
                if first[space]:
                    items[int(first[space])] += 1
                    space -= int(first[space])
                else:
                    space -= 1
            times = want / items[l]
            use[tuple(sorted(items.items(), reverse=True))] += times
            for k, n in items.items():
                covered[k] += n * times
    return use


def solve(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[tuple, int]]:
    """Configurations and whole numbers of sequences that together hold exactly `counts` items of each length."""
    left, plan = counts.copy(), Counter()
    use = configurations(counts, capacity, rounds)
    full = lambda c: sum(l * n for l, n in c)
    for config, times in sorted(use.items(), key=lambda x: (-full(x[0]), -x[1], x[0])):
        fits = min(int(left[l]) // n for l, n in config)
        n = min(fits, int(np.ceil(times)) if full(config) == capacity else int(times))
        if n > 0:
            plan[config] += n
            for l, k in config:
                left[l] -= n * k
    for config in _best_fit(left, capacity):
        plan[config] += 1
    return sorted(plan.items())


def _best_fit(left: np.ndarray, capacity: int) -> Iterator[tuple]:
    """Items in falling length; each goes to the fullest open sequence that still has room."""
    open_at: dict[int, list[list[int]]] = {}
    spaces: list[int] = []
    for length in range(capacity, 0, -1):
        for _ in range(int(left[length])):
            spaces_fit = [s for s in spaces if s >= length]
            if spaces_fit:
                space = min(spaces_fit)
                items = open_at[space].pop()
                if not open_at[space]:
                    del open_at[space]
                    spaces.remove(space)
            else:
                space, items = capacity, []
            items.append(length)
            space -= length
            if space:
                if space not in open_at:
                    open_at[space] = []
                    heapq.heappush(spaces, space)
                open_at[space].append(items)
            else:
                yield tuple(sorted(Counter(items).items(), reverse=True))
    for group in open_at.values():
        for items in group:
            yield tuple(sorted(Counter(items).items(), reverse=True))


def slots(plan: list[tuple[tuple, int]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, items a sequence, first sequence, offset): where the items of each rank go."""
    out: dict[int, list] = {}
    used: Counter = Counter()
    sequence = 0
    for config, times in plan:
        offset = 0
        for length, n in config:
            out.setdefault(length, []).append((used[length], n, sequence, offset))
            used[length] += n * times
            offset += length * n
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece of each row of `df`: id, piece, start, length, ids_crc32, sequence_id, offset.

    A text's ids end with id 0, so null and empty texts are one piece of one token. Only longer ones are cut, into pieces
    of `capacity` tokens. Repeated rows are packed each. Other columns are ignored; no rows give no rows.
    """
    rows = cut(pieces(df, id_col, text_col, tokenizer, capacity))
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    where = slots(solve(counts, capacity))

    # The rank of a row among those of its length: within a part, plus the rows of the parts before.
    columns = ["id", "piece", "start", "ids_crc32"]
    parted = rows.withColumn("part", F.pmod(F.xxhash64(*columns), F.lit(RANK_PARTS)).cast("int"))
    sizes = parted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy(*columns))
    ranked = parted.withColumn("within", within).join(sizes, ["length", "part"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("within") - 1).alias("rank"))

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for l in np.unique(length).tolist():
                at = np.flatnonzero(length == l)
                table = where[l]
                row = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1]
                turn = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + turn // row[:, 1]
                offset[at] = row[:, 3] + turn % row[:, 1] * l
            names = ("id", "piece", "start", "length", "ids_crc32")
            yield {n: batch.column(n) for n in names} | {"sequence_id": sequence, "offset": offset}

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return arrow_flow(ranked, flow, schema).withColumnRenamed("id", id_col)
