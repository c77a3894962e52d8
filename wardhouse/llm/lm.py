"""Language model scores by a hierarchical Pitman-Yor process.

For every word of the training texts a restaurant serves the words that follow it; the end of a text is a word too, and the
one before a text's first. A new table draws its word from the restaurant without context, and that one's new tables from
a model that spells words byte by byte: restaurants for the two bytes before, their parents for the one byte before, theirs without
context, and below all a uniform choice. Gibbs sweeps draw, for every dish of every restaurant, its number of tables given
all the others, as the sweep before left them; tables of a restaurant are the customers of its parent. Predictive
probabilities are averaged over the sweeps after the first ones.

Word and pair counts never meet in one place. Documents are reduced once, in their tasks, to numbers into the vocabulary of
their chunk (a bounded part of a task's texts). A chunk's words, and later its pairs of words, go to parts by their hash, one
compressed packet per chunk and part; a part numbers and counts them, and values return by the same packets, in their order.
Words and pairs stay in their parts during the sweeps: a part of pairs sends the shares of its distinct words to the words' parts
and gets their values back in the same order, so a word travels once for all of a part's pairs that have it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from wardhouse.llm.common import arrow_flow, cut, text_bytes

# Sweeps, and how many of them are left out of the average.
SWEEPS, BURN_IN = 3, 1
# The discount of every restaurant; `seat` is made for a half.
DISCOUNT = 0.5
CONTEXT_STRENGTH, WORD_STRENGTH = 1.0, 10.0
BYTE_STRENGTHS = (1.0, 1.0, 1.0)
CHUNK_BYTES = 16 << 20
# A part of words or pairs has as many of them as so much text, however large the table.
PART_BYTES = 16 << 20
# Weights whose logarithm is this far below the largest one's do not change a sum in doubles.
LOST = -45.0
SPELLER_ROUNDS = 3
# Bytes and the mark that ends a word; contexts also start with a mark.
END, START, SYMBOLS = 256, 256, 257


def seat(counts: np.ndarray, others: np.ndarray, parent: np.ndarray, strength: float, rng: np.random.Generator) -> np.ndarray:
    """A Gibbs draw of the tables of each dish, given its customers, the tables of the `others` in its restaurant and its
    probability in the parent: t tables have the weight S(c, t) * m(0) * ... * m(t - 1) with the generalised Stirling
    numbers S and m(j) = (strength + DISCOUNT * (others + j)) * parent.

    With a discount of a half S(c, t) = (2c - t - 1)! / ((c - t)! (t - 1)! 4^(c - t)), so the weights of t + 1 and t
    tables have a ratio in closed form, which falls with t. A draw needs the weights around the largest one only,
    as far as they are not lost in a double anyway; that holds alike for two customers and for very many.
    """
    tables = np.minimum(counts, 1).astype(np.int64)
    more = np.flatnonzero(counts > 1)
    c, rest, p = counts[more].astype(float), 2 * strength + others[more], np.maximum(parent[more], 1e-290)

    def log_ratio(t: np.ndarray, c: np.ndarray, rest: np.ndarray, p: np.ndarray) -> np.ndarray:
        """log of weight(t + 1) / weight(t), for 0 < t < c."""
        return np.log(2 * p) + np.log((rest + t) / t) + np.log((c - t) / (2 * c - t - 1))

    low, high = np.ones(len(c)), c.copy()
    while (open_ := low < high).any():
        mid = np.floor((low + high) / 2)
        up = open_ & (log_ratio(np.where(open_, mid, 1), c, rest, p) > 0)
        low, high = np.where(up, mid + 1, low), np.where(open_ & ~up, mid, high)
    todo, reach = np.arange(len(c)), 4
    while len(todo):
        wider = []
        for rows in np.array_split(todo, 1 + len(todo) * reach // 500_000):
            t = low[rows, None] + np.arange(-reach, reach + 1)
            most = c[rows, None]
            inside = (t >= 1) & (t < most)
            step = np.where(inside, log_ratio(np.where(inside, t, 1), most, rest[rows, None], p[rows, None]), 0)
            log = np.concatenate([np.zeros((len(rows), 1)), step.cumsum(axis=1)[:, :-1]], axis=1)
            log -= log[:, reach, None]
            whole = ((t[:, 0] <= 1) | (log[:, 0] < LOST)) & ((t[:, -1] >= most[:, 0]) | (log[:, -1] < LOST))
            wider.append(rows[~whole])
            weight = np.where((t >= 1) & (t <= most), np.exp(np.minimum(log, 0)), 0)[whole].cumsum(axis=1)
            place = (weight <= rng.random(len(weight))[:, None] * weight[:, -1:]).sum(axis=1)
            tables[more[rows[whole]]] = (low[rows[whole]] + place - reach).astype(np.int64)
        todo, reach = np.concatenate(wider), 4 * reach
    return tables


@dataclass
class Speller:
    """Probability of each symbol after two others: `rows` maps a context to a row of `values`."""

    rows: dict[int, int]
    values: np.ndarray

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        context, symbol, owner = symbols(words)
        keys, back = np.unique(context, return_inverse=True)
        # Contexts never met use the row of their last symbol alone, and beyond that the one without context.
        found = [self.rows.get(k, self.rows.get(-1 - k % SYMBOLS, 0)) for k in keys.tolist()]
        logs = np.log(self.values[np.array(found, np.int64)[back], symbol]) if len(keys) else np.zeros(0)
        return np.bincount(owner, logs, len(words))


def symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context of two symbols, symbol, word number) of every byte and end of the words."""
    length = np.array([len(w) + 1 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), length)
    last = np.cumsum(length) - 1
    symbol = np.full(len(owner), END)
    inner = np.ones(len(owner), bool)
    inner[last] = False
    symbol[inner] = np.frombuffer(b"".join(words), np.uint8)
    first = last - length + 1
    one, two = np.roll(symbol, 1), np.roll(symbol, 2)
    one[first] = START
    two[first] = START
    two[first[length > 1] + 1] = START
    return two * SYMBOLS + one, symbol, owner


def speller(trigrams: dict[tuple[int, int], int], rng: np.random.Generator, rounds: int = SPELLER_ROUNDS) -> Speller:
    """Seats the spelled symbols of all tables in `rounds` sweeps, then gives predictive probabilities.

    What a restaurant's tables are, its parent's customers are. A sweep goes from the longest context down; a new table's
    weight uses the parent's predictive probability as the sweep before left it.
    """
    keys = np.array(sorted(trigrams), np.int64).reshape(-1, 2)
    customers = [np.array([trigrams[k] for k in map(tuple, keys.tolist())], np.int64)]
    contexts, symbol_of, rooms, ups = [keys[:, 0]], [keys[:, 1]], [], []
    for depth in (2, 1, 0):
        rooms.append(np.unique(contexts[-1], return_inverse=True)[1])
        if depth:
            shorter = contexts[-1] % SYMBOLS if depth == 2 else np.zeros(len(contexts[-1]), np.int64)
            unique, up = np.unique(shorter * SYMBOLS + symbol_of[-1], return_inverse=True)
            ups.append(up)
            contexts.append(unique // SYMBOLS)
            symbol_of.append(unique % SYMBOLS)
            customers.append(np.bincount(up, minlength=len(unique)))
    tables = [np.ones(len(c), np.int64) for c in contexts]

    def parents() -> list[np.ndarray]:
        """The parent's probability of each dish, by level."""
        below = [np.full(len(contexts[2]), 1 / SYMBOLS)]
        for k in (2, 1):
            strength = BYTE_STRENGTHS[2 - k]
            total, opened = (np.bincount(rooms[k], x)[rooms[k]] for x in (customers[k], tables[k]))
            own = (customers[k] - DISCOUNT * tables[k] + (strength + DISCOUNT * opened) * below[0]) / (strength + total)
            below.insert(0, own[ups[k - 1]])
        return below

    for _ in range(rounds if len(keys) else 0):
        for k, parent in enumerate(parents()):
            opened = np.bincount(rooms[k], tables[k])[rooms[k]]
            tables[k] = seat(customers[k], opened - tables[k], parent, BYTE_STRENGTHS[2 - k], rng)
            if k < 2:
                customers[k + 1] = np.bincount(ups[k], tables[k]).astype(np.int64)
    levels = list(zip(contexts, symbol_of, customers, tables))
    rows: dict[int, int] = {}
    values = np.full((1, SYMBOLS), 1 / SYMBOLS)
    parents = {0: 0}
    for depth, (context, symbol, n, tables) in zip((0, 1, 2), reversed(levels)):
        unique, back = np.unique(context, return_inverse=True)
        strength = BYTE_STRENGTHS[depth]
        below = np.array([parents[{0: 0, 1: 0, 2: c % SYMBOLS}[depth]] for c in unique.tolist()], np.int64)
        base = values[below]
        total, opened = np.bincount(back, n, len(unique)), np.bincount(back, tables, len(unique))
        fresh = (strength + DISCOUNT * opened)[:, None] * base
        np.add.at(fresh, (back, symbol), n - DISCOUNT * tables)
        fresh /= (strength + total)[:, None]
        start = len(values)
        values = np.concatenate([values, fresh])
        parents = {c: start + i for i, c in enumerate(unique.tolist())}
        # Keys: the context of two symbols as it is, of one symbol below zero, and none as row 0.
        if depth == 0:
            values[0] = values[start] if len(unique) else values[0]
        elif depth == 1:
            rows |= {-1 - c: r for c, r in parents.items()}
        else:
            rows |= parents
    return Speller(rows, values)


def squeezed(values: np.ndarray) -> bytes:
    """Bytes of equal rank beside each other, compressed: high ones are mostly alike."""
    return pa.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), codec="zstd", asbytes=True)


def restored(body: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = pa.decompress(body, decompressed_size=size * width, codec="zstd", asbytes=True)
    return np.frombuffer(flat, np.uint8).reshape(width, size).T.copy().view(kind).ravel()


def all_restored(table: pa.Table, column: str, kind: type) -> np.ndarray:
    rows = zip(table.column(column).to_pylist(), table.column("size").to_pylist())
    return np.concatenate([np.empty(0, kind), *[restored(body, size, kind) for body, size in rows]])


def dealt(part: np.ndarray, parts: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by part, and (part, from, to) of those that have any."""
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
    return order, [(k, a, b) for k, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]


def rows_like(schema: pa.Schema, columns: dict) -> pa.Table:
    """Rows with the given columns, the others null."""
    n = len(next(iter(columns.values())))
    return pa.table([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def token_width(words: int) -> int:
    """Bytes of a number into a chunk's vocabulary."""
    return max(1, -(-words.bit_length() // 8))


def _reduce(source: DataFrame, kind: str, parts: int) -> DataFrame:
    """Documents as numbers into their chunk's vocabulary, in order, and the vocabularies; one pass, written by the caller.

    A row with a `part` is a packet of `size` words of its chunk, with their training tokens; other rows are documents.
    Numbers follow the packets in order of part. The last token of a document is its end, the empty word.
    """

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task, turn, held = TaskContext.get().partitionId(), 0, 0
        names = ("chunk", "part", "size", "room", "words", "n", "id", "held_out", "tokens")
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        docs: list = []

        def rows() -> dict:
            chunk, words = task << 24 | turn, list(numbers)
            order, ranges = dealt(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % parts, parts)
            place = np.empty(len(words), np.uint32)
            place[order] = np.arange(len(words))
            n = np.bincount(np.concatenate([np.empty(0, np.uint32), *[seq for _, out, seq in docs if not out]]), minlength=len(words))
            out = []
            for part, a, b in ranges:
                body = b" ".join([words[k] for k in order[a:b].tolist()])
                out.append((chunk, part, b - a, len(body), pa.compress(body, codec="zstd", asbytes=True), squeezed(n[order[a:b]]), None, None, None))
            width = token_width(len(words))
            for doc, held_out, seq in docs:
                tokens = place[seq].view(np.uint8).reshape(-1, 4)[:, :width].tobytes()
                out.append((chunk, None, None, None, None, None, doc, held_out, tokens))
            return dict(zip(names, zip(*out)))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("id", "held_out", "text"))
            for doc, out, text in zip(*columns):
                words = text.lower().split()
                words.append(b"")
                docs.append((doc, out, np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))))
                held += len(text)
                if held > CHUNK_BYTES:
                    yield rows()
                    turn, held = turn + 1, 0
                    numbers.clear()
                    docs.clear()
        if docs:
            yield rows()

    schema = f"chunk long, part int, size long, room long, words binary, n binary, id {kind}, held_out boolean, tokens binary"
    return arrow_flow(source, flow, schema)


def _grouped(df: DataFrame, key: str, schema: str, run: Callable[[pa.Table, Callable], list[pa.Table]]) -> DataFrame:
    """`run` gets a group's packets in order of chunk, and a function that makes rows of the schema from some columns."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def of_group(table: pa.Table) -> pa.Table:
        return pa.concat_tables(run(table.sort_by("chunk"), lambda **columns: rows_like(arrow, columns)))

    return df.groupBy(key).applyInArrow(of_group, schema)


def _word_parts(packets: DataFrame) -> DataFrame:
    """Training words by part (`home`), in order of id, with their counts and `tokens`, and their chunks' packets of codes: -1
    for a word that training has not, otherwise the low half of its id, which has the part in the high half. An odd id is that
    of a word met once."""

    def run(table: pa.Table, rows: Callable) -> list[pa.Table]:
        part = table.column("part")[0].as_py()
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        met = []
        for body, room in zip(table.column("words").to_pylist(), table.column("room").to_pylist()):
            words = pa.decompress(body, decompressed_size=room, codec="zstd", asbytes=True).split(b" ")
            met.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        c = np.zeros(len(numbers), np.int64)
        np.add.at(c, np.concatenate(met), all_restored(table, "n", np.int64))
        code = np.where(c > 0, np.arange(len(c)) << 1 | (c == 1), -1).astype(np.int32)
        known = np.flatnonzero(c)
        words = list(numbers)
        body = b" ".join([words[k] for k in known.tolist()])
        ids = part << 32 | code[known].astype(np.int64)
        own = {"home": [part], "size": [len(known)], "room": [len(body)], "tokens": [int(c.sum())], "words": [pa.compress(body, codec="zstd", asbytes=True)]}
        return [
            rows(**own, ids=[squeezed(ids)], c=[squeezed(c[known])]) if len(known) else rows(home=[]),
            rows(chunk=table.column("chunk").to_numpy(), part=table.column("part").to_numpy(), size=table.column("size").to_numpy(), codes=[squeezed(code[m]) for m in met]),
        ]

    return _grouped(packets, "part", f"{WORDS}, tokens long, chunk long, part int, codes binary", run)


# A part of words. Beside the ids and counts in their order: tables `t`, those `opened` in the words' restaurants, and by draw
# that counts the chances without context `p` and the opened tables `rooms`.
WORDS = "home int, size long, room long, words binary, ids binary, c binary"


def words_of(row: dict) -> list[bytes]:
    return pa.decompress(row["words"], decompressed_size=row["room"], codec="zstd", asbytes=True).split(b" ")


def ids_of(packets: pa.Table) -> np.ndarray:
    """The ids of a chunk's words by number, from its packets in order of part; -1 for words that training has not."""
    code = all_restored(packets, "codes", np.int32).astype(np.int64)
    part = np.repeat(packets.column("part").to_numpy().astype(np.int64), packets.column("size").to_numpy())
    return np.where(code >= 0, part << 32 | code, -1)


def tokens_of(documents: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all tokens of the documents in turn, and how many each document has."""
    width, bodies = token_width(words), documents.column("tokens").to_pylist()
    number = np.zeros((sum(map(len, bodies)) // width, 4), np.uint8)
    number[:, :width] = np.frombuffer(b"".join(bodies), np.uint8).reshape(-1, width)
    return number.view(np.uint32).ravel().astype(np.int64), np.array([len(b) // width for b in bodies], np.int64)


@dataclass
class Pairs:
    """The distinct pairs of words that follow each other in a chunk; `dealt` are those of training words, by part."""

    number: np.ndarray  # by token, that of its pair
    before: np.ndarray  # by token, the number of the word before
    u: np.ndarray  # by dealt pair, the ids of its words
    w: np.ndarray
    dealt: np.ndarray  # by dealt pair, its number
    ranges: list[tuple[int, int, int]]


def pairs_of(token: np.ndarray, ids: np.ndarray, parts: int) -> Pairs:
    # Documents end with the end, so the end is also what comes before the first word of the next one.
    before = np.concatenate([token[-1:], token[:-1]])
    keys, number = np.unique(before * len(ids) + token, return_inverse=True)
    u, w = ids[keys // len(ids)], ids[keys % len(ids)]
    known = np.flatnonzero((u >= 0) & (w >= 0))
    u, w = u[known], w[known]
    mixed = u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64)
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    order, ranges = dealt(((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), parts)
    return Pairs(number, before, u[order], w[order], known[order], ranges)


def _chunk_pairs(documents: DataFrame, packets: DataFrame, parts: int) -> DataFrame:
    """Packets of the chunks' pairs of training words with their training tokens, by part."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = ids_of(right.sort_by("part"))
        token, length = tokens_of(left, len(ids))
        pairs = pairs_of(token, ids, parts)
        train = np.repeat(~left.column("held_out").to_numpy(zero_copy_only=False), length)
        n = np.bincount(pairs.number[train], minlength=pairs.number.max() + 1)[pairs.dealt]
        out = [(left.column("chunk")[0].as_py(), k, b - a, *[squeezed(x[a:b]) for x in (pairs.u, pairs.w, n)]) for k, a, b in pairs.ranges]
        return pa.table(dict(zip(arrow.names, zip(*out))), schema=arrow) if out else arrow.empty_table()

    schema = "chunk long, part int, size long, u binary, w binary, n binary"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    return documents.groupBy("chunk").cogroup(packets.groupBy("chunk")).applyInArrow(run, schema)


def _pair_parts(packets: DataFrame) -> DataFrame:
    """A row per part with the pairs met twice or more in order (`size`, `u`, `w`, `c`), and the packets of codes: -2 for a pair
    that training has not, -1 for one met once, else its place."""

    def run(table: pa.Table, rows: Callable) -> list[pa.Table]:
        part, size = table.column("part")[0].as_py(), table.column("size").to_numpy()
        u, w, n = (all_restored(table, c, np.int64) for c in ("u", "w", "n"))
        order = np.lexsort((w, u))
        u, w = u[order], w[order]
        first = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])]))
        c, u, w = np.add.reduceat(n[order], first), u[first], w[first]
        code = np.where(c > 0, -1, -2).astype(np.int32)
        many = np.flatnonzero(c > 1)
        code[many] = np.arange(len(many))
        codes = np.empty(len(order), np.int32)
        codes[order] = np.repeat(code, np.diff(np.append(first, len(order))))
        return [
            rows(part=[part], size=[len(many)], u=[squeezed(u[many])], w=[squeezed(w[many])], c=[squeezed(c[many])], shared=[int(c[many].sum()) - len(many)]) if len(many) else rows(part=[]),
            rows(chunk=table.column("chunk").to_numpy(), part=table.column("part").to_numpy(), size=size, codes=[squeezed(x) for x in np.split(codes, np.cumsum(size)[:-1])]),
        ]

    return _grouped(packets, "part", f"{PAIRS}, shared long, chunk long, codes binary", run)


# A part of pairs; beside it their tables `t`, `sum` of these over the draws that count, and all customers at `shared` tables.
PAIRS = "part int, size long, u binary, w binary, c binary"


def score(
    df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS, burn_in: int = BURN_IN
) -> DataFrame:
    """One row per row of `df`: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows that are not held out. Tokens are words between ASCII white space, with A-Z lowered,
    and one end; so null and empty texts have one token. `score` is the model's log10 probability of the whole text, each word
    given the one before, `base_score` that of unigrams with half a count added. In both, words that training has not are one class, "some new
    word": the model's chance of a new table times the chance that the speller spells none of the known words. Without
    training rows counts are zero and every token is of that class. Ids may be null or repeated; other columns are ignored; no rows give no rows.
    """
    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(df[id_col].alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_bytes(df, text_col).alias("text"))
    parts = 1 + (source.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES
    met = cut(_reduce(source, kind, parts))
    documents = met.where("part is null").select("chunk", "id", "held_out", "tokens")
    words = cut(_word_parts(met.where("part is not null").select("chunk", "part", "size", "room", "words", "n")))
    word_packets = words.where("chunk is not null").select("chunk", "part", "size", "codes")
    followed = cut(_pair_parts(_chunk_pairs(documents, word_packets, parts)))

    # Before the first sweep every dish has one table (no `t`). Dishes with one customer keep it, so only the pairs met twice
    # or more are seated.
    none = [F.lit(None).cast("binary").alias(c) for c in ("t", "opened", "p", "rooms")]
    state = words.where("home is not null").select("home", "size", "room", "words", "ids", "c", "tokens", *none)
    tokens, distinct = state.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    pairs = followed.where("u is not null").select("part", "size", "u", "w", "c", none[0], F.lit(None).cast("binary").alias("sum"), "shared")

    # A sweep: spelled symbols of all tables are summed (no more than triples of symbols), the speller is drawn, then each
    # word's tables, then each pair's.
    total, unknown = distinct, []
    for sweep in range(sweeps):
        trigrams = {(r["context"], r["symbol"]): r["n"] for r in _spelled(state).toArrow().to_pylist()}
        model = speller(trigrams, np.random.default_rng(1_000 + sweep))
        customers = tokens - pairs.agg(F.coalesce(F.sum("shared"), F.lit(0))).first()[0]
        swept = cut(_sweep(state, _shares(pairs), model, customers, total, sweep, sweep >= burn_in))
        state = swept.where("part is null")
        total, met_mass = state.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("mass"), F.lit(0.0))).first()
        pairs = cut(_seat_pairs(pairs, swept.where("part is not null").select("part", "home", "size", "opened", "now"), sweep, sweep >= burn_in))
        if sweep >= burn_in:
            unknown.append((WORD_STRENGTH + DISCOUNT * total) * max(1 - met_mass, 1e-9) / (WORD_STRENGTH + customers))
    state = _sweep(state, _shares(pairs), None, 0, 0, sweeps, True).select("home", "size", "ids", "c", "p", "rooms")

    word_values = _word_values(word_packets, state, sweeps - burn_in, unknown)
    codes = followed.where("chunk is not null").select("chunk", "part", "size", "codes")
    pair_values = _pair_values(codes, pairs.select(F.col("part").alias("home"), "size", "c", "sum"), sweeps - burn_in)
    out = _scored(documents, word_values.unionByName(pair_values, allowMissingColumns=True), kind, parts, tokens, tokens + 0.5 * (distinct + 1), sweeps - burn_in)
    return out.withColumnRenamed("id", id_col)


def distinct_words(pair: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of the words in a part of pairs, in order, and the places of each pair's two words among them."""
    u, w = (restored(pair[c], pair["size"], np.int64) for c in ("u", "w"))
    ids, place = np.unique(np.concatenate([u, w]), return_inverse=True)
    return ids, place[: len(u)], place[len(u) :]


def _shares(pairs: DataFrame) -> DataFrame:
    """For every part of pairs and of words, the words that these pairs have, in order of id, with the customers at shared
    tables: of the words' restaurants (`as_room`) and as the words' own (`as_dish`)."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for pair in batch.to_pylist():
                ids, first, second = distinct_words(pair)
                c = restored(pair["c"], pair["size"], np.int64)
                shared = c - (restored(pair["t"], pair["size"], np.int64) if pair["t"] else 1)
                as_room, as_dish = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
                np.add.at(as_room, first, shared)
                np.add.at(as_dish, second, shared)
                homes, start = np.unique(ids >> 32, return_index=True)
                cuts = [*zip(start.tolist(), [*start[1:].tolist(), len(ids)])]
                yield {
                    "home": homes.astype(np.int32), "part": [pair["part"]] * len(homes), "size": [b - a for a, b in cuts],
                    **{n: [squeezed(x[a:b]) for a, b in cuts] for n, x in (("ids", ids), ("as_room", as_room), ("as_dish", as_dish))},
                }

    return arrow_flow(pairs.select("part", "size", "u", "w", "c", "t"), flow, "home int, part int, size long, ids binary, as_room binary, as_dish binary")


def _word_values(packets: DataFrame, state: DataFrame, draws: int, unknown: list[float]) -> DataFrame:
    """The packets of words with their values beside the codes: training tokens, by draw the tables of their restaurant and
    their chance without context. Words that training has not have none, and share the chance `unknown`."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        at = (all_restored(right, "ids", np.int64) & 0xFFFFFFFF) >> 1
        # The last row is that of words that training has not.
        n = 1 + int(at.max(initial=-1)) + 1
        whole, chance = np.zeros((n, 1 + draws), np.int64), np.zeros((n, draws), np.float32)
        whole[at, 0], chance[-1] = all_restored(right, "c", np.int64), unknown
        for row in right.to_pylist():
            whole[at, 1:] = restored(row["rooms"], len(at) * draws, np.int64).reshape(-1, draws)
            chance[at] = restored(row["p"], len(at) * draws, np.float32).reshape(-1, draws)
        out = []
        for chunk, part, size, codes in zip(*(left.column(c).to_pylist() for c in ("chunk", "part", "size", "codes"))):
            code = restored(codes, size, np.int32)
            place = np.where(code >= 0, code >> 1, n - 1)
            out.append((chunk, part, size, codes, squeezed(whole[place].ravel()), squeezed(chance[place].ravel())))
        return pa.table(dict(zip(arrow.names, zip(*out))), schema=arrow) if out else arrow.empty_table()

    schema = "chunk long, part int, size long, codes binary, whole binary, chance binary"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    return packets.groupBy("part").cogroup(state.groupBy("home")).applyInArrow(run, schema)


def _pair_values(packets: DataFrame, pairs: DataFrame, draws: int) -> DataFrame:
    """The packets of pairs with the customers less the discount for their tables, averaged over the draws."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        # The last rows are those of the codes -2 and -1: pairs that training has not, and those met once.
        met = all_restored(right, "c", np.int64) - all_restored(right, "sum", np.int64) * (DISCOUNT / draws)
        value = np.concatenate([met, [0.0, 1 - DISCOUNT]])
        out = []
        for chunk, part, size, codes in zip(*(left.column(c).to_pylist() for c in ("chunk", "part", "size", "codes"))):
            out.append((chunk, part, size, squeezed(value[restored(codes, size, np.int32)])))
        return pa.table(dict(zip(arrow.names, zip(*out))), schema=arrow) if out else arrow.empty_table()

    schema = "chunk long, part int, size long, pairs binary"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    return packets.groupBy("part").cogroup(pairs.groupBy("home")).applyInArrow(run, schema)


def _scored(documents: DataFrame, packets: DataFrame, kind: str, parts: int, tokens: int, low: float, draws: int) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = right.filter(pc.is_valid(right.column("codes"))).sort_by("part")
        ids = ids_of(own)
        whole = np.concatenate([restored(b, s * (1 + draws), np.int64) for b, s in zip(own.column("whole").to_pylist(), own.column("size").to_pylist())]).reshape(-1, 1 + draws)
        chance = np.concatenate([restored(b, s * draws, np.float32) for b, s in zip(own.column("chance").to_pylist(), own.column("size").to_pylist())]).reshape(-1, draws)
        token, length = tokens_of(left, len(ids))
        pairs = pairs_of(token, ids, parts)
        value = np.zeros(pairs.number.max() + 1)
        value[pairs.dealt] = all_restored(right.filter(pc.is_valid(right.column("pairs"))).sort_by("part"), "pairs", float)
        c, u = whole[:, 0], pairs.before
        p = value[pairs.number]
        for k in range(draws):
            p += (CONTEXT_STRENGTH + DISCOUNT * whole[u, 1 + k]) * chance[token, k] / draws
        logs = np.log10(np.maximum(p, 1e-300) / (CONTEXT_STRENGTH + c[u]))
        start = np.cumsum(length) - length
        sums = lambda x: np.add.reduceat(x, start)
        return pa.table({
            "id": left.column("id"), "held_out": left.column("held_out"), "n_tokens": length, "n_known": sums((c > 0)[token].astype(np.int64)),
            "train_tokens": np.full(len(length), tokens, np.int64), "base_score": sums(np.log10((c + 0.5) / low)[token]), "score": sums(logs),
        })

    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return documents.groupBy("chunk").cogroup(packets.groupBy("chunk")).applyInArrow(run, schema)


def _spelled(state: DataFrame) -> DataFrame:
    """(context, symbol, n) over all tables; added up in each task, so rows are bounded by tasks times symbol triples."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums: Counter = Counter()
        for batch in batches:
            for row in batch.to_pylist():
                context, symbol, owner = symbols(words_of(row))
                key, back = np.unique(context * SYMBOLS + symbol, return_inverse=True)
                t = restored(row["t"], row["size"], np.int64) if row["t"] else np.ones(row["size"], np.int64)
                times = np.bincount(back, t[owner]).astype(np.int64)
                sums.update(dict(zip(key.tolist(), times.tolist())))
        keys = np.array([k for k, n in sums.items() if n], np.int64)
        yield {"context": keys // SYMBOLS, "symbol": keys % SYMBOLS, "n": [n for n in sums.values() if n]}

    rows = arrow_flow(state.select("size", "room", "words", "t"), flow, "context long, symbol long, n long")
    return rows.groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def _sweep(state: DataFrame, shares: DataFrame, model: Speller | None, customers: int, total: int, sweep: int, counts: bool) -> DataFrame:
    """The words with the tables `opened` in their restaurants and, given a model, with new tables without context, the sums
    (`total`, `mass`) of these and of their spelled chances, and an answer to each packet of shares: the opened tables and
    predictive probabilities `now` of its words.

    Every training token of a word comes after one word and before one, so the tables that it opens, and those that serve it,
    are the word's tokens less those of its pairs that share a table with others. If the sweep `counts`, `now` joins `p`; `rooms`
    gets the tables of the sweep before, if that one did.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            n = row["size"]
            ids, c = restored(row["ids"], n, np.int64), restored(row["c"], n, np.int64)
            before = restored(row["t"], n, np.int64) if row["t"] else np.ones(n, np.int64)
            asked = [(r["part"], r["size"], np.searchsorted(ids, restored(r["ids"], r["size"], np.int64)), r) for r in right.sort_by("part").to_pylist()]
            opened, served = c.copy(), c.copy()
            for _, size, at, r in asked:
                opened[at] -= restored(r["as_room"], size, np.int64)
                served[at] -= restored(r["as_dish"], size, np.int64)
            p = restored(row["p"], row["draws"] * n, np.float32).reshape(n, -1) if row["p"] else np.empty((n, 0), np.float32)
            rooms = restored(row["rooms"], (row["draws"] - 1) * n, np.int64).reshape(n, -1) if row["rooms"] else np.empty((n, 0), np.int64)
            if p.shape[1]:
                rooms = np.c_[rooms, opened]
            made = {"home": row["home"], "size": n, "room": row["room"], "words": row["words"], "ids": row["ids"], "c": row["c"]}
            if model is not None:
                spelled = np.exp(np.maximum(model.log_probability(words_of(row)), -600))
                t = seat(served, total - before, spelled, WORD_STRENGTH, np.random.default_rng([sweep, row["home"], 0]))
                fresh = (WORD_STRENGTH + DISCOUNT * (total - before + t)) * spelled
                now = np.maximum((served - DISCOUNT * t + fresh) / (WORD_STRENGTH + customers), 1e-300)
                p = np.c_[p, now.astype(np.float32)] if counts else p
                made |= {"t": squeezed(t), "total": int(t.sum()), "mass": float(spelled.sum())}
                out += [{"part": part, "home": row["home"], "size": size, "opened": squeezed(opened[at]), "now": squeezed(now[at])} for part, size, at, _ in asked]
            made |= {"draws": p.shape[1], "p": squeezed(p.ravel()) if p.size else None, "rooms": squeezed(rooms.ravel()) if rooms.size else None}
            out.append(made)
        return pa.Table.from_pylist(out, schema=arrow)

    schema = f"{WORDS}, t binary, p binary, rooms binary, draws int, total long, mass double, part int, opened binary, now binary"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    draws = F.col("draws") if "draws" in state.columns else F.lit(0).alias("draws")
    source = state.select("home", "size", "room", "words", "ids", "c", "t", "p", "rooms", draws)
    return source.groupBy("home").cogroup(shares.groupBy("home")).applyInArrow(run, schema)


def _seat_pairs(pairs: DataFrame, answers: DataFrame, sweep: int, counts: bool) -> DataFrame:
    """New tables of each pair in the restaurant of its first word, which join the sum if the sweep `counts`."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, told = [], right.sort_by("home")
        for pair in left.to_pylist():
            _, first, second = distinct_words(pair)
            opened, now = all_restored(told, "opened", np.int64)[first], all_restored(told, "now", float)[second]
            c = restored(pair["c"], pair["size"], np.int64)
            before = restored(pair["t"], pair["size"], np.int64) if pair["t"] else np.ones(len(c), np.int64)
            t = seat(c, opened - before, now, CONTEXT_STRENGTH, np.random.default_rng([1 + sweep, 1 << 32, pair["part"], 0]))
            so_far = restored(pair["sum"], pair["size"], np.int64) if pair["sum"] else 0
            out.append(pair | {"t": squeezed(t), "sum": squeezed(so_far + counts * t), "shared": int((c - t).sum())})
        return pa.Table.from_pylist(out, schema=arrow)

    schema = f"{PAIRS}, t binary, sum binary, shared long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    return pairs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(run, schema)
