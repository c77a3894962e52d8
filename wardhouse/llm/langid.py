"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is the sum over
all its segmentations into pieces (forward algorithm); the probability of a text is the product over its words. The
pieces' probabilities are learned by expectation maximisation over all words of the labelled texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardhouse.llm.common import arrow_flow, arrow_map, carried, cut, plain_words, portions, text_bytes

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
# Up to this length the probability of a word and of its parts is a double; those of longer words are kept as logarithms.
# Long words go in groups of about so many characters, in windows of so many positions.
WORD_CHARS, GROUP_CHARS, WINDOW = 48, 200_000, 4_096
# Probability of a character that is no piece, and pseudo-count of every piece in every language.
UNKNOWN, PSEUDO = 1e-6, 0.01
# Words whose values a task keeps; beyond this it starts anew.
CACHE_VALUES = 1_000_000
FLUSH_WORDS = 150_000


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prior: np.ndarray
    pieces: np.ndarray  # probability by piece and language; the last row is the unknown character
    vocabulary: str


class Pieces:
    """The vocabulary's strings, found by a rolling 64-bit hash over code points; a bit table sorts out most others."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        self.strings = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i)]
        self.longest = max(map(len, self.strings))
        hashes = np.zeros(len(self.strings), np.uint64)
        for k, piece in enumerate(self.strings):
            for h in self.rolling(np.array(list(map(ord, piece)), np.uint64)):
                hashes[k] = h[0]
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[hashes >> np.uint64(44)] = True

    def __len__(self) -> int:
        return len(self.strings)

    def rolling(self, codes: np.ndarray, longest: int | None = None):
        """Hashes of all windows of 1, 2, ... code points."""
        mixed = (codes + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        h = mixed
        for n in range(1, (longest or len(codes)) + 1):
            if n > 1:
                h = h[:-1] * self.BASE + mixed[n - 1 :]
            if not len(h):
                return
            yield h

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, -1 for none."""
        out = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.seen[hashes >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        hit = self.hashes[place] == hashes[maybe]
        out[maybe[hit]] = self.order[place[hit]]
        return out


class Lattices:
    """All ways to cut each of some words, of WORD_CHARS at most, into pieces: edges (row, start, end, piece), sorted by end
    and row. Each word is a row."""

    def __init__(self, words: list[str], pieces: Pieces):
        parts = words
        self.length = np.array([len(p) for p in parts])
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        row_of = np.repeat(np.arange(len(parts)), self.length)
        first = np.cumsum(self.length) - self.length
        start_of = np.arange(len(codes)) - first[row_of]
        table = []
        for n, h in enumerate(pieces.rolling(codes, pieces.longest), start=1):
            within = np.flatnonzero(start_of[: len(h)] + n <= self.length[row_of[: len(h)]])
            piece = pieces.find(h[within])
            if n == 1:
                piece[piece < 0] = len(pieces)
            at, piece = within[piece >= 0], piece[piece >= 0]
            table.append(np.stack([row_of[at], start_of[at], start_of[at] + n, piece]))
        table = np.concatenate(table, axis=1)
        table = table[:, np.argsort(table[2] * len(parts) + table[0], kind="stable")]
        self.row, self.start, self.end, self.piece = table
        self.cuts = np.searchsorted(self.end, np.arange(1, self.length.max() + 2))

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """weight: by edge (and language). Sum over all ways to reach each position, by row and position."""
        alpha = np.zeros((len(self.length), len(self.cuts), *weight.shape[1:]))
        alpha[:, 0] = 1
        for e in range(1, len(self.cuts)):
            at = slice(self.cuts[e - 1], self.cuts[e])
            rows = self.row[at]
            if len(rows):
                first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                alpha[rows[first], e] = np.add.reduceat(alpha[rows, self.start[at]] * weight[at], first, axis=0)
        return alpha

    def usage(self, weight: np.ndarray) -> np.ndarray:
        """Probability that a segmentation drawn from the model uses each edge."""
        alpha = self.forward(weight)
        total = np.maximum(alpha[np.arange(len(self.length)), self.length], 1e-300)
        beta = np.zeros(alpha.shape)
        beta[np.arange(len(self.length)), self.length] = 1
        used = np.zeros(len(weight))
        for e in range(len(self.cuts) - 1, 0, -1):
            at = slice(self.cuts[e - 1], self.cuts[e])
            rows, start = self.row[at], self.start[at]
            behind = weight[at] * beta[rows, e]
            used[at] = alpha[rows, start] * behind / total[rows]
            beta += np.bincount(rows * beta.shape[1] + start, behind, beta.size).reshape(beta.shape)
        return used


class LongWords:
    """Words of any length, side by side. Their edges are made window by window; sums over segmentations are logarithms, as
    the probability of a long word is no double."""

    def __init__(self, words: list[str], pieces: Pieces):
        self.pieces, self.length = pieces, np.array([len(w) for w in words])
        self.codes = np.zeros((len(words), self.length.max()), np.uint32)
        for row, word in enumerate(words):
            self.codes[row, : len(word)] = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)

    def windows(self) -> list[tuple[int, int]]:
        longest = int(self.length.max())
        return [(lo, min(lo + WINDOW, longest)) for lo in range(0, longest, WINDOW)]

    def edges(self, lo: int, hi: int) -> tuple[np.ndarray, ...]:
        """row, start, end, piece of the edges that end behind `lo` and up to `hi`, by end and row, and where each end's begin."""
        base = max(0, lo - self.pieces.longest + 1)
        part = self.codes[:, base:hi].astype(np.uint64)
        rows, width = part.shape
        row_of, start_of = np.repeat(np.arange(rows), width), np.tile(np.arange(width), rows)
        left = np.minimum(self.length - base, width)
        table = []
        for n, h in enumerate(self.pieces.rolling(part.ravel(), self.pieces.longest), start=1):
            stop = start_of[: len(h)] + n
            within = np.flatnonzero((stop <= left[row_of[: len(h)]]) & (stop + base > lo))
            piece = self.pieces.find(h[within])
            if n == 1:
                piece[piece < 0] = len(self.pieces)
            at, piece = within[piece >= 0], piece[piece >= 0]
            table.append(np.stack([row_of[at], start_of[at] + base, start_of[at] + base + n, piece]))
        found = np.concatenate(table, axis=1)
        row, start, end, piece = found[:, np.argsort(found[2] * rows + found[0], kind="stable")]
        return row, start, end, piece, np.searchsorted(end, np.arange(lo + 1, hi + 2))

    def _walk(self, lo: int, hi: int, alpha: np.ndarray, shift: int, row, start, cuts, weight) -> None:
        """Sums up to each position of a window; position p is in column p - `shift` of `alpha`."""
        for e in range(lo + 1, hi + 1):
            at = slice(cuts[e - lo - 1], cuts[e - lo])
            rows = row[at]
            if len(rows):
                first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                alpha[rows[first], e - shift] = np.logaddexp.reduceat(alpha[rows, start[at] - shift] + weight[at], first, axis=0)

    def totals(self, log_weight: np.ndarray) -> np.ndarray:
        """Logarithm of each word's probability by language, from those of the pieces."""
        far, shape = self.pieces.longest, log_weight.shape[1:]
        # Only the sums that an edge can still reach are kept from window to window.
        alpha = np.full((len(self.length), far + WINDOW + 1, *shape), -np.inf)
        alpha[:, far] = 0
        out = np.full((len(self.length), *shape), -np.inf)
        for lo, hi in self.windows():
            row, start, _, piece, cuts = self.edges(lo, hi)
            self._walk(lo, hi, alpha, lo - far, row, start, cuts, log_weight[piece])
            ended = np.flatnonzero((self.length > lo) & (self.length <= hi))
            out[ended] = alpha[ended, self.length[ended] - lo + far]
            alpha[:, : far + 1] = alpha[:, hi - lo : hi - lo + far + 1].copy()
            alpha[:, far + 1 :] = -np.inf
        return out

    def usage(self, log_weight: np.ndarray, lang: np.ndarray, count: np.ndarray, sums: np.ndarray) -> None:
        """Adds to `sums` (language, piece) how often segmentations drawn from the model use each piece, `count` times a word."""
        every = np.arange(len(self.length))
        alpha = np.full((len(every), self.length.max() + 1), -np.inf)
        alpha[:, 0] = 0
        for lo, hi in self.windows():
            row, start, _, piece, cuts = self.edges(lo, hi)
            self._walk(lo, hi, alpha, 0, row, start, cuts, log_weight[piece, lang[row]])
        total, beta = alpha[every, self.length], np.full(alpha.shape, -np.inf)
        beta[every, self.length] = 0
        for lo, hi in reversed(self.windows()):
            row, start, end, piece, cuts = self.edges(lo, hi)
            weight = log_weight[piece, lang[row]]
            for e in range(hi, lo, -1):
                at = slice(cuts[e - lo - 1], cuts[e - lo])
                rows, first = row[at], start[at]
                behind = weight[at] + beta[rows, e]
                used = np.exp(alpha[rows, first] + behind - total[rows]) * count[rows]
                np.add.at(sums, (lang[rows], piece[at]), used)
                # Of the edges that end here, no two of a row begin at the same place.
                beta[rows, first] = np.logaddexp(beta[rows, first], behind)


def by_length(words: list[bytes]) -> tuple[list[int], list[str], list[tuple[list[int], list[str]]]]:
    """Places and letters of the short words, and groups of long ones."""
    texts = ["▁" + w.decode("utf-8", "replace") for w in words]
    short = [k for k, t in enumerate(texts) if len(t) <= WORD_CHARS]
    groups: list[tuple[list[int], list[str]]] = []
    for k in sorted((k for k, t in enumerate(texts) if len(t) > WORD_CHARS), key=lambda k: -len(texts[k])):
        # Longest first: a group is as wide as its first word.
        if not groups or (len(groups[-1][0]) + 1) * len(groups[-1][1][0]) > GROUP_CHARS:
            groups.append(([], []))
        groups[-1][0].append(k)
        groups[-1][1].append(texts[k])
    return short, [texts[k] for k in short], groups


def _word_counts(df: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of (lang, text); counted in each task first."""

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: dict[str, Counter] = {}

        def flush() -> dict:
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            counts.clear()
            return dict(zip(("lang", "word", "n"), zip(*rows)))

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(plain_words(text))
                if sum(map(len, counts.values())) > FLUSH_WORDS:
                    yield flush()
        if any(counts.values()):
            yield flush()

    rows = arrow_flow(df, flow, "lang string, word binary, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expected(words: DataFrame, model: Model) -> DataFrame:
    """(language number, piece number, expected count) under the model."""
    number = {lang: k for k, lang in enumerate(model.languages)}

    def flow(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        pieces = Pieces(model.vocabulary)
        sums = np.zeros((len(number), len(pieces) + 1))
        for batch in batches:
            langs = np.array([number[x] for x in batch.column("lang").to_pylist()])
            counts = batch.column("n").to_numpy()
            short, words, groups = by_length(batch.column("word").to_pylist())
            if words:
                lattice, lang, count = Lattices(words, pieces), langs[short], counts[short]
                used = lattice.usage(model.pieces[lattice.piece, lang[lattice.row]].astype(float))
                np.add.at(sums, (lang[lattice.row], lattice.piece), used * count[lattice.row])
            for places, words in groups:
                LongWords(words, pieces).usage(np.log(model.pieces.astype(float)), langs[places], counts[places], sums)
        lang, piece = np.nonzero(sums)
        yield {"lang": lang, "piece": piece, "n": sums[lang, piece]}

    rows = arrow_flow(words, flow, "lang int, piece int, n double")
    return rows.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", rounds: int = 2, vocabulary: str = VOCABULARY) -> Model:
    """Learns from every row with text and language. What reaches the driver is bounded by languages times pieces.

    The first round starts from equal probabilities. Without any labelled row the model knows no language.
    """
    source = df.where(df[text_col].isNotNull() & df[lang_col].isNotNull())
    shares = source.groupBy(F.col(lang_col).cast("string").alias("lang")).count().orderBy("lang").collect()
    languages = [r["lang"] for r in shares]
    size = len(Pieces(vocabulary))
    prior = np.log(np.array([r["count"] for r in shares], float) / max(1, sum(r["count"] for r in shares)))
    model = Model(languages, prior, np.full((size + 1, len(languages)), 1 / size, np.float32), vocabulary)
    if not languages:
        return model
    words = cut(_word_counts(source.select(F.col(lang_col).cast("string").alias("lang"), text_bytes(df, text_col).alias("text"))))
    for _ in range(rounds):
        counts = np.full((size + 1, len(languages)), PSEUDO)
        for r in _expected(words, model).toArrow().to_pylist():
            counts[r["piece"], r["lang"]] += r["n"]
        counts[size] = 0
        probabilities = counts / counts.sum(axis=0)
        probabilities[size] = UNKNOWN
        model = Model(languages, prior, probabilities.astype(np.float32), vocabulary)
    return model


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row per row of `df`: id (with `carry` all its columns, as a struct of that name), `lang_pred`, `score`
    (posterior probability of that language).

    Null texts, texts without a letter, and all texts of a model without languages give `und` with score 0. Equal
    posteriors go to the language that sorts first. Ids may be null or repeated; other columns are ignored.
    """
    limit = CACHE_VALUES // max(3, len(model.languages))

    def per_task():
        pieces = Pieces(model.vocabulary)
        cache: dict[bytes, int] = {}
        values = np.zeros((0, len(model.languages)))

        def learn(words: list[bytes]) -> np.ndarray:
            out = []
            for k in range(0, len(words), 5_000):
                part = words[k : k + 5_000]
                short, texts, groups = by_length(part)
                sums = np.zeros((len(part), len(model.languages)))
                if texts:
                    lattice = Lattices(texts, pieces)
                    alpha = lattice.forward(model.pieces[lattice.piece].astype(float))
                    sums[short] = np.log(np.maximum(alpha[np.arange(len(texts)), lattice.length], 1e-300))
                for places, texts in groups:
                    sums[places] = LongWords(texts, pieces).totals(np.log(model.pieces.astype(float)))
                out.append(sums)
            return np.concatenate(out)

        def judge(texts: list[bytes]) -> tuple[list[str], list[float]]:
            nonlocal values
            known = [plain_words(t) for t in texts]
            new = [w for w in set().union(*known) if w not in cache]
            if len(cache) + len(new) > limit:
                cache.clear()
                values = values[:0]
                new = list(set().union(*known))
            if new:
                cache.update(zip(new, range(len(values), len(values) + len(new))))
                values = np.concatenate([values, learn(new)])
            langs, scores = [], []
            for words in known:
                if not words or not model.languages:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                index = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
                total = values[index].sum(axis=0) + model.log_prior
                best = int(total.argmax())
                langs.append(model.languages[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            return langs, scores

        def step(batch: pa.RecordBatch) -> dict:
            langs: list[str] = []
            scores: list[float] = []
            for part in portions(batch.column("text").to_pylist()):
                for column, found in zip((langs, scores), judge(part)):
                    column += found
            return {"id": batch.column("id"), "lang_pred": langs, "score": scores}

        return step

    kept, field = carried(df, id_col, carry)
    text = F.when(has_letter(df[text_col]), text_bytes(df, text_col)).otherwise(F.lit("").cast("binary"))
    source = df.select(kept, text.alias("text"))
    schema = T.StructType([field, *T.StructType.fromDDL("lang_pred string, score double")])
    return arrow_map(source, per_task, schema).withColumnRenamed("id", id_col)
