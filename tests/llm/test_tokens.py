import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from wardhouse.llm import bpe, packing


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBPE()


@pytest.fixture(scope="module")
def reference(coder):
    ranks = {token: i for i, token in coder.token.items()}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_random_texts(coder, reference):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab 'st\n\t\r é1.🙂日") for _ in range(rng.randrange(60))) for _ in range(1500)]
    texts += ["", " ", "  a", "a  b ", "it's we'll 'S", "a" * 3000, " " * 300 + "x", "　a", "​ ​", "x  y", "\x1c a\x85b"]
    got = coder.encode(texts)
    assert got == [reference.encode_ordinary(t) for t in texts]
    assert [coder.decode(i) for i in got] == [t.encode() for t in texts]


def test_bpe_leftmost_of_equal_ranks():
    """aa merges first and leftmost: aaaaa is aa aa a, then (aa aa), as no other pair is known."""
    merges = bpe.Merges([(0, 0, 5, 1), (1, 1, 7, 2)])
    assert [x.tolist() for x in merges.encode([np.zeros(n, np.int64) for n in (1, 2, 3, 5, 9)])] == [[0], [1], [1, 0], [2, 0], [2, 2, 0]]


def test_bpe_documents(edge_docs, no_docs, reference):
    rows = bpe.encode_documents(edge_docs).collect()
    texts = [r["text"] or "" for r in edge_docs.collect()]
    assert Counter(tuple(r["ids"]) for r in rows) == Counter(tuple(reference.encode_ordinary(t)) for t in texts)
    assert Counter(bytes(r["decoded"]) for r in rows) == Counter(t.encode() for t in texts)
    digests = bpe.encode_digests(edge_docs).collect()
    want = Counter()
    for r in edge_docs.collect():
        ids = reference.encode_ordinary(r["text"] or "")
        want[(r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in digests) == want
    assert bpe.encode_digests(no_docs).count() == 0


def test_word_tokenizer(monkeypatch):
    """Word by word as the tokenizer does it on whole texts, also when the cache starts anew all the time."""
    plain = Tokenizer.from_file(packing.TOKENIZER)
    rng = random.Random(4)
    pool = ["Hello", "world.", "it's", "don't,", "ÉTÉ", "été.", "é", "Straße,", "3.14", "...", "a.", ".", "<|endoftext|>", "<|ENDOFTEXT|>",
            "x y", "İstanbul.", "ΣΑΣ", "日本語。", "foo.bar", "A.B.,", "K", "'", "'s", "Word", "word,"]
    texts = [rng.choice([" ", "\n", "  ", "\t"]).join(rng.choices(pool, k=rng.randrange(12))) for _ in range(400)]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for limit in (packing.CACHE_WORDS, 5):
        monkeypatch.setattr(packing, "CACHE_WORDS", limit)
        got = packing.WordTokenizer(packing.TOKENIZER)
        assert [np.frombuffer(got([t.encode()])[0], "<u4").tolist() for t in texts] == want


def check_packing(rows, docs, capacity):
    plain = Tokenizer.from_file(packing.TOKENIZER)
    want = Counter()
    for i, text in docs:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want[(i, piece, at, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_pack(edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check_packing(packing.pack(edge_docs).collect(), docs, 2048)
    check_packing(packing.pack(edge_docs, capacity=64).collect(), docs, 64)
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_solver(seed):
    """Exactly the given items, no sequence too long, and hardly more sequences than no packing can go below."""
    rng = np.random.default_rng(seed)
    capacity = 256
    counts = np.zeros(capacity + 1, np.int64)
    np.add.at(counts, np.clip(rng.lognormal(3 + seed / 3, 0.9, 20_000 if seed % 2 else 300).astype(int), 1, capacity), 1)
    plan = packing.solve(counts, capacity)
    used = np.zeros_like(counts)
    for config, times in plan:
        assert sum(length * n for length, n in config) <= capacity and times > 0
        for length, n in config:
            used[length] += n * times
    assert (used == counts).all()
    need = max(-(-int(counts @ np.arange(capacity + 1)) // capacity), int(counts[capacity // 2 + 1 :].sum()))
    assert sum(n for _, n in plan) <= need * 1.01 + 2
    assert packing.solve(np.zeros(capacity + 1, np.int64), capacity) == []


def test_knapsack():
    price = np.array([0, 1.0, 3.0, 4.5, 0, 0])
    value, first = packing.best_values(price, 5)
    assert value.tolist() == [0, 1, 3, 4.5, 6, 7.5] and first[0] == 0


def test_configurations_beat_first_fit():
    """Lengths where greedy placing in falling order wastes space: 6 x 4, 6 x 3 and 6 x 3 into 10s fill them fully."""
    counts = np.zeros(11, np.int64)
    counts[4], counts[3] = 60, 120
    assert sum(n for _, n in packing.solve(counts, 10)) == 60


def test_digests_spell_each_chunk_once(monkeypatch):
    """Counts, decimals and decoded bytes are those of the whole ids, whether chunks are kept spelled or not."""
    texts = ["", "a b a  b\n\nc", " the cat, the dog the end ", "日本語 テキスト 🙂 the cat", "x" * 300 + " the"] * 3
    for most in (0, 3, 10_000):
        monkeypatch.setattr(bpe, "SPELLED_PIECES", most)
        coder = bpe.ByteBPE()
        decoded, decode = [], coder.decode
        monkeypatch.setattr(coder, "decode", lambda ids: decoded.append(ids) or decode(ids))
        found = coder.digests(texts)
        assert [(n, i[1:], d) for n, i, d in found] == [(len(i), ",".join(map(str, i)), t.encode()) for i, t in zip(coder.encode(texts), texts)]
    assert len(decoded) == len(coder.spelled)
