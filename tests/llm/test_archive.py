"""The archive against an own reading of its files, clusters and search against brute force."""

import gzip
import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardhouse.llm import clusters, lexical, warc

PAGES = "page_id long, url string, html string, header string, digest string, payload string, record_type string, id int"


@pytest.fixture(scope="module")
def pages(spark):
    """Null, empty, short, long and repeated payloads, ones that look like records, odd urls, null and repeated ids."""
    big, tricky = "x" * 300_000 + "é", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n" * 4 + "\r\n\r\n"
    rows = [
        (5, "http://a/1", "y" * 100), (3, "http://a/2", "y" * 100), (9, None, "y" * 100), (9, None, "y" * 100), (None, "http://a/3", "y" * 100),
        (1, "http://a/4", "y" * 99), (2, "http://a/5", "y" * 99), (10, "http://a/6", None), (11, "", ""), (12, "http://b/\r\nWARC-Type: x", big),
        (13, "http://b/2", big), (14, "http://c", tricky), (15, "http://c/2", tricky), (None, "http://d", "only null ids " * 20),
        (None, "http://d/2", "only null ids " * 20), (16, "http://e", "é" * 50), (17, "http://e/2", "é" * 50), (4, "http://f", "\x00\r\n" * 50),
        (-7, "http://g", "y" * 101), (20, "http://h", "y" * 101), (20, "http://h", "y" * 101),
    ]
    return spark.createDataFrame([(*r, "h", "d", "p", "t", 1) for r in rows], PAGES).repartition(4)


def expected_records(rows):
    groups = defaultdict(list)
    for i, body in rows:
        groups[(body or "").encode()].append(i)
    out = Counter()
    for body, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        for i in ids:
            refers = len(body) >= 100 and least is not None and i != least
            out[(i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if refers else "response", least if refers else None)] += 1
    return out


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_archive_edges(spark, pages, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    rows = pages.select("page_id", "url", "html").collect()
    got = warc.read_archive(spark, folder).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == expected_records([(r["page_id"], r["html"]) for r in rows])
    # Revisits come back with the payload they refer to.
    assert Counter((r["page_id"], bytes(r["payload"])) for r in got) == Counter((r["page_id"], (r["html"] or "").encode()) for r in rows)
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == stored.select("payload").distinct().count() == len({r["html"] or "" for r in rows})


def plain_records(data):
    """Record by record as the format's text has it: header lines, block of the length given, two line ends."""
    at = 0
    while at < len(data):
        assert data[at : at + 10] == b"WARC/1.1\r\n"
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at + 10 : stop].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        assert len(fields) == len(lines)
        end = stop + 4 + int(fields["Content-Length"])
        assert data[end : end + 4] == b"\r\n\r\n"
        yield fields, data[stop + 4 : end]
        at = end + 4


@pytest.mark.parametrize("packed", ["gzip", "none"])
def test_files_round_trip(spark, pages, tmp_path, packed):
    first, files, second = (str(tmp_path / x) for x in ("first", "files", "second"))
    warc.write_archive(pages, first)
    warc.export(spark, first, files, file_bytes=100_000, compression=packed)
    data = []
    for name in sorted(os.listdir(files)):
        if name.startswith("part-"):
            raw = open(f"{files}/{name}", "rb").read()
            data.append(gzip.decompress(raw) if packed == "gzip" else raw)
    assert len(data) > 1
    found = [record for part in data for record in plain_records(part)]
    assert len(found) == pages.count()
    by_id = defaultdict(set)
    for fields, block in found:
        http, _, payload = block.partition(b"\r\n\r\n")
        assert http.startswith(b"HTTP/1.1 200 OK\r\n")
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
            assert int(re.search(rb"Content-Length: (\d+)", http)[1]) == len(payload)
            by_id[fields["WARC-Record-ID"]].add(payload)
    for fields, block in found:
        if fields["WARC-Type"] == "revisit":
            assert len(by_id[fields["WARC-Refers-To"]]) == 1 and block.endswith(b"\r\n\r\n")

    # Read back from the files, stored anew and written again: the same bytes.
    warc.store_records(warc.read_warc(spark, files), second)
    again = lambda folder: Counter(bytes(r["record"]) for r in warc.records(spark, folder).collect())
    assert again(second) == again(first)
    whole = lambda folder: Counter(tuple(r[c] for c in COLUMNS) for r in warc.read_archive(spark, folder).collect())
    assert whole(second) == whole(first)


def test_other_records(spark, tmp_path):
    """Other kinds of record, fields in another case, folded types, no digest."""
    info = b"WARC/1.0\r\nwarc-type: warcinfo\r\ncontent-length: 11\r\nContent-Type: application/warc-fields\r\n\r\nsoftware: x"
    bare = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Type: text/plain\r\nContent-Length: 0\r\n\r\n"
    http = b"WARC/1.0\r\nWARC-Type: request\r\nContent-Type: application/http; msgtype=request\r\nContent-Length: 18\r\n\r\nGET / HTTP/1.1\r\n\r\n"
    data = b"".join(r + b"\r\n\r\n" for r in (info, bare, http))
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(data[:40]) + gzip.compress(data[40:]))
    (tmp_path / "in" / "empty.warc").write_bytes(b"")
    warc.store_records(warc.read_warc(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    back = Counter(bytes(r["record"]) for r in warc.records(spark, str(tmp_path / "out")).collect())
    assert back == Counter(r + b"\r\n\r\n" for r in (info, bare, http))
    with pytest.raises(ValueError):
        list(warc.parse(info[:-3]))


def test_damage_is_told(spark, pages, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    stored = spark.read.parquet(f"{folder}/payloads").cache()
    stored.count()
    os.rename(f"{folder}/payloads", f"{folder}/old")
    old = spark.read.parquet(f"{folder}/old")
    for broken in (old.where("payload_bytes <> 99"), old.withColumn("payload", old["payload_bytes"].cast("string").cast("binary"))):
        broken.write.mode("overwrite").parquet(f"{folder}/payloads")
        with pytest.raises(Exception, match="missing or damaged"):
            warc.read_archive(spark, folder).select("payload_digest").collect()


def test_different_payloads_under_one_digest_are_told(spark, tmp_path):
    rows = spark.createDataFrame([(1, "d", b"abc"), (2, "d", b"abd")], "id long, digest string, body binary")
    with pytest.raises(Exception, match="different payloads"):
        warc.store_payloads(rows, str(tmp_path / "archive"))


def test_no_pages(spark, pages, tmp_path):
    warc.write_archive(pages.where("false"), str(tmp_path / "archive"))
    assert warc.read_archive(spark, str(tmp_path / "archive")).count() == 0


def brute_clusters(rows, size, k, rounds):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == size and None not in v and all(map(math.isfinite, v))]
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in kept]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centers = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers]
            out.append((i, d.index(min(d)), min(d), v))
        return out

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, c, _, v in assign():
            groups[c].append(v)
        for c, members in groups.items():
            centers[c] = [sum(x) // len(members) for x in zip(*members)]
    last = assign()
    part = Counter()
    for _, c, d, _ in last:
        part[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return Counter((i, c, d, part[c], sum(part.values()), digest[c]) for i, c, d, _ in last)


def as_counter(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


CLUSTER = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@pytest.mark.parametrize("size, k, rounds", [(6, 5, 4), (64, 8, 10), (1, 3, 10), (3, 1, 2), (4, 40, 3)])
def test_clusters(spark, size, k, rounds):
    """Values of a coarse grid, so that distances tie often; copies, odd sizes, unusable rows, clashing columns."""
    rng = np.random.default_rng(size)
    rows = [(i, (rng.integers(-3, 4, size) / 1024 * (1 + i % 3)).tolist()) for i in range(150)]
    rows += [(7, rows[7][1])] * 3 + [(200, None), (201, [0.5] * (size + 1)), (202, [None] * size), (203, [float("nan")] * size)]
    rows += [(204, [float("-inf")] * size), (None, [0.001] * size), (None, [0.002] * size), (205, []), (206, [-1e4] * size), (207, [1e5] * size)]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, cluster int, distance double")
    got = clusters.cluster(df.repartition(3), size=size, k=k, rounds=rounds)
    assert as_counter(got, *CLUSTER) == brute_clusters(rows, size, k, rounds)


def test_cluster_edges(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25])], "vec_id long, embedding array<float>")
    assert as_counter(clusters.cluster(one, size=2), *CLUSTER) == brute_clusters([(1, [0.5, 0.25])], 2, 8, 10)
    for none, size in ((one.where("false"), 2), (one, 3)):
        assert clusters.cluster(none, size=size).count() == 0
    # Beyond what a long can hold as a squared distance: no part, and no overflow just below.
    limit = clusters.largest(2) / 1024
    rows = [(1, [limit, 0.0]), (2, [limit - 1, 1 - limit]), (3, [1 - limit, limit - 1]), (4, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert as_counter(clusters.cluster(df, size=2, k=1, rounds=0), *CLUSTER[:3]) == Counter({t[:3]: 1 for t in brute_clusters(rows[1:], 2, 1, 0)})


def test_the_walk_ends_early():
    """Far centroids get no exact distance, and the nearest is found all the same."""
    rng = np.random.default_rng(1)
    centers = np.sort(rng.integers(-10**6, 10**6, (200, 1)), axis=0) + np.zeros((1, 3), np.int64)
    vectors = centers[rng.integers(0, 200, 500)] + rng.integers(-50, 50, (500, 3))
    lists, measured = clusters.Lists(centers), []
    plain = lists._measure
    lists._measure = lambda v, alive, *rest: (measured.append(len(alive)), plain(v, alive, *rest))
    got, dist = lists.nearest(vectors)
    every = ((vectors[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (got == every.argmin(axis=1)).all() and (dist == every.min(axis=1)).all()
    assert sum(measured) < 500 * 20


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k):
    docs = [(i, Counter(TERM.findall((t or "").translate(LOW)))) for i, t in docs]
    n_docs, words = sum(1 for _, c in docs if c), sum(sum(c.values()) for _, c in docs)
    in_docs = Counter(term for _, c in docs for term in c)
    out = Counter()
    for item, text in items:
        scored = []
        for i, c in docs:
            score = 0
            for term in TERM.findall((text or "").translate(LOW)):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * in_docs[term] + 1)))
                    m = 75 + 25 * sum(c.values()) * n_docs // words
                    score += w * (10**9 * c[term] // (1000 * c[term] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out.update((item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k]))
    return out


SEARCH = ("item_id", "rank", "doc_id", "score")


@pytest.mark.parametrize("most", [lexical.INDEX_BYTES, 6_000, 1])
def test_search(spark, edge_docs, most, monkeypatch):
    """In one block, some, and one per item; few scores and hits at a time; ties, repeats and null ids."""
    monkeypatch.setattr(lexical, "SCORES", 64)
    monkeypatch.setattr(lexical, "HITS", 50)
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "été", "ÉTÉ", "x1", "日本", "delta", "the", "THE"] + [f"w{i}" for i in range(30)]
    docs = [(i, rng.choice([" ", "-", "_", "\x7f"]).join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(120)]
    docs += [(r["doc_id"], r["text"]) for r in edge_docs.collect()] + docs[:5] + [(None, "alpha alpha"), (500, "alpha alpha"), (400, "alpha alpha")]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 15)))) for i in range(12)]
    items += [(20, None), (21, "..."), (22, "nowhere"), (23, "alpha alpha hello"), (23, "word5 world"), (None, "idiot beta")]
    docs_df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, score int, rank int").repartition(5)
    items_df = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, score int, row int")
    got = lexical.search(docs_df, items_df, k=7, index_bytes=most)
    assert as_counter(got, *SEARCH) == brute_search(docs, items, 7)


def test_search_without_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "hello world"), (2, None)], "item_id long, text string")
    assert lexical.search(no_docs, items).count() == 0
    assert lexical.search(edge_docs, items.where("false")).count() == 0
    assert lexical.search(edge_docs.where("text is null or text = ''"), items).count() == 0
    assert lexical.search(edge_docs, items.where("text is null")).columns == list(SEARCH)


def test_slices_keep_terms_whole():
    text = ("Ab1é日" * 7 + "-" + "x" * 50 + "  \x00y " + "日" * 40).encode()
    want = [t.encode() for t in TERM.findall(text.decode().translate(LOW))]
    for most in (1, 2, 3, 7, 50, 1000):
        assert [w for part in lexical.slices(text, most) for w in part] == want


def test_sums_beyond_doubles():
    """Scores above 2**53 are added up as integers."""
    index = lexical.Index([{"row": 0, "terms": [b"a", b"b"], "counts": [10**7, 3]}, {"row": 1, "terms": [b"b"], "counts": [1]}])
    assert index.words == 10**7 + 3 and index.sizes.tolist() == [1, 2] and index.items.tolist() == [0, 0, 1]
    heaps = lexical.Heaps(1, 2)
    heaps.update(np.array([[2**60 + 1], [2**60], [2**60 + 1]]), np.array([5, 1, 4]), np.array([False] * 3))
    assert heaps.scores.tolist() == [[2**60 + 1] * 2] and heaps.ids.tolist() == [[4, 5]]
