import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from wardhouse.catalog import check
from wardhouse.llm import ann, html, licenses, oracle

SF = "/root/testdata/sf0.01"
PAGE = (
    '<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head><body>'
    "<header>Site name</header><nav><ul><li><a href=x>Menu {n}</a><li>More</ul></nav><!-- <p>no</p> --><div class='cookie-notice'>We use {n}"
    "</div><article><h1>Title {n}</h1><p>First &lt;b&gt; &eacute;&#233; {n}<p>Second  \n <b>bold{n}</b>er &nbsp;x<br>y<div class=share>Share it"
    "</div><p>Subscribe to us now<ul><li>item {n}</ul></article><section id=comments><p>Reader {n}</p></section><form>Search</form>"
    "<aside>Side {n}</aside><footer>&copy; {n}</footer></body></html>"
)


def want(n):
    return f"Title {n}\nFirst <b> éé {n}\nSecond bold{n}er x y\nitem {n}"


def test_wrapper(spark):
    """The constant line goes with the furniture; what varies stays. Enough pages are needed to call a line constant."""
    rows = [(i, f"http://a.example/{i}", PAGE.format(n=i)) for i in range(8)] + [(100, "https://u@b.example:80/x", PAGE.format(n=100))]
    got = {r["page_id"]: r for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i]["text"] for i in range(8)] == [want(i) for i in range(8)]
    assert got[100]["text"] == want(100).replace("\nitem", "\nSubscribe to us now\nitem")
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_copies_of_an_article_are_no_template(spark):
    rows = [(i, "http://a.example/", "<article><p>Same text</p><p>and more</p></article>") for i in range(50)]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"Same text\nand more"} and len(got) == 50


def test_page_edges(spark):
    pages = [
        (1, None, None), (2, "http://a/", ""), (2, "http://a/", ""), (None, "no url", "just text"), (4, "http://a/", "<p>open <b>bold"),
        (5, "http://a/", "<<>> a < b <p x='>'>ok</p></div></p>tail"), (6, "http://a/", "<script>never closed"), (7, "http://a/", "<div>" * 300 + "deep"),
        (8, "http://a/", "<table><tr><td>a<td>b<tr><td>c</table>"), (9, "http://a/", "<p>" + "long " * 50_000 + "</p>"),
    ]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, text string, host int")
    got = Counter((r["page_id"], r["text"][:20]) for r in html.main_text(df).collect())
    assert got == Counter([
        (1, ""), (2, ""), (2, ""), (None, "just text"), (4, "open bold"), (5, "<<>> a < b\nok\ntail"), (6, ""), (7, "deep"), (8, "a\nb\nc"),
        (9, "long long long long "),
    ])
    assert html.main_text(df.where("false")).count() == 0


def brute_match(a, b):
    """Size of the largest order-preserving top-down match, by trying all."""
    if a[:2] != b[:2]:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), best(xs, ys[1:]), brute_match(xs[0], ys[0]) + best(xs[1:], ys[1:]))

    return 1 + best(a[2], b[2])


def shape(shapes, tree):
    return shapes.add(tree[0], tree[1], tuple(shape(shapes, c) for c in tree[2]))


@pytest.mark.parametrize("cells", [html.CELLS, 1])
def test_tree_matching(cells, monkeypatch):
    """Against all matches; also with tables cut in half down to single rows."""
    monkeypatch.setattr(html, "CELLS", cells)
    rng, shapes = random.Random(6), html.Shapes()

    def tree(depth):
        return (rng.choice("ab"), False, tuple(tree(depth - 1) for _ in range(rng.randrange(4))) if depth else ())

    def labels(t):
        return [t[:2]] + [x for c in t[2] for x in labels(c)]

    for _ in range(150):
        a, b = ("r", False, (tree(2), tree(2))), ("r", False, (tree(2), tree(2)))
        x, y = shape(shapes, a), shape(shapes, b)
        found = shapes.matched(x, y)
        assert shapes.align(x, y)[0] == brute_match(a, b) == len(found)
        # Element numbers are those in which elements begin; matched ones are alike and keep their order.
        assert all(labels(b)[theirs] == labels(a)[ours] for theirs, ours in found.items())
        assert sorted(found.values()) == [ours for _, ours in sorted(found.items())]


def test_deep_and_wide_pages(spark):
    """Thousands of nested and of sibling elements, next to ordinary pages of the host."""
    usual = [f"<article><p>Text {i}</p><ul>" + "<li>x</li>" * (i % 3) + "</ul></article>" for i in range(5)]
    deep = "<div>" * 5_000 + "down here" + "</div>" * 5_000
    inline = "<p>" + "<b>" * 5_000 + "bold" + "</b>" * 5_000
    items = ["<li>a</li>", "<li><p>b</p></li>", "<li><p>c</p><p>d</p></li>"]
    wide = ["<article><ul>" + "".join(random.Random(k).choices(items, k=20_000)) + "</ul></article>" for k in range(2)]
    pages = [*usual, deep, deep.replace("down", "also"), inline, *wide]
    rows = [(i, "http://a/", p) for i, p in enumerate(pages)] + [(100 + i, "http://wide/", p) for i, p in enumerate(wide)]
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5] == "down here" and got[6] == "also here" and got[7] == "bold"
    assert all(got[i].startswith(f"Text {i}") for i in range(5))
    for k, page in enumerate(wide):
        assert got[8 + k].split("\n") == got[100 + k].split("\n") == re.findall(r"[abcd](?=<)", page)


def test_attributes_and_names(spark):
    """Values are not names, and a word in a compound is not the name."""
    kept = [
        '<p title="the hidden valley">a</p>', "<p data-state=hidden>a</p>", '<p data-id="search">a</p>', '<div class="has-sidebar"><p>a</p></div>',
        '<div class="entry-header"><h1>a</h1></div>', '<p class="ad-free">a</p>', '<p class="share-price-table">a</p>', "<p id = intro >a</p>",
        '<p title=\'class="ad"\'>a</p>', "<p class=>a</p>", '<article class="sidebar"><p>a</p></article>', '<p aria-hidden="false">a</p>',
    ]
    gone = [
        "<p hidden>x</p>", "<p HIDDEN=''>x</p>", '<div class="ad">x</div>', "<div class='box ad-box'>x</div>", '<div id="site-footer">x</div>',
        '<div class="related-articles"><p>x</p></div>', '<div class="user-comments">x</div>', '<div role="navigation">x</div>',
        '<p style="color: red; display : none">x</p>', "<div class=cookie_banner>x</div>", '<p aria-hidden="true">x</p>', '<div class="site-header">x</div>',
        '<a class="share" href="/x">x</a>',
    ]
    rows = [(i, f"http://h{i}/", p) for i, p in enumerate([*kept, *gone])] + [(99, "http://z/", '<p>see <a href="/story?id=share">this link</a> now</p>')]
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {p: got[i] for i, p in enumerate(kept)} == dict.fromkeys(kept, "a")
    assert {p: got[i + len(kept)] for i, p in enumerate(gone)} == dict.fromkeys(gone, "")
    assert got[99] == "see this link now"


def test_pages_of_the_corpus(spark):
    import html as entities

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = html.main_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        lines = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(x for x in lines if x)


def plain_scan(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for i in range(len(words)) for p, label in licenses.PHRASES.items() if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_license_base(spark, edge_docs, no_docs):
    rng = random.Random(7)
    pool = ["cc", "by", "CC-BY", "general", "public", "License", "all", "rights", "Reserved.", "x", "", "ñ", "K"]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(40))) for _ in range(300)] + ["cc by cc by", "cc", None, ""]
    texts += [r["text"] for r in edge_docs.collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:6] for r in licenses.scan(df).collect()}
    assert got == {i: plain_scan(t) for i, t in enumerate(texts)}
    assert licenses.scan(no_docs).count() == 0 and licenses.scan(edge_docs).count() == edge_docs.count()


def test_license_templates(spark):
    """Whole templates, ones with words put in and left out, parts, and grams that repeat: what is found, and all of it
    against SQL."""
    rng = random.Random(8)
    docs, want = [], {}
    for label, text in licenses.TEMPLATES:
        words = text.split()
        kinds = ("whole", "noisy", "part") if len(words) > 20 else ("whole", "part")
        for kind in kinds:
            body = list(words)
            if kind == "noisy":
                body.insert(len(body) // 2, "really")
            elif kind == "part":
                body = body[: len(body) // 3] if len(words) > 20 else body[:-1]
            i = len(docs)
            docs.append((i, "lorem ipsum " * rng.randrange(5) + "\n * ".join(body) + " dolor"))
            want[i] = label if kind != "part" else None
    # A notice whose words stand twice, but never all of them.
    twice = "released under the mit released under the mit under the mit"
    docs += [(9_000, twice), (9_001, "Released under the MIT License. " * 3), (9_002, None), (9_003, "licensed under the apache license, version 2.0.")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    for i, label in want.items():
        found = set(filter(None, rows[i]["labels"].split(",")))
        assert set(filter(None, rows[i]["base_labels"].split(","))) <= found and (label is None or label in found), rows[i]
    assert rows[9_000]["labels"] == "" and rows[9_001]["labels"] == "mit" and rows[9_003]["labels"] == "apache-2.0"
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    assert check.compare(licenses.scan(df), con, oracle.TEXTS["op6_license_scan"]) is None


def test_notices_of_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(docs).collect()}
    for line, label in (("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0")):
        ids = [r["doc_id"] for r in docs.where(docs["text"].contains(line)).select("doc_id").collect()]
        assert ids and all(label in found[i] for i in ids)


def brute(vectors, k=10):
    usable = [(i, np.array(v, float)) for i, v in vectors if i is not None and v is not None and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in usable:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in usable if i != q and len(v) == len(x))
            out[q] = list(dict.fromkeys((i, d) for d, i in near))[:k]
    return out


def found(df, **options):
    out = {}
    for r in sorted(ann.search(df, df["vec_id"] % 100 == 0, **options).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall(spark):
    """Against brute force over clustered vectors, in several shards."""
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 24))
    vectors = [(i, (centers[i % 40] + 0.3 * rng.normal(size=24)).tolist()) for i in range(6_000)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4)
    points = df.select("vec_id", "embedding").toDF("point", "vector")
    assert ann.index(points, 1_500).select("shard").distinct().count() == 4
    got, want = found(df, shard_rows=1_500), brute(vectors)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    assert all(dict(want[q]).get(i, d) == pytest.approx(d) for q in want for i, d in got[q])


def test_vector_edges(spark):
    """Copies in great number, unusable vectors, other dimensions, repeated rows, few candidates, ties."""
    nan, inf = float("nan"), float("inf")
    vectors = [(i, [1.0, 2.0]) for i in range(0, 350)] + [(400, [1.0, 2.5]), (400, [1.0, 2.5]), (500, None), (501, [0.0, 0.0]), (502, [nan, 1.0]),
               (503, [inf, 1.0]), (504, [None, 1.0]), (None, [1.0, 1.0]), (600, [1.0, 2.0, 3.0]), (601, [1.0, 2.0, 4.0]), (700, [3.0, 2.0])]
    df = spark.createDataFrame([(*v, 0, "x") for v in vectors], "vec_id long, embedding array<double>, shard int, point string")
    got, want = found(df), brute(vectors)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in want.items()}
    assert got[600] == [(601, 1.0)] and [i for i, _ in got[300]] == list(range(10))
    assert found(df.where("false")) == {} and found(df.where("vec_id = 100")) == {}


def test_prune_keeps_the_nearest_and_drops_what_it_shades():
    points = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 2], [-3, 0]])
    assert ann._prune(points, np.array([0]), np.array([[4, 3, 2, 1, -1, 0]]), 4, 1.2)[0].tolist() == [1, 3, 4, -1]
