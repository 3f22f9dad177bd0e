"""Ranked search, page extraction and the Merkle manifest against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm.doc_trie import NO_ID, Items, Search, grow, search_documents, terms_of
from farebox.llm.html_extract import extract_pages, main_text, stretches
from farebox.llm.merkle import FAN, levels_above, manifest, merkle_proofs, numbered

from ..conftest import SF_SMALL
from .conftest import BASE, PASSAGE, expected, hard_texts, rows


# ---------------------------------------------------------------------------
# Ranked search
# ---------------------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k=50):
    bags = [(i, Counter(t)) for i, t in ((i, brute_terms(t)) for i, t in docs) if t]
    n_docs, n_terms = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in bags:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(brute_terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(sorted(scores)[:k])]
    return out


ITEMS = [(1, "the of, and"), (2, None), (3, ""), (4, "no-such_word qqqq"), (5, BASE), (5, BASE), (6, PASSAGE.upper()), (7, "ÀÉÎ zero ODYSSEUS İstanbul"),
         (8, "id at all AT ALL"), (None, "w1 w2 w3 x"), (9, "same"), (10, "!!! \t 12 2024 3.14")]


def test_terms():
    text = "a-B_c\x00d é1É\x7f９{x}İ"
    assert [t.decode() for t in terms_of(text.encode())] == brute_terms(text) == ["a", "b", "c", "d", "é1É", "９", "x", "İ"]


@pytest.mark.parametrize("options", [{}, {"block_vectors": 7, "item_bytes": 900}, {"k": 3, "block_vectors": 1}])
def test_ranked_search(spark, docs, texts, options):
    items = spark.createDataFrame(ITEMS, "item_id int, text string").withColumns({"rank": F.lit(1), "doc_id": F.lit("x"), "block": F.lit(0)})
    got = search_documents(docs, items, **options)
    assert dict(got.dtypes)["item_id"] == "int"
    assert rows(got, "item_id", "rank", "doc_id", "score") == expected(brute_search(texts, ITEMS, options.get("k", 50)))


def test_benchmark_items(spark, docs, texts):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    want = brute_search(texts, [(r["item_id"], r["text"]) for r in items.collect()])
    assert rows(search_documents(docs, items), "item_id", "rank", "doc_id", "score") == expected(want)


def test_copies_rank_by_id(spark):
    docs = spark.createDataFrame([(i, "copied text here") for i in range(300, 0, -1)] + [(1000, "other words")], "doc_id long, text string").repartition(3)
    got = search_documents(docs, spark.createDataFrame([(1, "copied")], "item_id long, text string"), block_vectors=40)
    assert [r["doc_id"] for r in got.orderBy("rank").collect()] == list(range(1, 51))


def test_search_of_nothing(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert search_documents(empty, items).collect() == []
    assert search_documents(docs, items.limit(0)).collect() == []
    assert search_documents(docs, items.where("item_id in (2, 3)")).collect() == []


def test_subtree_bounds_hold():
    """A node's bound is at least the score of every document below it."""
    rng = np.random.default_rng(3)
    vectors = []
    for i in range(200):
        terms = np.sort(rng.choice(40, rng.integers(0, 12), replace=False))
        vectors.append((terms.astype(">u4").tobytes(), rng.integers(1, 9, len(terms)).astype("<u4").tobytes(), int(rng.integers(50, 300)), i))
    root = grow(vectors)
    items = Items([0, 1], {}, np.array([0, 5, 30]), np.concatenate([np.arange(5), np.arange(10, 35)]))
    search = Search(items, rng.integers(0, 9000, 40), k=5)
    everyone = np.arange(2)

    def leaves(node):
        return [node] if node.ids is not None else [x for c in node.children for x in leaves(c)]

    def check(node):
        for leaf in leaves(node):
            assert (search.bounds(node, everyone) >= search.bounds(leaf, everyone)).all()
            assert node.least_id <= min(leaf.ids) and node.m <= leaf.m
        for child in node.children:
            check(child)

    check(root)
    assert sorted(i for leaf in leaves(root) for i in leaf.ids) == list(range(200))
    search.walk(root)
    for item in range(2):
        scores = sorted((-int(search.bounds(leaf, everyone)[item]), i) for leaf in leaves(root) for i in leaf.ids)
        assert search.best[item] == [x for x in scores if x[0] < 0][:5]
    assert NO_ID > 200 and grow([]) is None


# ---------------------------------------------------------------------------
# Page extraction
# ---------------------------------------------------------------------------
class Article(HTMLParser):
    """Blocks of the article element, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag in ("p", "h1", "article"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag in ("p", "h1"):
            self.blocks.append("")
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_generated_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").withColumns({"text": F.lit("other"), "n_chars": F.lit("x"), "row": F.lit(1)})
    got = {r["page_id"]: r for r in extract_pages(pages).collect()}
    for r in pages.collect():
        parser = Article()
        parser.feed(r["html"])
        parser.close()
        blocks = [" ".join(b.split()) for b in parser.blocks]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (want, len(want), r["url"])


LONG = "This is a sentence of the article itself, long enough to make the window surge at once. " * 2
P = LONG.strip()
CASES = {
    "menus and footer by class": (f'<div id="top-menu"><ul><li><a href=x>Home</a><li>News</ul></div><div class=content><h1>Title</h1><p>{P}<p>Be.</div>'
                                  f'<div class="site-footer"><p>{P}</p></div>', f"Title\n\n{P}\n\nBe."),
    "advert within the text": (f'<div class=content><p>{P}</p><div class="ad-slot">{P}</div><p>Last</div>', f"{P}\n\nLast"),
    "sidebar and reader comments": (f'<div><h2>Head</h2><p>{P}</div><div class=sidebar><p>{P}</div><section id="comments"><article><p>{P}</article></section>', f"Head\n\n{P}"),
    "scripts, styles, forms": (f'<script>var a = "<p>{P}</p>";</script><style>p {{}}</style><form><p>{P}<input></form><main><p>{P}</main><noscript>{P}</noscript>', P),
    "cookie notice, header, aside": (f'<div class="cookie-notice">{P}</div><header><h1>Site</h1>{P}</header><article><header><h1>T</h1></header>{P}<aside>{P}</aside> x</article>',
                                     f"T\n\n{P}\n\nx"),
    "references and white space": ("<article><p>a &amp; b&nbsp;&lt;i&gt;\n\t <b>c</b>d<br>e &copy; &#233;&#x41; &amp;lt;</p></article>", "a & b <i> cd e © éA &lt;"),
    "comments and declarations": (f"<!DOCTYPE html><!-- <p>{P}</p> --><?xml x?><p>{P}<!-- > --> on<![CDATA[ cd]]></p>", f"{P} on cd"),
    "unclosed menu before the article": (f"<nav><ul><li><a href=/>x</a><article><p>{P}</article>", P),
    "unclosed elements": (f"<article><p><b>{P}<br><p>two<ul><li>one<li>two</ul>", f"{P}\n\ntwo\n\none\n\ntwo"),
    "quotes in attributes": (f'<article><p title="a > b" data-x=\'"\'>{P}</p><img alt="<p>no</p>"></article>', P),
    "broken quotes": (f'<article><p title="a>{P}</p></article>', P),
    "hidden": (f'<article><p hidden>{P}</p><div style="display: none">{P}</div><p>{P} x</p></article>', f"{P} x"),
    "short article": ("<nav><a>Home</a></nav><article><h1>A</h1><p>b</p></article><footer>c</footer>", "A\n\nb"),
    "links alone": ("<p><a href=x>one</a></p><p><a href=y>two</a></p>", ""),
    "link within the text": (f"<div><p>{P}</p><p><a href=x>See here</a></p><p>{P}</p></div>", f"{P}\n\nSee here\n\n{P}"),
    "two texts, links between": (f"<p>{P}</p>" + "<p><a href=x>x</a></p>" * 4 + f"<p>{P} b</p>", f"{P}\n\n{P} b"),
    "header of an article": (f"<article><header class='article-header'><h1>T</h1><p>By me, today</p></header><p>{P}</p></article>", f"T\n\n{P}"),
    "content with a sidebar": (f'<div class="content with-sidebar"><p>{P}</p></div><div class="sidebar-content">{P}</div>', P),
    "copyright line": (f"<div><p>{P}</p></div><div><p>&copy; 2024 Somebody</p></div>", P),
    "no text": ("<html><body></body></html>", ""),
    "plain text": ("just a < b text", "just a < b text"),
    "script without end": (f"<article><p>{P}</p><script>var x = 1; </p>", P),
    "upper case, table": (f"<ARTICLE><H1>T</H1><TABLE><TR><TD>a</TD><TD>b</TD></TR></TABLE><P CLASS='x'>{P}</ARTICLE>", None),
}


@pytest.mark.parametrize("name", CASES)
def test_page_cases(name):
    html, want = CASES[name]
    got = main_text(html)
    if want is None:
        assert got.startswith("T\n\n") and got.endswith(P) and "<" not in got
    else:
        assert got == want


def test_surge_and_dive():
    assert stretches([5, 0, 0, 0, 40, 50, 3, 0, 0, 2, 0, 0, 0, 0, 90]) == [(4, 10), (14, 15)]
    assert stretches([1, 2, 1]) == [(0, 3)]
    assert stretches([]) == [] == stretches([0, 0])


def test_pages_null_long_and_empty(spark):
    long = "<article>" + f"<p>{P}</p>" * 3000 + "</article>"
    pages = spark.createDataFrame([(1, "u", None), (None, None, ""), (2, "u", "<p"), (3, "u", long), (3, "u", long)], "page_id long, url string, html string")
    got = Counter((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in extract_pages(pages).collect())
    text = "\n\n".join([P] * 3000)
    assert got == Counter([(1, "u", "", 0), (None, None, "", 0), (2, "u", "<p", 2), (3, "u", text, len(text)), (3, "u", text, len(text))])
    assert extract_pages(pages.limit(0)).collect() == []


def test_hostile_pages_take_linear_time():
    for piece in ("<", "<a", "<a \"", "<!--", "<![CDATA[", "<div>", "</p>", "<div class='", "&", "<script"):
        main_text(piece * 20_000)


# ---------------------------------------------------------------------------
# Merkle manifest
# ---------------------------------------------------------------------------
def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(table):
    def leaf(r, lower=False):
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]]
        if lower and values[4] is not None:
            values[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in values[4])
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, at):
        for level in levels[:-1]:
            first = at // 8 * 8
            yield level[first:at], level[at + 1:first + 8]
            at //= 8

    groups = {}
    for r in table:
        groups.setdefault(r["lang"], []).append(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[0])
        trees[g] = tree([key[2] for key, _ in groups[g]])
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for nth, g in enumerate(order):
        for at, (key, r) in enumerate(groups[g]):
            siblings = [*way(trees[g], at), *way(top, nth)]
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            h = leaf(r, tampered)
            for left, right in siblings:
                h = sha("".join(left) + h + "".join(right))
            out.append((r["doc_id"], key[2], trees[g][-1][0], top[-1][0], sha("".join(x for a, b in siblings for x in a + b)), h, h == top[-1][0]))
    return out


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_manifest(docs):
    want = brute_manifest(docs.collect())
    assert rows(manifest(docs), *MANIFEST) == expected(want)
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("langs", [[None], ["en"] * 8 + [None], ["en"] * 9 + ["", "é", "z"], ["a"] * 65 + [f"l{i}" for i in range(70)]])
def test_manifest_shapes(spark, langs):
    table = spark.createDataFrame([(i, f"Text {i}", lang, None, i) for i, lang in enumerate(langs)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    assert rows(manifest(table), *MANIFEST) == expected(brute_manifest(table.collect()))


def test_manifest_of_equal_rows(spark):
    table = spark.createDataFrame([(7, "Same", "en", "s", 4)] * 200 + [(i, None, "en", None, None) for i in range(20)],
                                  "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    assert rows(manifest(table), *MANIFEST) == expected(brute_manifest(table.collect()))


def test_manifest_of_nothing(empty):
    got = manifest(empty)
    assert got.columns == MANIFEST and got.collect() == []


def test_proofs_are_paths(spark, docs):
    """Segments: one a level, at most 7 siblings each."""
    proofs, root = merkle_proofs(docs)
    sizes = Counter(r["lang"] for r in docs.collect())
    for r in proofs.collect():
        assert r["leaf"] == r["presented"] and len(r["segments"]) == r["high"] + levels_above(len(sizes))
        assert all(len(s["left"]) + len(s["right"]) < FAN for s in r["segments"])
    assert re.fullmatch("[0-9a-f]{64}", root)


def test_places(spark):
    """Gapless places in order, over many partitions and a group that holds most rows."""
    table = spark.createDataFrame([("a", i * 7 % 5000) for i in range(5000)] + [(None, i) for i in range(40)] + [("b", 1)] * 3, "g string, v int")
    got = numbered(table.repartition(9), ["g"], ["v"], "t-places").collect()
    for group, size in (("a", 5000), (None, 40), ("b", 3)):
        own = sorted((r["place"], r["v"]) for r in got if r["g"] == group)
        assert [p for p, _ in own] == list(range(size)) and [v for _, v in own] == sorted(v for _, v in own)
        assert {r["members"] for r in got if r["g"] == group} == {size}


def test_hard_texts_are_in_the_fixture(texts):
    assert len(texts) > len(hard_texts())
