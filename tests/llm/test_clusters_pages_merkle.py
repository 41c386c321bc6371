"""Centroid clusters, page text and Merkle manifest against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import html
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentionlab.llm import clusters, merkle, pages
from mentionlab.llm.queries import op11_centroid_clusters, op12_page_text, op13_merkle_manifest

# ---------------------------------------------------------------- centroid clusters

VEC = "vec_id bigint, embedding array<double>, cluster string, `Lower` double, v int"


def brute_clusters(rows, k, rounds, dims, scale=64, seed=1):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assign():
        return [min(range(len(centroids)), key=lambda c: (dist(v, centroids[c]), c)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    return sorted(((i, c, min(dist(v, centroids[c]), clusters.LONGEST)) for (i, v), c in zip(kept, assign(), strict=True)),
                  key=repr), centroids


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.5, None) for i, v in rows], VEC)


@pytest.mark.parametrize("spread", [0.0, 0.3])
def test_clusters_equal_brute_force(spark, spread):
    r = random.Random(4)
    centres = [[r.uniform(-2, 2) for _ in range(8)] for _ in range(6)]
    rows = [(n, [c + r.gauss(0, spread) for c in r.choice(centres)]) for n in range(400)]
    rows += [(n, rows[n][1]) for n in range(30)] + [(None, rows[0][1]), (None, rows[5][1])]  # repeated rows, no ids
    rows += [(900, None), (901, []), (902, [0.1] * 7), (903, [0.1] * 7 + [None]), (904, [0.1] * 7 + [math.nan]),
             (905, [math.inf] * 8), (906, [-0.0] * 8)]
    found, centroids = clusters.cluster_vectors(vectors(spark, rows), k=7, dims=8)
    want, want_centroids = brute_clusters(rows, 7, 3, 8)
    assert sorted(((x.vec_id, x.cluster, x.distance) for x in found.collect()), key=repr) == want
    assert centroids == want_centroids


def test_clusters_of_huge_components_few_rows_and_none(spark):
    rows = [(1, [1e30, -1e30]), (2, [1e30, -3e29]), (3, [5.0, 2e9]), (4, [5.0, -2e9]), (5, [0.0, 0.5])]
    found, centroids = clusters.cluster_vectors(vectors(spark, rows), k=3, dims=2)
    want, want_centroids = brute_clusters(rows, 3, 3, 2)
    assert sorted(((x.vec_id, x.cluster, x.distance) for x in found.collect()), key=repr) == want
    assert centroids == want_centroids
    found, centroids = clusters.cluster_vectors(vectors(spark, rows[:2]), k=16, dims=2)
    assert len(centroids) == 2 and [x.distance for x in found.collect()] == [0, 0]
    assert clusters.cluster_vectors(vectors(spark, []))[0].collect() == []
    assert clusters.with_inertia(*clusters.cluster_vectors(vectors(spark, []))).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10_000))
def test_tight_loss_holds_and_is_at_most_the_drift(seed):
    r = np.random.default_rng(seed)
    d = int(r.integers(2, 6))
    centre, radius = r.normal(size=d), abs(r.normal()) * r.choice([0.01, 0.3, 1.0])
    old = r.normal(size=d) * r.choice([0.1, 2.0])
    new = old + r.normal(size=d) * r.choice([0.0, 0.1, 2.0])
    x = r.normal(size=(200, d))
    x = centre + x / np.linalg.norm(x, axis=1)[:, None] * radius * r.random((200, 1)) ** (1 / d)
    loss = (np.linalg.norm(x - old, axis=1) - np.linalg.norm(x - new, axis=1)).max()
    bound = clusters.tight_loss(centre, radius, old, new)
    assert loss <= bound + 1e-12 and bound <= np.linalg.norm(new - old) * (1 + 1e-7)


def test_tight_bounds_scan_less_than_full_drift(spark, monkeypatch):
    r = np.random.default_rng(2)
    centres = r.normal(size=(16, 64)) * 2
    x = centres[r.integers(0, 16, 3000)] + r.normal(size=(3000, 64)) * 0.35
    df = spark.createDataFrame([(i, v.tolist(), "", 0.0, 0) for i, v in enumerate(x)], VEC)
    tight, _ = clusters.cluster_vectors(df)
    tight = {t.vec_id: (t.cluster, t.distance, t.scans) for t in tight.collect()}
    monkeypatch.setattr(clusters, "tight_loss", lambda c, rad, old, new: float(np.linalg.norm(new - old)) * (1 + 1e-9))
    full, _ = clusters.cluster_vectors(df)
    full = {t.vec_id: (t.cluster, t.distance, t.scans) for t in full.collect()}
    assert {i: t[:2] for i, t in tight.items()} == {i: t[:2] for i, t in full.items()}
    assert sum(t[2] for t in tight.values()) < sum(t[2] for t in full.values())


def test_clusters_query_digests(spark):
    rows = op11_centroid_clusters(spark, "/root/testdata/sf0.001").collect()
    assert len({x.inertia for x in rows}) == 1 and sum(x.distance for x in rows) == rows[0].inertia
    for x in rows:
        assert x.cluster_inertia == sum(y.distance for y in rows if y.cluster == x.cluster)
        assert re.fullmatch("[0-9a-f]{64}", x.centroid_sha256)


# ---------------------------------------------------------------- page text

PAGE = "page_id bigint, url string, html string, text string, `N_Shared` int, k1 int"


def site(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 1, 2) for i, u, h in rows], PAGE)


def longest(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14), st.sampled_from([1 << 28, 8]))
def test_alignment_is_a_longest_common_subsequence(a, b, cells):
    before, pages._CELLS = pages._CELLS, cells
    try:
        found = pages.aligned(a, b)
    finally:
        pages._CELLS = before
    assert len(found) == longest(a, b)
    assert all(a[i] == b[j] for i, j in found)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:], strict=False))


def test_alignment_of_long_pages():
    a = [n % 5000 for n in range(20_000)]
    b = a[7000:] + a[:7000]
    assert len(pages.aligned(a, b)) >= 13_000


def test_templates_without_marks_are_found_by_differencing(spark):
    """Pages of bare divs and paragraphs: only another page tells template from text."""
    def page(n, body):
        return ("<html><body><div>The Daily Example</div><p>Home | World | Sport</p>" + body
                + "<p>Read more on our site</p><div>All rights reserved 2024</div></body></html>")

    rows = [(n, f"https://www.site.org/news/{n:03d}", page(n, f"<h2>Story {n}</h2><p>Text of &eacute;vent {n}.</p><p>More {n}.</p>"))
            for n in range(30)]
    rows += [(100 + n, f"https://other.org/{n}", f"<p>Only {n}</p><p>Alone &amp; well</p>") for n in range(1)]
    rows += [(200, None, "<p>no url</p>"), (201, "", None), (202, "https://www.site.org/empty", ""), (None, "//x", "<p>a"),
             (203, "https://www.site.org/news/003", rows[3][2]), (3, "https://www.site.org/news/003", rows[3][2])]
    got = {}
    for x in pages.extract_text(site(spark, rows)).collect():
        got.setdefault(x.page_id, []).append(x.text)
    for n in range(30):
        assert got[n] == [f"Story {n}\nText of évent {n}.\nMore {n}."] * (2 if n == 3 else 1)
    assert got[203] == got[3][:1]
    assert got[100] == ["Only 0\nAlone & well"]
    assert got[200] == ["no url"] and got[201] == [""] and got[202] == [""] and got[None] == ["a"]


def test_near_copies_don_t_empty_each_other(spark):
    body = "".join(f"<p>Sentence {n} of a long syndicated story.</p>" for n in range(40))
    rows = [(n, f"https://a.org/x/{n}", f"<div>Menu</div>{body}<p>Edition {n}</p>") for n in range(4)]
    rows += [(9, "https://a.org/y/1", "<div>Menu</div><p>Another text.</p><p>And on.</p>")]
    got = {x.page_id: (x.text, x.n_shared) for x in pages.extract_text(site(spark, rows)).collect()}
    assert got[9] == ("Another text.\nAnd on.", 1)
    assert all(got[n][0].count("\n") >= 40 for n in range(4))
    assert got[3][1] == 1  # its other neighbour is no copy: the menu goes
    assert pages.extract_text(site(spark, [])).collect() == []


def test_marked_blocks():
    text = lambda page: [t for t, z in pages.page_lines(page) if z == min(z for _, z in pages.page_lines(page))]
    assert text("""<!doctype html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head>
      <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
      <div class="cookie-notice">We use cookies</div><!-- <p>gone</p> -->
      <article class="post"><header><h1>A &lt;title&gt; &amp;\n  more</h1><span>by X</span></header>
      <p>One <b>bold</b> word<br>next<p>Two&nbsp;three
      <div class="ad-slot"><p>Buy</p></div><form><p>Sign up</p></form><aside>Aside</aside>
      <ul><li>item 1<li>item 2</ul><table><tr><td>c1<td>c2</tr></table>
      <div id="comments"><article><p>First!</p></article></div>
      <div hidden>h</div><p role="alertdialog">r</p></article><section class="related"><article>Teaser</article></section>
      <footer>&copy; 2024</footer></body></html>""") == [
        "A <title> & more", "One bold word next", "Two three", "item 1", "item 2", "c1", "c2"]
    assert text("<main><p>a</p></main><p>b</p>") == ["a"]
    assert text("plain < text & <3 <p class='x\">y</p> z") == ["plain < text & <3", "y", "z"]
    assert text("<p>a<script>unclosed </p>") == ["a"]
    assert text("<p>cut <b") == ["cut"] and pages.page_lines("") == [] and pages.page_lines("<p> \n </p>") == []
    assert len(pages.page_lines("<p>x" * 20_000)) == 20_000


def test_page_query_gives_the_articles(spark):
    src = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for x in op12_page_text(spark, "/root/testdata/sf0.01").collect():
        inner = re.search(r"<article>(.*)</article>", src[x.page_id], re.S).group(1)
        blocks = [html.unescape(re.sub(r"</?b>", "", re.sub(r"<br>", " ", s))) for s in re.split(r"</?(?:h1|p)>", inner)]
        assert x.text == "\n".join(" ".join(s.split()) for s in blocks if s.split())
        assert x.n_chars == len(x.text)


def test_url_parts():
    assert pages.url_parts("HTTP://u:p@Example.ORG:80/a/b/?q#f") == ("example.org:80", "/a/b\0?q#f")
    assert pages.url_parts("https://x.org") == ("x.org", "/\0")
    assert pages.url_parts("/a/b") == (None, "") and pages.url_parts(None) == (None, "")


# ---------------------------------------------------------------- Merkle manifest

LEAF = "doc_id bigint, lang string, digest string, text string, `G` int, pos int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_manifest(rows, run):
    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i:i + run])) for i in range(0, len(out[-1]), run)])
        return out

    def siblings(tree, i):
        out = []
        for level in tree[:-1]:
            first = i // run * run
            out += [d for j, d in enumerate(level[first:first + run], first) if j != i]
            i //= run
        return out

    groups = {}
    for i, g, d in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, d))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([d for _, _, d in sorted(groups[g])]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs]) if langs else [[]]
    out = []
    for n, g in enumerate(langs):
        for p, (known, i, d) in enumerate(sorted(groups[g])):
            out.append((i if known else None, d, trees[g][-1][0], top[-1][0], sha("".join(siblings(trees[g], p) + siblings(top, n)))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("run", [2, 3])
def test_manifest_equals_brute_force(spark, run):
    r = random.Random(run)
    rows = [(n, r.choice(["en", "en", "de", None, "", "ñ", "z"]), sha(str(n))) for n in range(700)]
    rows += [(1000, "lone", sha("x")), (5, "en", sha("other")), (5, "en", sha("other")), (None, "de", sha("y")), (None, None, sha("q"))]
    df = spark.createDataFrame([(*x, "t", 1, 2) for x in rows], LEAF)
    out = merkle.merkle_manifest(df, "lang", ["doc_id"], "digest", ["doc_id"], run=run) \
        .withColumn("p", merkle.path_digest(F.col("path"))).withColumn("f", merkle.fold(F.col("digest"), F.col("path"))).collect()
    assert sorted(((x.doc_id, x.digest, x.subroot, x.root, x.p) for x in out), key=repr) == brute_manifest(rows, run)
    assert all(x.f == x.root for x in out)


def test_manifest_of_bands_and_small_tables(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BAND", 2)  # a tree of many bands
    for size in (0, 1, 2, 3, 4, 5, 17, 64, 65):
        rows = [(n, "en", sha(str(n))) for n in range(size)]
        df = spark.createDataFrame([(*x, "t", 1, 2) for x in rows], LEAF)
        out = merkle.merkle_manifest(df, "lang", ["doc_id"], "digest", ["doc_id"]) \
            .withColumn("p", merkle.path_digest(F.col("path"))).collect()
        assert sorted(((x.doc_id, x.digest, x.subroot, x.root, x.p) for x in out), key=repr) == brute_manifest(rows, 2)
    with pytest.raises(ValueError):
        merkle.merkle_manifest(df, "lang", ["doc_id"], "digest", run=1)


def test_manifest_query_notices_what_was_touched(spark):
    src = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op13_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(src)
    for x in rows:
        r = src[x.doc_id]
        fields = [r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")]
        assert x.leaf == sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))
        touched = zlib.crc32(str(x.doc_id).encode()) % 7 == 0 and r["n_chars"] is not None
        assert x.verified is (not touched) and (x.folded_root == x.root) is x.verified
