"""Nearest vectors against brute force, url rules by hand, page texts by hand."""

import numpy as np

from nimbus.llm import hnsw, html_text, url_filter


def test_recall_of_a_large_shard():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 32)) * rng.uniform(0.5, 2, (3000, 1))           # norms differ: inner product, not angle
    ids = np.arange(3000)
    lv = hnsw.levels_of(ids)
    order = np.lexsort((ids, -lv))
    g = hnsw.Graph(x[order], lv[order]).build()
    back = hnsw.Graph.stored(g.arrays())
    q = rng.normal(size=(100, 32))
    got, scores = back.search(q, 20)
    best = np.argsort(-(q @ x[order].T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(got, best)]) >= 0.9
    assert np.allclose(scores[0], np.sort(x[order][got[0]] @ q[0])[::-1], rtol=1e-12)


def test_query_over_a_table_with_equal_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    vec = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(300)}
    for i in range(100, 200):
        vec[i] = vec[100]                                                       # a third of the rows are one vector
    bad = {400: None, 420: [], 440: [0.0] * 8, 460: [float("nan")] + [1.0] * 7, 480: [float("inf")] * 8, 500: [1.0, None] + [0.0] * 6}
    rows = [(i, v, "r") for i, v in (vec | bad).items()] + [(0, vec[0], "r"), (None, vec[0], "r"), (600, [1.0, 2.0, 3.0], "r"), (601, [1.0, 0.0, 3.0], "r")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = {}
    for r in hnsw.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    x = np.array([vec[i] for i in range(300)], dtype=np.float64)
    assert sorted(got) == [*range(0, 300, 20), 600]
    for q in range(0, 300, 20):
        s = x @ x[q]
        want = [i for i in sorted(range(300), key=lambda i: (-round(s[i], 12), i)) if i != q][:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert len(set(want) & {i for _, i, _ in mine}) >= 18
        assert all(abs(sc - s[i]) < 1e-9 for _, i, sc in mine)
    assert [(r, i) for r, i, _ in got[600]] == [(1, 601)]
    assert [i for _, i, _ in sorted(got[100])][:2] != [100] and 100 not in [i for _, i, _ in got[100]]
    assert hnsw.nearest(df.limit(0)).count() == 0


def test_rules_and_templates(spark):
    urls = {
        1: "http://a.example.org/es/5", 2: "https://example.org/en/17", 3: "https://x.ORG/en/2", 4: "http://s.com/fr/1", 5: "http://s.com/de/1?x",
        6: "nonsense", 7: None, 8: "http://org/", 9: "http://notexample.org/es/1", 10: "http://only.org", 11: "http://k.net/de/7#top", 12: "http://k.net/fr/7"}
    many = [(1000 + i, f"http://h{i % 3}.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(200)]
    df = spark.createDataFrame([(i, u, "x") for i, u in urls.items()] + [(i, u, "x") for i, u in many], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert len(got) == len(urls) + 200
    rule = {i: (got[i].host, got[i].path, got[i].rule) for i in urls}
    assert rule[1] == ("a.example.org", "/es/5", "example.org/es/") and got[1].verdict == "block"
    assert rule[2] == ("example.org", "/en/17", "example.org/en/1") and got[2].verdict == "block"
    assert rule[3] == ("x.org", "/en/2", "org/") and got[3].verdict == "allow"
    assert (got[4].rule, got[4].verdict, got[5].rule, got[5].verdict, got[5].path) == ("com/fr/", "allow", "com/de/", "block", "/de/1")
    assert rule[6] == ("", "", None) and rule[7] == ("", "", None) and rule[8] == ("org", "/", "org/")
    assert rule[9][2] == "org/" and rule[10] == ("only.org", "", None)
    # learned from the labels of other hosts: the same shapes
    assert got[11].rule is None and got[11].verdict == "block" and got[12].verdict == "allow"
    assert url_filter.judge(df.limit(0)).count() == 0


def test_small_and_unlabelled_branches_keep_to_themselves(spark):
    names = [f"{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]                     # 64 sections of one host
    urls, labels = [], []
    for k, s in enumerate(names):
        urls += [f"http://hot.net/{s}/{i}" for i in range(60)]
        labels += [(f"http://hot.net/{s}/{i}", int(k == 7)) for i in range(60, 100)]
    urls += [f"http://m.s.com/{x}/{i}" for x, n in (("de", 13), ("fr", 6), ("en", 20), ("es", 19)) for i in range(n)]
    urls += [f"http://one.com/{x}/{i}" for x, n in (("de", 13), ("en", 30)) for i in range(n)]
    urls += [f"http://w.org/{x}/{i}" for x in ("en", "es") for i in range(200)]      # allowed by rule: the shapes' prior
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge(df, labelled=spark.createDataFrame(labels, "url string, bad int")).collect()
    hot = {(r.path.split("/")[1], r.template, r.verdict) for r in got if r.host == "hot.net"}
    assert hot == {(s, "/*/*" if k != 7 else f"/{s}/*", "block" if k == 7 else "allow") for k, s in enumerate(names)}
    for host in ("m.s.com", "one.com"):
        rows = [r for r in got if r.host == host]
        assert {(r.path.split("/")[1], r.verdict) for r in rows if r.rule is None} <= {("en", "allow"), ("es", "allow")}
        assert {r.template for r in rows if r.rule is None} == {"/?/*"} and {r.template for r in rows if r.rule} == {"/*/*"}


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_article_without_what_surrounds_it():
    html = page("""<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
      <main><article><h1>Big  &amp; &eacute;t&#233;</h1><p>One<br>two &lt;b&gt; <b>bo</b>ld<p>Second
      <div class="ad-box">Buy</div><ul><li>x<li>y</ul><aside>Related</aside><form><p>Your mail</p></form><script>var a="<p>no</p>";</script>
      <!-- <p>hidden</p> --><style>p{}</style><section id="comments"><article class="comment"><p>First!</p></article></section></article></main>
      <div class="sidebar">Side</div><footer>&copy; 2024</footer>""")
    assert html_text.marked_text(html) == "Big & été\n\nOne two <b> bold\n\nSecond\n\nx\n\ny"
    assert html_text.marked_text(None) == "" == html_text.marked_text("")
    assert html_text.marked_text("<article><p>cut off <b>here") == "cut off here"


def test_pages_without_a_mark_lose_the_lines_of_their_neighbour(spark):
    same = "<div>Welcome to the site</div>{}<div>All rights reserved</div>"
    rows = [(i, f"http://h.com/a/{i}", page(same.format(f"<p>Story number {i} tells of {'many ' * 20} things {i}</p>"))) for i in range(4)]
    copy = page("<div>Alone</div><p>A copied text</p>")
    rows += [(10, "http://copies.com/x/1", copy), (11, "http://copies.com/x/2", copy), (12, None, copy), (13, "http://h.com/m", None),
             (14, "http://h.com/n", page("<article><p>Marked</p></article>")), (14, "http://h.com/n", page("<article><p>Marked</p></article>"))]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int").repartition(1)
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    assert html_text.extract(df).count() == len(rows)
    for i in range(4):
        assert got[i].text.startswith(f"Story number {i}") and "Welcome" not in got[i].text and "rights" not in got[i].text
    assert got[10].text == got[11].text == got[12].text == "Alone\n\nA copied text"
    assert (got[13].text, got[13].n_chars, got[14].text) == ("", 0, "Marked")
    assert html_text.extract(df.limit(0)).count() == 0


def test_copies_and_partition_edges_are_differenced_alike(spark):
    def body(story):
        return page(f"<div>Welcome to the site</div><p>{story}</p><div>All rights reserved</div>")
    copied, near = (f"{w} story, " + "long and with many words " * 20 for w in ("A copied", "A nearly copied"))
    rows = [(0, "http://h.com/a/0", body("First of its own")), (99, "http://h.com/z", body("Last of its own"))]
    rows += [(i, f"http://h.com/b/{i:02}", body(copied)) for i in range(10, 40)] + [(i, "http://h.com/b/same", body(copied)) for i in (40, 41, 42)]
    # near copies: another last line each
    rows += [(i, f"http://h.com/c/{i}", body(near + f"</p><p>Part {i}")) for i in range(50, 60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {0: "First of its own", 99: "Last of its own"} | dict.fromkeys(range(10, 43), copied.strip()) | {i: f"{near.strip()}\n\nPart {i}" for i in range(50, 60)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        for n in (1, 7, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            assert {r.page_id: r.text for r in html_text.extract(df).collect()} == want, n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)


def test_common_lines_are_a_longest_common_subsequence():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (rng.choice(list("abcd"), rng.integers(0, 9)).tolist() for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = best[i, j] + 1 if a[i] == b[j] else max(best[i, j + 1], best[i + 1, j])
        shared = [a[i] for i in sorted(html_text.common_lines(a, b))]
        rest = iter(b)
        assert len(shared) == best[-1, -1] and all(x in rest for x in shared)


def test_names_inside_an_article_count_as_a_whole():
    def inside(x):
        return html_text.marked_text(f"<body><article><p>one</p>{x}<p>two</p></article></body>").split("\n\n")[1:-1] == ["some"]
    for kept in ('<h2 id="related-work">some</h2>', '<p class="dialog">some</p>', '<section id="search-methods"><p>some</p></section>',
                 '<p class="code-comment">some</p>', '<div class="article-header">some</div>', '<header>some</header>', '<div class="share-price">some</div>'):
        assert inside(kept), kept
    for gone in ('<div class="ad header-ad">some</div>', '<div class="sidebar" data-x="header">some</div>', '<div class="related-posts">some</div>',
                 '<div id="comments"><p>some</p></div>', '<div class="adSlot">some</div>', '<p hidden>some</p>', '<ul class="social-links"><li>some</li></ul>',
                 '<p style="display:none">some</p>', '<div class="comment-list">some</div>', '<div class="side-bar">some</div>'):
        assert not inside(gone), gone


def test_paragraphs_of_links_stay():
    page = '<body><div><p><a href="x">a paragraph that is one link</a></p><ul><li><a href="y">menu</a></li></ul></div></body>'
    assert html_text.marked_text(page) == "a paragraph that is one link"


def test_very_long_page(spark):
    page = "<article>" + "<p>word</p>" * 60000 + "</article>"
    got = html_text.extract(spark.createDataFrame([(1, "http://a.org/x", page)], "page_id long, url string, html string")).first()
    assert got.n_chars == 60000 * 4 + 59999 * 2


def test_every_page_of_a_host_is_differenced_and_its_mark_checks_the_result(spark):
    """Pages with a marked article are compared too, keep what articles share, and are evidence for pages without a mark."""
    site = "<div>Welcome to the site</div>{}<div>All rights reserved</div>"
    rows = [(i, f"http://h.com/a/{i}", page(site.format(f"<article><p>A passage that all share</p><p>Story {i} of {'many ' * 20} things</p></article>")))
            for i in range(3)]
    rows += [(9, "http://h.com/a/9", page(site.format(f"<p>A passage that all share</p><p>{'Without a mark ' * 20}</p>")))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got == {i: f"A passage that all share\n\nStory {i} of {'many ' * 20}things" for i in range(3)} | \
        {9: f"A passage that all share\n\n{('Without a mark ' * 20).strip()}"}
    seen = [r for x in html_text._codes(df.selectExpr("url", "url AS path", "html").toArrow().to_batches()) for r in x.to_pylist()]
    assert all(len(r["codes"]) == 4 for r in seen) and sorted(sum(r["marked"]) for r in seen) == [0, 2, 2, 2]


def test_long_pages_are_compared_in_bounded_memory():
    a, b = ["x"] * 60000 + [f"a{i}" for i in range(30000)], ["x"] * 60000 + [f"b{i}" for i in range(30000)]
    assert html_text.common_lines(a, b) == set(range(60000))


def test_a_line_of_the_article_that_its_neighbour_has_outside_of_its_own_is_deleted(spark):
    rows = [(0, "http://h.com/a/0", page(f"<article><p>Story 0 {'many ' * 20}</p><p>Write to us</p><p>Shared</p></article>")),
            (1, "http://h.com/a/1", page(f"<article><p>Story 1 {'other ' * 20}</p><p>Shared</p></article><p>Write to us</p>")),
            # the neighbour marks nothing, so what it has may be its article
            (2, "http://i.com/a/0", page(f"<article><p>Story 2 {'many ' * 20}</p><p>Write to us</p></article>")),
            (3, "http://i.com/a/1", page(f"<p>Story 3 {'other ' * 20}</p><p>Write to us</p>")),
            # an article is never deleted as a whole
            (4, "http://j.com/a/0", page("<article><p>Write to us</p></article>")),
            (5, "http://j.com/a/1", page(f"<article><p>Story 5 {'other ' * 20}</p></article><p>Write to us</p>"))]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    many, other = ("many " * 20).strip(), ("other " * 20).strip()
    assert got == {0: f"Story 0 {many}\n\nShared", 1: f"Story 1 {other}\n\nShared", 2: f"Story 2 {many}\n\nWrite to us",
                   3: f"Story 3 {other}\n\nWrite to us", 4: "Write to us", 5: f"Story 5 {other}"}
