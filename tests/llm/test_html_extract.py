from pyspark.sql import functions as F

from flightlake.llm import html_extract as op

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p><p>x</p>";</script></head>
<body class="home menu"><header>Site</header><nav><ul><li><a href="/x">X</a></li></ul></nav><div class="ad">Buy</div>
<article><header><h1>Head &amp;  line</h1></header><p>One <b>two</b>three<br>four<p>Five &lt;six&gt; &eacute;&nbsp;x
<div class="cookie-notice">No</div><ul><li>a<li>b</ul><form>f<input></form><!-- <p>no</p> --><section id="comments"><p>bad</p></section>
<p>end</article><aside>side</aside><footer>&copy; f</footer>"""
TEXT = "Head & line One twothree four Five <six> é x a b end"


def texts(spark, rows, **kw):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return {r.page_id: r for r in op.extract(df).collect()}


def test_article_of_a_page(spark):
    got = texts(spark, [("http://a.org/1", PAGE), ("http://a.org/1", PAGE), (None, PAGE), ("http://a.org/2", None), ("http://a.org/3", ""),
                        ("x", "plain  text"), ("http://a.org/4", "<article>" + "<p><b>w " * 50000 + "</article>"),
                        ("http://b.org", "<article><p>cut &am"), ("http://b.org", "<p>a < b <3 <"), ("http://b.org", "<article class=comment>x</article>")])
    assert [got[i].text for i in range(6)] == [TEXT, TEXT, TEXT, "", "", "plain text"]
    assert got[6].n_chars == 99999 and got[7].text == "cut &am" and got[8].text.startswith("a < b") and got[9].text == ""
    assert got[0].n_chars == len(TEXT) and got[0].url == "http://a.org/1"


def test_style_tree_drops_presentation_without_names(spark):
    rows = [("http://h.org/%d" % i, f"<body><div class=q><p>Log in or join us today</p></div><div class=w><p>Story number {i} of {i * i}</p></div></body>") for i in range(12)]
    rows += [("http://k.org/%d" % i, "<body><p>same words</p></body>") for i in range(3)]
    got = texts(spark, rows)
    assert [got[i].text for i in range(12)] == [f"Story number {i} of {i * i}" for i in range(12)]
    assert {got[i].text for i in range(12, 15)} == {"same words"}  # under MIN_PAGES pages


def test_importance_is_one_less_entropy(spark):
    df = spark.createDataFrame([(i, "http://h.org/", f"<div><p>{'same' if i < 8 else i}</p></div>") for i in range(16)], "page_id long, url string, html string")
    row = op.style_tree(op._parsed(df)).first()
    assert row.pages == 16 and abs(row.importance - (8 * (1 - 0.75) + 8) / 16) < 1e-9


def test_extra_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.org/", "<article>x</article>", 5, "p", "t")], "page_id long, url string, html string, host int, parts string, text string")
    assert op.extract(df).first().asDict() == {"page_id": 1, "url": "http://a.org/", "text": "x", "n_chars": 1}
    assert op.extract(df.limit(0)).count() == 0
    assert op.extract(df.withColumn("page_id", F.lit(None).cast("long"))).count() == 1


def test_tree_weighs_blocks_inside_articles(spark):
    page = "<body><article><p>Story {0} of {1} and what came of it</p><div class=q><p>Read this on our other site</p></div><ul><li>{0}</li></ul></article></body>"
    rows = [("http://h.org/%d" % i, page.format(i, i * i)) for i in range(12)]
    # Copies of one article, exact and near, are no presentation, nor is an article that a site repeats with new titles.
    copy = "<body><article><h2>Of old</h2><p>One article that many pages hold</p><ul><li>same</li></ul><h3>%s</h3></article></body>"
    rows += [("http://k.org/%d" % i, copy % (i // 2)) for i in range(12)]
    rows += [("http://m.org/%d" % i, f"<body><main><h1>{i} and a title that is by far the longest block of this page</h1><p>same text {'of it ' * 20}</p></main></body>") for i in range(12)]
    got = texts(spark, rows)
    assert [got[i].text for i in range(12)] == [f"Story {i} of {i * i} and what came of it {i}" for i in range(12)]
    assert [got[12 + i].text for i in range(12)] == [f"Of old One article that many pages hold same {i // 2}" for i in range(12)]
    assert all("same text" in got[24 + i].text for i in range(12))


def test_tree_equals_counting_by_hand(spark):
    import math

    rows = [(i, f"http://{'ab'[i % 2]}.org/{i}", f"<article><h1>T{i % 3}</h1><p>P{i} is long</p><p>x</p></article><div>{i % 4}</div>") for i in range(14)]
    got = {(r.host, r.path): (r.pages, round(r.importance, 9))
           for r in op.style_tree(op._parsed(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()}
    want = {}
    for host in "ab":
        for path, texts_of in [("/article/h1", lambda i: [f"T{i % 3}"]), ("/article/p", lambda i: [f"P{i}", "x"]), ("/div", lambda i: [str(i % 4)])]:
            ks = {}
            own = [i for i in range(14) if "ab"[i % 2] == host]
            for t in (t for i in own for t in texts_of(i)):
                ks[t] = ks.get(t, 0) + 1
            m = len(own)
            want[f"{host}.org", path] = (m, round(sum(k * (1 - math.log(k) / math.log(m)) for k in ks.values()) / sum(ks.values()), 9))
    assert got == want


def test_story_beside_a_teaser(spark):
    got = texts(spark, [("http://a.org/1", "<body><article><p>Teaser</p></article><div><p>" + "The story goes on. " * 9 + "</p></div></body>"),
                        ("http://b.org/1", "<body><article><p>The article itself</p></article><div>and a line</div></body>")])
    assert got[0].text == "Teaser " + ("The story goes on. " * 9).strip() and got[1].text == "The article itself"
