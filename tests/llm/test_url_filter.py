from pyspark.sql import functions as F

from flightlake.llm.url_filter import url_filter


def judged(spark, rows, **kw):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    return {r.page_id: r for r in url_filter(df, **kw).collect()}


def canon(u):
    return f'<html><head><link href="{u}" rel="canonical"></head>'


def test_rules_direct(spark):
    got = judged(spark, [
        ("http://a.example.com/en/x", ""), ("http://www.example.com/en/1", ""), ("http://EXAMPLE.com/en/", None),
        ("http://a.net/es/1?x#y", ""), ("http://net/fr/", ""), ("http://a.org/en/", ""), ("http://a.net/en/", ""),
        (None, None), ("no scheme", ""), ("://", ""), ("http://b.example.com/EN/", ""), ("http://examplecom/", "")])
    assert [got[i].rule for i in range(12)] == [
        "example.com/en/", "www.example.com/en/", "example.com/en/", "net/es/", "net/fr/", None, None,
        None, None, None, "com/", None]
    assert [got[i].verdict for i in range(7)] == ["block", "allow", "block", "block", "block", "allow", "allow"]
    assert (got[2].host, got[2].path) == ("example.com", "/en/") and (got[7].host, got[7].path) == ("", "")


def test_aliases_take_block_and_allow_wins(spark):
    got = judged(spark, [
        ("http://a.org/1", canon("http://b.org/2")),
        ("http://b.org/2", "<meta http-equiv='Refresh' content=\"0; url=http://c.net/fr/x\">"),
        ("http://c.net/fr/x", ""),
        ("http://d.org/1", canon("/2")), ("http://d.org/2", canon("http://c.net/es/q")),
        ("http://d.org/3", canon("http://d.org/1") + canon("http://z.com/1")),
        ("http://e.org/1", "<!-- " + canon("http://c.net/fr/x") + " --><script>" + canon("http://c.net/fr/x") + "</script>"),
        ("http://a.org/1#frag", None)])
    assert [got[i].verdict for i in range(8)] == ["block", "block", "block", "allow", "allow", "allow", "allow", "block"]
    assert got[0].rule is None


def test_hub_and_chain(spark):
    rows = [(f"http://h{i}.org/", canon("http://hub.org/")) for i in range(100)]
    rows += [(f"http://s.org/{i}", canon(f"/{i + 1}")) for i in range(12)]
    rows += [("http://hub.org/", canon("http://x.net/fr/")), ("http://s.org/12", canon("http://x.net/es/"))]
    got = judged(spark, rows)
    assert {r.verdict for r in got.values()} == {"block"}


def test_logged_redirects_repeats_and_empty(spark):
    log = spark.createDataFrame([("http://a.org/", "http://x.net/fr/"), (None, "http://q.org/")], "source string, target string")
    got = judged(spark, [("http://a.org/", None), ("http://a.org/", ""), ("http://q.org/", "")], redirects=log)
    assert [got[i].verdict for i in range(3)] == ["block", "block", "allow"]
    empty = spark.createDataFrame([], "page_id long, url string, html string, host int, rule int, node int")
    assert url_filter(empty).count() == 0
    clash = spark.createDataFrame([(1, "http://a.net/fr/", None, 3, 4)], "page_id long, url string, html string, host int, verdict int")
    assert url_filter(clash).first().verdict == "block"
    assert url_filter(clash.withColumn("component", F.lit(1))).columns == ["page_id", "host", "path", "rule", "verdict"]
