"""U1-U7 and E1-E6 on the reference's source fixtures."""

import random

from pyspark.sql import functions as F

from conftest import pages_df
from newsframe.functions import urls as U
from newsframe.operators import dom as D
from newsframe.operators import sections as SE


def test_url_valid_and_parts(spark):
    df = spark.createDataFrame([("foobar",), ("http://foo.bar",), (None,), ("ftp://x",)], "url string")
    got = [r.v for r in df.select(U.url_valid("url").alias("v")).collect()]
    assert got == [False, True, False, False]
    r = spark.createDataFrame([("http://Foo.bar:8080/a/b?q=1#f",)], "url string").select(
        U.url_scheme("url").alias("s"), U.url_netloc("url").alias("n"), U.url_path("url").alias("p"),
        U.section_key("url").alias("k"), U.article_key("url", True).alias("a")).first()
    assert (r.s, r.n, r.p, r.k, r.a) == ("http", "Foo.bar:8080", "/a/b", "Foo.bar:8080/a/b", "Foo.bar:8080/a")


def test_article_key_empty_path(spark):
    r = spark.createDataFrame([("http://foo.bar",)], "url string").select(
        U.article_key("url", True).alias("a"), U.article_key("url", False).alias("b")).first()
    assert r.a is None and r.b == "foo.bar"


def test_url_resolve(spark):
    df = spark.createDataFrame([("fake_url1", "http://foo.bar"), ("/x", "https://a.b/c/d"),
                                ("//cdn.x/y", "https://a.b/"), ("http://o.p/q", "http://a.b")],
                               "href string, base string")
    got = [r.u for r in df.select(U.url_resolve("href", "base").alias("u")).collect()]
    assert got == ["http://foo.bar/fake_url1", "https://a.b/x", "https:////cdn.x/y"[0:6] + "//cdn.x/y",
                   "http://o.p/q"]


def _pages(spark, urls, title=True):
    t = "<title>t</title>" if title else ""
    html = [f"<html lang='en'><head>{t}</head><body><article><p>the and of</p></article></body></html>"
            for _ in urls]
    return pages_df(spark, html, urls)


def test_two_sections_one_article_each(spark):
    pages = _pages(spark, ["http://foo.bar/fake_url1", "http://foo.bar/fake_url2"])
    s = SE.section_sample(pages, 1).collect()
    groups = {r.key: [r.url] for r in s}
    assert groups == {"foo.bar/fake_url1": ["http://foo.bar/fake_url1"],
                      "foo.bar/fake_url2": ["http://foo.bar/fake_url2"]}


def test_sections_sharing_a_key_both_contribute(spark):
    pages = _pages(spark, ["http://foo.bar/x/1", "https://foo.bar/x/2", "http://foo.bar/x/3"])
    s = SE.section_sample(pages, 1).collect()
    assert sorted((r.section_url, r.url) for r in s) == [
        ("http://foo.bar/x", "http://foo.bar/x/1"), ("https://foo.bar/x", "http://foo.bar/x/1")]


def test_no_parsed_article_no_template(spark):
    pages = _pages(spark, ["http://foo.bar/fake_url1", "http://foo.bar/fake_url2"], title=False)
    assert SE.source_detect(pages, 1, "en").count() == 0


def test_apply_template_unindexed_step(spark):
    sample = "<html lang='en'><head><title>T1</title></head><body><p>the and of</p><p>the and of</p></body></html>"
    other = "<html><head><title>T2</title></head><body><p>one</p><p>two</p><p>three</p></body></html>"
    pages = pages_df(spark, [sample, other], ["http://s.x/a/1", "http://s.x/a/2"])
    tmpl = spark.createDataFrame([("s.x/a", 0, "/html/head/title", "/html/body//text()", None,
                                   "")], "key string, page_id long, title_path string, text_path string, "
                                         "author_path string, date_path string")
    out = SE.apply_template(pages, tmpl).collect()
    assert len(out) == 1
    row = out[0]
    assert row.title == "T2" and row.text == "one\ntwo\nthree\n" and row.author is None
    steps = spark.range(1).select(SE.path_steps(F.lit("/html/body/p[2]//text()")).alias("p")).first().p
    assert [tuple(s) for s in steps] == [(0, "html", None), (1, "body", None), (2, "p", 2)]


def test_paths_against_a_plain_walk(spark):
    html = ("<html><head><meta property='og:title' content='T'></head><body><div><p>a<b>b</b></p><p>c</p></div><div><p>d</p><div><p>e</p></div></div>tail</body></html>")
    t = D.page_trees(pages_df(spark, [html]))
    want = {
        "/html/body/div/p//text()": ("a", "a\nb\nc\nd\n"), "/html/body/div[2]/p//text()": ("d", "d\n"), "/html/body/div/p[2]": ("c", None),
        "/html/body/div[2]/div/p": ("e", None), '//meta[@property="og:title"]/@content': ("T", None), "/html/body/div": ("a b c", None),
        "/html/body//text()": ("a", "a\nb\nc\nd\ne\ntail\n"), "/html/head/meta/@missing": (None, None)}
    for path, expected in want.items():
        r = SE.select_path(t, F.lit(path)).collect()
        assert [(x.first_value, x.all_text) for x in r] == [expected], path
    assert SE.select_path(t, F.lit("/html/body/div[3]/p")).count() == 0


def test_path_matches_equal_a_walk_down_random_trees(spark):
    rnd = random.Random(5)

    def markup(depth):
        if depth == 0 or rnd.random() < 0.2:
            return rnd.choice(["t", "x y", ""])
        tag = rnd.choice(["div", "p", "b"])
        return f"<{tag}>{''.join(markup(depth - 1) for _ in range(rnd.randint(0, 4)))}</{tag}>" + rnd.choice(["", "tail"])
    trees = D.page_trees(pages_df(spark, ["".join(markup(rnd.randint(1, 5)) for _ in range(rnd.randint(0, 3))) for _ in range(60)]))
    steps = [[(rnd.choice(["div", "p", "b"]), rnd.choice([None, None, 1, 2])) for _ in range(rnd.randint(1, 4))] for _ in range(30)]
    paths = ["".join(f"/{tag}" if k is None else f"/{tag}[{k}]" for tag, k in s) for s in steps]
    given = spark.createDataFrame(list(enumerate(paths)), "k int, path string")
    some = 0
    for r in trees.crossJoin(given).select("k", "nodes", SE.matched(F.col("path")).alias("found")).collect():
        kept = [-1]
        for depth, (tag, k) in enumerate(steps[r.k]):
            kept = [n.id for n in r.nodes if (n.depth, n.tag) == (depth, tag) and k in (None, n.tag_pos) and n.parent in kept]
        assert [n.id for n in r.found] == kept, paths[r.k]
        some += len(kept)
    assert some > 100


def test_long_path_down_a_deep_page(spark):
    deep = 3000
    trees = D.page_trees(pages_df(spark, ["<div>" * deep + "<p>a</p><p>b</p>" + "</div>" * deep]))
    assert [tuple(r) for r in SE.select_path(trees, F.lit("/div" * deep + "/p//text()")).select("first_value", "all_text").collect()] == [("a", "a\nb\n")]
    assert SE.select_path(trees, F.lit("/div" * (deep - 1) + "/p")).count() == 0
