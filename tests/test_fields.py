"""F1-F15 rule choice and paths on small documents."""

from conftest import pages_df
from newsframe.operators import dom as D
from newsframe.operators import fields as FL


def _flat(spark, *docs):
    n = D.page_trees(pages_df(spark, list(docs)))
    return {r.page_id: r for r in FL.flat_fields(FL.page_facts(n)).collect()}, n


def _page(title=None, h1=None, og=None, head="", body=""):
    t = f"<title>{title}</title>" if title is not None else ""
    o = f'<meta property="og:title" content="{og}">' if og is not None else ""
    h = f"<h1>{h1}</h1>" if h1 is not None else ""
    return f"<html><head>{t}{o}{head}</head><body>{h}{body}</body></html>"


def test_title_rules(spark):
    r, _ = _flat(spark,
                 _page("fake_title", "fake_title"),
                 _page("fake_title", "fake_h1", "fake_h1"),
                 _page("fake_title_big", "fake_title_b", "fake_title"),
                 _page("fake_title_big", "fake_h1", "fake_title"),
                 _page(None, "x"))
    assert r[0].title_path == "/html/head/title"
    assert r[1].title_path == "/html/body/h1"
    assert r[2].title_path == "/html/body/h1"
    assert r[3].title_path == '//meta[@property="og:title"]/@content'
    assert r[4].title_path == ""


def test_og_attribute_existence_decides(spark):
    head = '<meta name="og:title" content="named">'
    r, _ = _flat(spark, "<html><head><title>t</title><meta property='og:title' content=''>"
                 + head + "</head></html>")
    assert r[0].og_title == "" and r[0].og_path.startswith("//meta[@property")


def test_authors(spark):
    doc = _page("t", body='<div class="author">By: Foo Bar, Far Boo</div>')
    meta = _page("t", head='<meta name="author" content="fake_text">')
    n = D.page_trees(pages_df(spark, [doc, meta]))
    rows = {r.page_id: r for r in FL.authors(n).collect()}
    assert rows[0].author_paths == ["/html/body/div"]
    assert rows[0].authors == ["Foo Bar", "Far Boo"]
    assert 1 not in rows


def test_byline_names(spark):
    from pyspark.sql import functions as F
    from newsframe.functions.text import byline_names
    df = spark.createDataFrame([("By: Foo Bar, Far Boo",), ("From Ana Lopez and Kim Lee",),
                                ("fake_text",), ("Zoë Ng and 2 Al",), ("by Solo",)], "t string")
    got = [r.n for r in df.select(byline_names(F.col("t")).alias("n")).collect()]
    assert got == [["Foo Bar", "Far Boo"], ["Ana Lopez", "Kim Lee"], [], ["Zoë Ng"], []]


def test_meta_lang(spark):
    r, _ = _flat(spark, '<html lang="Fake_Lang"><head></head></html>',
                 '<html><head><meta http-equiv="content-language" content="Fake_Lang"></head></html>',
                 "<html><head></head></html>")
    assert (r[0].meta_lang, r[0].lang_path) == ("fake_lang", "/html/@lang")
    assert (r[1].meta_lang, r[1].lang_path) == ("fake_lang", "/html/head/meta/@content")
    assert (r[2].meta_lang, r[2].lang_path) == ("", "")


def test_favicon_meta_canonical(spark):
    head = ('<link rel="apple-touch-icon" href="/a.png"><link rel="canonical" href="">'
            '<meta property="og:url" content="http://x/y"><meta name="description" content="d">')
    r, _ = _flat(spark, _page("t", head=head), _page("t"))
    assert r[0].favicon_path == "/html/head/link[1]/@href" and r[0].favicon == "/a.png"
    assert r[0].canonical_path == "/html/head/meta[1]/@content" and r[0].canonical_link == "http://x/y"
    assert r[0].description_path == "/html/head/meta[2]/@content"
    assert (r[1].favicon_path, r[1].canonical_path, r[1].description_path) == ("", "", "")


def test_tags_tiers(spark):
    one = _page("t", body='<a rel="tag" href="/x">x</a><a href="/tag/y">y</a>')
    two = _page("t", body='<a href="/tag/y">y</a><a href="/z">z</a>')
    none = _page("t", body='<a href="/z">z</a>')
    r, _ = _flat(spark, one, two, none, "<html></html>")
    assert r[0].tag_paths == ["/html/body/a[1]"]
    assert r[1].tag_paths == ["/html/body/a[1]"] and r[1].tags == ["y"]
    assert r[2].tag_paths == [] and r[3].tag_paths == []


def test_meta_map(spark):
    head = '<meta name="farboo" content="x"><meta name="farboo:bar" value="y"><meta property="a:b:c" content="z">'
    _, n = _flat(spark, _page("t", head=head))
    m = FL.meta_map(n).first().meta_map
    assert m["farboo"] == {"farboo": "/html/head/meta[1]", "bar": "/html/head/meta[2]/@value"}
    assert m["a"] == {}


def test_publish_date_probes(spark):
    first = _page("t", head='<meta property="rnews:datePublished" content="2017-03-25">')
    blank_then = _page("t", head='<meta property="article:modified_time" content="">'
                                 '<meta property="article:modified_time" content="2020-01-01">'
                                 '<meta name="PublishDate" content="2019-05-05">')
    blank = _page("t", head='<meta property="rnews:datePublished" content="">')
    r, _ = _flat(spark, first, blank_then, blank)
    assert r[0].date_path == "/html/head/meta/@content" and r[0].publish_date == "2017-03-25"
    # a probe is decided by its first element only: the blank one falls through
    assert r[1].date_path == "/html/head/meta[3]/@content" and r[1].publish_date == "2019-05-05"
    assert r[2].date_path == ""


def test_links_and_video(spark):
    doc = _page("t", body='<a href="http://www.example.com">fake_text</a><a href="#top">x</a>'
                          '<a href="/b"><i>i</i>tail</a><video data-src="fake_attr"></video>')
    _, n = _flat(spark, doc)
    links = sorted((r.href, r.link_text) for r in FL.page_links(n).collect())
    assert links == [("/b", None), ("http://www.example.com", "fake_text")]
    assert FL.video_sources(n).first().videos == ["fake_attr"]


def test_folded_meta_map_equals_standalone(spark):
    from conftest import SF
    from newsframe.sources import load_pages, news_pages
    n = D.page_trees(news_pages(load_pages(spark, f"{SF}/pages.parquet")))
    folded = {r.page_id: r.meta_map for r in FL.flat_fields(FL.page_facts(n)).collect()}
    alone = {r.page_id: r.meta_map for r in FL.meta_map(n).collect()}
    assert alone and all(folded[k] == v for k, v in alone.items())
    head = ('<meta name="farboo" content="x"><meta name="farboo:bar" value="y">'
            '<meta property="farboo:baz" content="z"><meta name="solo:x:y" content="w">')
    _, n2 = _flat(spark, _page("t", head=head))
    f2 = FL.flat_fields(FL.page_facts(n2)).first().meta_map
    assert f2 == FL.meta_map(n2).first().meta_map
    assert f2["farboo"]["baz"] == "/html/head/meta[3]/@content" and f2["solo"] == {}


def test_ten_thousand_author_hits_on_a_page(spark):
    import time
    body = "".join(f'<a rel="author" class="byline">By Ann Lee{"x" * (k % 7)}, Bob {"CDEFGHIJ"[k % 8]}</a>' for k in range(5000))
    began = time.time()
    r, _ = _flat(spark, _page("t", body=body))
    assert len(r[0].author_paths) == 56 and r[0].author_paths[0] == "/html/body/a[1]" and time.time() - began < 90


def test_meta_updates_against_a_plain_fold(spark):
    import random
    rng = random.Random(6)

    def fold(metas):
        data = {}
        for k, (key, kind) in enumerate(metas, 1):
            path = f"/html/head/meta[{k}]" if len(metas) > 1 else "/html/head/meta"
            parts = key.split(":")
            if len(parts) == 1:
                data[key] = path
                continue
            at = data.setdefault(parts[0], {})
            if isinstance(at, str):
                at = data[parts[0]] = {parts[0]: at}
            if len(parts) == 2:
                at[parts[1]] = f"{path}/@{kind}"
        return {k: {"": v} if isinstance(v, str) else v for k, v in data.items()}
    pages = [[(rng.choice(["a", "b", "a:x", "a:y", "a:a", "b:x", "b:x:y", "c:x:y", "a:"]), rng.choice(["content", "value"])) for _ in range(rng.randint(1, 9))] for _ in range(120)]
    r, t = _flat(spark, *[_page(None, head="".join(f'<meta name="{k}" {kind}="v">' for k, kind in metas)) for metas in pages])
    assert [r[i].meta_map for i in range(len(pages))] == [fold(m) for m in pages]
    assert {x.page_id: x.meta_map for x in FL.meta_map(t).collect()} == {i: fold(m) for i, m in enumerate(pages)}
