"""Targets as messages, and articles from links."""

import json

from conftest import pages_df
from newsframe.operators import dom as D
from newsframe.operators import sections as SE
from newsframe.streaming.targets import ANSWER, TARGET_SCHEMA, answers, target_stream

OK = "<html lang='en'><head><title>T{0}</title></head><body><article><p>the and of it</p></article></body></html>"


def _site(spark):
    urls = ["http://a.b/x/1", "https://a.b/x/2", "http://a.b/y/1", "http://c.d/x/1"]
    return pages_df(spark, [OK.format(i) for i in range(3)] + ["<html lang='fr'><head><title>t</title></head></html>"], urls)


def _write(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(dict(zip(("message_id", "url", "is_article", "sent"), r, strict=True))) + "\n" for r in rows))


def _read(spark, sink):
    return sorted((json.loads(r.value) for r in spark.read.text(sink).collect()), key=lambda m: m["message_id"])


def test_answers(spark):
    rows = [("1", "http://a.b/x/1", True), ("2", "http://a.b/x/1", True), ("3", "http://c.d/x/1", True), ("4", "http://a.b/none", True), ("5", "a.b", True),
            ("6", "http://a.b", False), ("7", "http://c.d", None), ("8", "zz", False), ("9", None, True), (None, "http://a.b/y/1", True)]
    got = answers(spark.createDataFrame(rows, "message_id string, url string, is_article boolean"), _site(spark), "en", 1)
    assert got.columns == ANSWER
    got = {r.message_id: r for r in got.collect()}
    assert len(got) == len(rows)
    assert {k: r.error for k, r in got.items()} == {"1": None, "2": None, "3": "language", "4": "no_page", "5": "bad_url", "6": None, "7": "no_template", "8": "bad_url", "9": "bad_url", None: None}
    assert got["1"].article.title_path == "/html/head/title" and got["1"].article.title == "T0" and got["3"].article is None
    # a host's templates do not depend on what else is asked for: both schemes feed them
    assert [t.key for t in got["6"].templates] == ["a.b/x", "a.b/y"]
    none = answers(spark.createDataFrame([], "message_id string, url string, is_article boolean"), _site(spark), "en", 1)
    assert none.count() == 0


def test_a_restarted_stream_answers_each_message_once(spark, tmp_path):
    box, sink, ckpt = tmp_path / "in", f"file://{tmp_path}/out", f"file://{tmp_path}/ckpt"

    def serve():
        target_stream(spark, f"file://{box}", _site(spark), sink, "en", 1, checkpoint=ckpt, delay="1 hour", max_files=1).awaitTermination()
        return _read(spark, sink)
    first = [("m1", "http://a.b/x/1", True, "2024-01-01T00:00:00Z"), ("m2", "http://a.b", False, "2024-01-01T00:01:00Z"), ("m1", "http://a.b/x/1", True, "2024-01-01T00:00:30Z")]
    _write(box, "a.json", first)
    got = serve()
    assert [m["message_id"] for m in got] == ["m1", "m2"]
    assert got[0]["article"]["title"] == "T0" and len(got[1]["templates"]) == 2
    # m1 comes again, m3 is new; what was answered stays
    _write(box, "b.json", [("m1", "http://a.b/x/1", True, "2024-01-01T00:10:00Z"), ("m3", "http://a.b/y/1", True, "2024-01-01T00:11:00Z")])
    again = serve()
    assert [m["message_id"] for m in again] == ["m1", "m2", "m3"] and again[:2] == got
    assert serve() == again


def test_schema_names_the_message_fields():
    assert [f.split()[0] for f in TARGET_SCHEMA.split(", ")] == ["message_id", "url", "is_article", "sent"]


def test_links_resolve_and_unresolved_ones_count(spark):
    front = "<html lang='en'><body><a href='/x/9'>gone</a><a href='/x/2'>two</a><a href='http://a.b/x/1#f'>no</a><a href='/x/2'>again</a><a href='//e.f/'>far</a></body></html>"
    pages = pages_df(spark, [front, OK.format(1), OK.format(2), front], ["http://a.b/x/0", "http://a.b/x/1", "http://a.b/x/2", "http://a.b/y/0"])
    found = SE.resolved_articles(SE.linked_articles(D.page_trees(pages)), pages)
    got = sorted((r.section_url, r.url, r.page_id) for r in found.collect())
    assert got == [(s, u, p) for s in ("http://a.b/x", "http://a.b/y") for u, p in (("http://a.b/x/2", 2), ("http://a.b/x/9", None), ("http://e.f/", None))]
    # the list of a key is that of all sections, in section order; an article listed twice counts twice
    sample = SE.section_sample(pages, 3, found)
    assert sorted((r.rank, r.url, r.page_id) for r in sample.collect() if r.key == "a.b/x") == [(1, "http://a.b/x/9", None), (2, "http://a.b/x/2", 2), (3, "http://a.b/x/9", None)]
    assert SE.source_detect(pages, 1, "en", linked=True).count() == 0  # the first link leads to no page
    learned = SE.source_detect(pages, 2, "en", linked=True).collect()
    assert [(r.key, r.page_id) for r in learned] == [("a.b/x", 2)]


def test_one_url_linked_from_every_section(spark):
    n = 400
    pages = pages_df(spark, ["<body><a href='http://hub.x/p'>hub</a></body>"] * n + ["<p>hub</p>"], [f"http://h{i}.x/s/1" for i in range(n)] + ["http://hub.x/p"])
    links = SE.linked_articles(D.page_trees(pages))
    out = SE.resolved_articles(links, pages)
    assert out.count() == n and out.filter(f"page_id = {n}").count() == n
    # the look-up sees at most one row for each salt
    assert links.selectExpr("url", f"pmod(xxhash64(section_url), {SE.SALTS}) s").distinct().count() <= SE.SALTS
