"""A1/A2 sources and A3/A5 sinks."""

import json
import os
import tempfile

from conftest import SF


def test_load_targets_strips_lines(spark):
    from newsframe.sources import load_targets
    d = tempfile.mkdtemp(prefix="nf-targets-")
    p = os.path.join(d, "targets")
    with open(p, "w") as f:
        f.write("  http://monre.gov.vn/wps/portal/Trangchu \n\nhttp://foo.bar\n")
    got = [r.url for r in load_targets(spark, p).collect()]
    assert got == ["http://monre.gov.vn/wps/portal/Trangchu", "http://foo.bar"]


def test_load_html_files(spark):
    from newsframe.sources import load_html_files
    d = tempfile.mkdtemp(prefix="nf-html-")
    for i in range(3):
        with open(os.path.join(d, f"p{i}.html"), "w") as f:
            f.write(f"<html lang='en'><head><title>T{i}</title></head>\n<body></body></html>")
    df = load_html_files(spark, os.path.join(d, "*.html"))
    rows = df.collect()
    assert len(rows) == 3 and len({r.page_id for r in rows}) == 3
    assert all(r.html.startswith("<html") and "\n" in r.html for r in rows)


def test_targets_from_pages(spark):
    from newsframe.sources import load_pages, targets_from_pages
    t = targets_from_pages(load_pages(spark, f"{SF}/pages.parquet")).collect()
    assert t and all(r.url.startswith("http") and r.url.count("/") == 2 for r in t)


def test_item_sinks(spark):
    from newsframe.operators.items import items_json, news_items, write_items, write_messages
    from newsframe.plans.article import article_extract
    from newsframe.sources import load_pages
    items = news_items(article_extract(load_pages(spark, f"{SF}/pages.parquet"), "en"))
    d = tempfile.mkdtemp(prefix="nf-sink-")
    write_items(items, os.path.join(d, "items"))
    assert os.path.isdir(os.path.join(d, "items", "language=en"))
    back = spark.read.parquet(os.path.join(d, "items"))
    assert back.count() == items.count()
    write_messages(items_json(items), os.path.join(d, "msgs"))
    lines = [r.value for r in spark.read.text(os.path.join(d, "msgs")).collect()]
    msg = json.loads(lines[0])
    assert len(lines) == items.count() and len(msg) == 13 and "url_page" in msg
