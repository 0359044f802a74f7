"""A3-A6 items, Q1 errors and Q3 stream = batch."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF, pages_df


def test_clone_flags(spark):
    from newsframe.operators.items import clone_flags
    df = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "c")], "id long, t string")
    got = sorted((r.id, r.aflag) for r in clone_flags(df, "t", "id").collect())
    assert got == [(1, 0), (2, 1), (3, 0)]


def test_detect_errors(spark):
    from newsframe.plans.detect import detect
    ok = "<html lang='en'><head><title>t</title></head><body><p>x</p></body></html>"
    fr = "<html lang='fr'><head><title>t</title></head></html>"
    pages = pages_df(spark, [ok, fr, ok], ["http://a.b/x/1", "http://a.b/x/2", "foobar"])
    got = {r.page_id: r.error for r in detect(pages, mode="article", language="en").collect()}
    assert got == {0: None, 1: "language", 2: "bad_url"}


def test_unknown_engine(spark):
    import pytest
    from newsframe.plans.detect import detect
    with pytest.raises(ValueError):
        detect(pages_df(spark, ["<html></html>"]), engine="d-tree")


def test_items_and_rejects(spark):
    from newsframe.operators.items import items_rejected, news_items
    from newsframe.plans.article import article_extract
    from newsframe.sources import load_pages, news_pages
    art = article_extract(news_pages(load_pages(spark, f"{SF}/pages.parquet")), "en")
    items = news_items(art)
    assert items.count() == art.count()
    rej = items_rejected(items)
    assert rej.filter(F.size("reasons") == 0).count() == 0


def test_stream_equals_batch(spark):
    from newsframe.plans.article import article_extract
    from newsframe.sources import load_pages
    from newsframe.streaming.detect import detect_stream
    base = tempfile.mkdtemp(prefix="nf-stream-")
    q = detect_stream(spark, SF, os.path.join(base, "sink"), "en",
                      checkpoint=os.path.join(base, "ckpt"), file_glob="pages.parquet")
    q.awaitTermination()
    stream = spark.read.parquet(os.path.join(base, "sink")).select("page_id", "title_path", "text_path")
    batch = article_extract(load_pages(spark, f"{SF}/pages.parquet"), "en") \
        .select("page_id", "title_path", "text_path")
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_registered_streams_read_a_folder_of_part_files(spark):
    import __spark_entry__
    base = tempfile.mkdtemp(prefix="nf-parts-")
    html = "<html lang='en'><head><title>t</title></head><body><article><h1>t</h1><p>one two three</p></article></body></html>"
    pages = pages_df(spark, [html] * 24, [f"http://a{i % 2}.b/x{i % 4}/{i}" for i in range(24)])
    pages.repartition(3).write.parquet(os.path.join(base, "pages.parquet"))
    found = __spark_entry__.queries()
    for stream, batch in (("detect_stream", "article_extract"), ("template_stream", "apply_template")):
        a, b = found[stream](spark, base), found[batch](spark, base)
        assert a.count() > 0, stream
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, stream


def test_article_extract_independent_of_input_partitioning(spark):
    from newsframe.plans.article import article_extract
    from newsframe.sources import load_pages, news_pages
    pages = news_pages(load_pages(spark, f"{SF}/pages.parquet"))
    cols = ["page_id", "title_path", "title", "author_paths", "canonical_path", "date_path",
            "text_path", "text", "tag_paths", "videos"]
    a = article_extract(pages, "en").select(*cols)
    b = article_extract(pages.repartition(5, "url").sortWithinPartitions(F.rand(7)), "en").select(*cols)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
