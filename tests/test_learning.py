"""Templates learned on a stream of pages: equal to the batch plan over all pages, in any order of files."""

import itertools

from pyspark.sql import functions as F

from newsframe.operators.sections import source_detect
from newsframe.streaming.learning import STATE_SCHEMA, changed_templates, first_articles, learned_templates, learning_stream

SCHEMA = "page_id long, url string, html string"
#: Parses; its title path tells the page kinds apart.
TITLE = "<html lang='en'><head><title>T{0}</title></head><body><article><p>the and of it</p></article></body></html>"
HEAD = "<html lang='en'><body><article><h1>A head line {0}</h1><p>the and of it</p></article></body></html>"
FRENCH = "<html lang='fr'><head><title>t</title></head></html>"

PAGES = [(1, "http://a.b/x/1", FRENCH), (2, "http://a.b/x/2", HEAD.format(2)), (3, "https://a.b/x/3", TITLE.format(3)), (4, "http://a.b/y/1", TITLE.format(4)),
         (5, "http://a.b", HEAD.format(5)), (6, "http://a.b/x/2", TITLE.format(6)), (7, "http://c.d/z/1", FRENCH), (8, "http://c.d/z/2", TITLE.format(8)),
         (9, "no url", TITLE.format(9)), (10, None, TITLE.format(10)), (None, "http://a.b/n/1", TITLE.format(11)), (12, "http://a.b/m/1", None), (13, "http://a.b/m/2", TITLE.format(13))]
FIELDS = ["key", "page_id", "title_path", "text_path", "author_path", "date_path"]


def _rows(df):
    return sorted((tuple(r) for r in df.select(*FIELDS).collect()), key=str)


def _learn(spark, tmp_path, parts, sampling):
    box, sink, ckpt = (f"file://{tmp_path}/{d}" for d in ("in", "out", "ckpt"))
    for part in parts:  # each part arrives, then the stream is started again where it was
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(box)
        learning_stream(spark, box, sink, "en", sampling, checkpoint=ckpt).awaitTermination()
    return sink


def test_any_order_of_files_gives_the_batch_templates(spark, tmp_path):
    known = spark.createDataFrame([p for p in PAGES if p[0] is not None], SCHEMA)
    want = {k: _rows(source_detect(known, k, "en")) for k in (1, 2)}
    assert want[1] and want[1] != want[2]  # with one sample, sections whose first page does not parse have no template
    orders = [[PAGES[8:], PAGES[4:8], PAGES[:4]], [PAGES[1::2], PAGES[::2]]]
    for n, (parts, k) in enumerate(itertools.product(orders, (1, 2))):
        sink = _learn(spark, tmp_path / str(n), parts, k)
        assert _rows(learned_templates(spark, sink)) == want[k], (n, k)
        state = spark.read.schema(STATE_SCHEMA).parquet(f"{sink}/state/batch_id={len(parts) - 1}")
        assert state.groupBy("section_url").count().agg(F.max("count")).first()[0] <= k


def test_a_template_is_taken_back_when_an_earlier_page_takes_its_sample(spark, tmp_path):
    parts = [[(5, "http://a.b/x/5", TITLE.format(5))], [(9, "http://a.b/x/9", TITLE.format(9))], [(1, "http://a.b/x/1", FRENCH)]]
    sink = _learn(spark, tmp_path, parts, 1)
    assert _rows(learned_templates(spark, sink)) == []
    changes = spark.read.parquet(f"{sink}/templates").select("batch_id", "key", "page_id").collect()
    assert sorted((r.batch_id, r.key, r.page_id) for r in changes) == [(0, "a.b/x", 5), (2, "a.b/x", None)]
    assert not (tmp_path / "out" / "state" / "batch_id=0").exists()  # only what a replay could need is kept


def test_a_replayed_batch_overwrites_its_own_output(spark, tmp_path):
    sink = _learn(spark, tmp_path, [PAGES[:6], PAGES[6:]], 2)
    before = _rows(learned_templates(spark, sink))
    (tmp_path / "ckpt" / "commits" / "1").unlink()  # as if the driver was lost between the sink and the commit
    crc = tmp_path / "ckpt" / "commits" / ".1.crc"
    if crc.exists():
        crc.unlink()
    learning_stream(spark, f"file://{tmp_path}/in", sink, "en", 2, checkpoint=f"file://{tmp_path}/ckpt").awaitTermination()
    assert _rows(learned_templates(spark, sink)) == before


def test_first_articles_and_changes(spark):
    rows = [("http://a.b/x", f"http://a.b/x/{i % 5}", i) for i in range(100)]
    got = first_articles(spark.createDataFrame(rows, "section_url string, url string, page_id long"), 3)
    assert sorted(r.page_id for r in got.collect()) == [0, 1, 2]
    schema = "key string, page_id long, title_path string, text_path string, author_path string, date_path string"
    old = spark.createDataFrame([("a", 1, "t", None, None, None), ("b", 1, "t", None, None, None), ("c", 1, "t", None, None, None)], schema)
    new = spark.createDataFrame([("a", 1, "t", None, None, None), ("b", 2, "t", None, None, None), ("d", 1, "t", None, None, None)], schema)
    assert sorted((r.key, r.page_id) for r in changed_templates(old, new).collect()) == [("b", 2), ("c", None), ("d", 1)]
    assert changed_templates(old, old).count() == 0
