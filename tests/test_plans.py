"""Plan-shape guards: the properties the design relies on at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import SF, pages_df


@pytest.fixture
def static_plans(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_page_plans_have_no_shuffle_join_or_cache(spark, static_plans, monkeypatch):
    from newsframe.operators import body as B
    from newsframe.operators import dom as D
    from newsframe.operators import fields as FL
    from newsframe.plans.article import article_extract
    from newsframe.plans.detect import detect
    from newsframe.sources import load_pages, news_pages
    monkeypatch.setattr(D, "SPLIT_BYTES", 0)  # as for an input that fills every core
    pages = news_pages(load_pages(spark, f"{SF}/pages.parquet"))
    trees = D.page_trees(pages)
    plans = {
        "title_select": FL.flat_fields(FL.page_facts(trees)).select("page_id", "title_path", "title"),
        "authors": FL.authors(trees), "meta": FL.meta_map(trees), "body": B.body_text(trees), "videos": FL.video_sources(trees),
        "cleaned": D.clean_doc(trees, unwrap_inline=True), "article": article_extract(pages, "en"), "detect": detect(pages, mode="article", language="en"),
    }
    for name, df in plans.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("Exchange", "Join", "Aggregate", "Window", "InMemoryTableScan", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)
        assert plan.count("MapInArrow") == (3 if name == "cleaned" else 1), name


def test_path_rows_score_each_page_once(spark):
    from newsframe.operators import body as B
    from newsframe.operators import dom as D
    from newsframe.operators.sections import select_path
    text = "it is the one that was in all of the news"
    pages = pages_df(spark, [f"<html><body><div><p>{text}</p><p>b {text}</p></div></body></html>", "<html><body><p>none</p></body></html>"])
    out = select_path(B.with_body(D.page_trees(pages), text=False), F.col("text_path"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(lower(") == 1  # the stop words of each block
    assert [tuple(r) for r in out.collect()] == [(0, "/html/body/div//text()", text, f"{text}\nb {text}\n")]


def test_block_scores_search_no_list_of_blocks(spark):
    from newsframe.operators import body as B
    from newsframe.operators import dom as D
    trees = D.page_trees(pages_df(spark, ["<html><body><div>" + "<p>it is the one</p>" * 3 + "<hr><p>it is the one</p><p>it is the one</p></div></body></html>"]))
    out = B.block_scores(trees)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains" not in plan and "array_position" not in plan  # each passes over a page's blocks, for each of them
    assert [(r.i, r.boostable, r.boost) for r in out.collect()] == [(0, False, 0.0), (1, True, 50.0), (2, True, 25.0), (3, False, 0.0), (4, True, 50 / 3)]


def test_hot_section_ships_k_rows_per_task(spark):
    from newsframe.operators.sections import section_sample
    urls = [f"http://hot.example/en/{i}" for i in range(300)] + ["http://cold.example/fr/1"]
    pages = pages_df(spark, ["<html></html>"] * len(urls), urls).repartition(6)
    s = section_sample(pages, 3)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = sorted((r.key, r.rank, r.page_id) for r in s.collect())
    assert got == [("cold.example/fr", 1, 300), ("hot.example/en", 1, 0), ("hot.example/en", 2, 1),
                   ("hot.example/en", 3, 2)]


def test_hot_content_clone_flags(spark):
    from newsframe.operators.items import clone_flags
    df = spark.range(0, 5000).select(F.col("id").alias("doc_id"),
                                     F.when(F.col("id") % 3 == 0, F.lit("same text"))
                                     .otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    out = clone_flags(df.repartition(8), "text", "doc_id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    flags = {r.doc_id: r.aflag for r in out.collect()}
    assert flags[0] == 0 and flags[3] == 1 and flags[1] == 0
    assert sum(flags.values()) == len(range(0, 5000, 3)) - 1
