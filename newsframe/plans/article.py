"""F20 article_extract: the whole article row of every page.

Plan shape: pages -> native language gate (F7, before parsing because
Catalyst cannot push a filter through the Python parser) -> C0 page trees -> projections. A
page's row holds all that any field reads, so there is no shuffle, no join and no cache.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.functions.urls import link_hash
from newsframe.operators.body import with_body as add_body
from newsframe.operators.dom import page_trees
from newsframe.operators.fields import flat_fields, page_facts, videos_in
from newsframe.operators.tokens import language_gate

ARTICLE_COLUMNS = [
    "page_id", "url", "link_hash", "meta_lang", "lang_path", "title_path", "title",
    "author_paths", "authors", "favicon_path", "favicon", "description_path", "description",
    "keywords_path", "keywords", "canonical_path", "canonical_link", "tag_paths", "tags",
    "meta_map", "date_path", "publish_date", "text_path", "text", "videos", "is_parsed",
]


def extract_trees(trees: DataFrame, language: str = "en", stop_words: list[str] | None = None,
                  with_body: bool = True, with_meta: bool = True, with_text: bool = True, keep_empty: bool = False) -> DataFrame:
    """All fields of F20 from page trees (one row per page with elements, or per page), with the columns the trees carry.

    ``with_body`` scores blocks for the body path (F16-F18); ``with_text``
    also reads the body text and videos under it (F19, F15); ``with_meta``
    folds the meta map (F12). Template learning needs only the paths.
    """
    nothing = F.lit(None).cast("string")
    body = add_body(trees, language, stop_words, with_text) if with_body else trees.withColumn("text_path", nothing)
    body = body.withColumn("videos", videos_in("top") if with_body and with_text else F.lit(None).cast("array<string>"))
    if not (with_body and with_text):
        body = body.withColumn("text", nothing)
    out = flat_fields(page_facts(body.drop("scores", "top", "top_score"), keep_empty))
    return out if with_meta else out.withColumn("meta_map", F.lit(None).cast("map<string,map<string,string>>"))


def article_extract(pages: DataFrame, language: str | None = "en",
                    stop_words: list[str] | None = None, with_body: bool = True,
                    with_meta: bool = True, with_text: bool = True) -> DataFrame:
    """F20 over ``pages(page_id, url, html)``.

    Pages failing the language gate are not parsed and produce no row (the
    reference leaves them unparsed). ``language=None`` disables the gate;
    body scoring then uses English stop words.
    """
    gated = language_gate(pages, language)
    trees = page_trees(gated.select("page_id", "url", "html"))
    fields = extract_trees(trees, language or "en", stop_words, with_body, with_meta, with_text)
    return fields.select(
        *[c for c in ARTICLE_COLUMNS if c not in ("link_hash", "is_parsed")],
        link_hash("url").alias("link_hash"), (F.col("title_path") != "").alias("is_parsed")).select(*ARTICLE_COLUMNS)
