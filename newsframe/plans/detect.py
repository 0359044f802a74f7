"""Q1/Q2: the detect API.

``detect(pages, mode="article")`` extracts every page (F20) and reports the
pages that produced no article in an ``error`` column instead of dropping
them silently; ``mode="source"`` learns the section templates of the given
sites (E8) after validating their URLs (U1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.functions.stopwords import has_stop_words
from newsframe.functions.urls import link_hash, site_root, url_valid
from newsframe.operators.dom import page_trees
from newsframe.operators.sections import source_detect
from newsframe.operators.tokens import raw_meta_lang
from newsframe.plans.article import ARTICLE_COLUMNS, extract_trees

ENGINES = ("rule",)
# Fixed value: the reference's configured default language. Spark ships no
# stop-word list for it, so body scoring then needs ``stop_words=...``.
DEFAULT_LANGUAGE = "vi"


def detect_article(pages: DataFrame, language: str | None = DEFAULT_LANGUAGE,
                   stop_words: list[str] | None = None) -> DataFrame:
    """Q1: one row per input page: the article fields, or an ``error``
    (``bad_url``, ``language``, ``unparsed``, or ``no_stop_words``: the fields are
    there, but without a list for the language the body cannot be found)."""
    scored = bool(stop_words) or has_stop_words(language or "en")
    # pages that are not to be parsed go through the parser empty: no join brings them back
    passed = url_valid("url") & (F.lit(True) if language is None else raw_meta_lang("html").contains(language))
    src = pages.select("page_id", "url", url_valid("url").alias("_valid"), F.coalesce(passed, F.lit(False)).alias("_passed"), "html")
    src = src.withColumn("html", F.when(F.col("_passed"), F.col("html")))
    trees = page_trees(src).withColumn("_read", F.size("nodes") > 0)
    art = extract_trees(trees, language or "en", stop_words, with_body=scored, keep_empty=True).withColumn("link_hash", link_hash("url"))
    is_parsed = F.col("_read") & (F.col("title_path") != "")
    error = (F.when(~F.col("_valid"), F.lit("bad_url"))
             .when(~F.col("_passed"), F.lit("language"))
             .when(~is_parsed, F.lit("unparsed")))
    if not scored:
        error = F.coalesce(error, F.lit("no_stop_words"))
    cols = [c for c in ARTICLE_COLUMNS if c not in ("page_id", "url", "is_parsed")]
    return art.select("page_id", "url", *[F.when(F.col("_read"), F.col(c)).alias(c) for c in cols],
                      is_parsed.alias("is_parsed"), error.alias("error"))


def detect_source(targets: DataFrame, pages: DataFrame, sampling: int = 1,
                  language: str | None = DEFAULT_LANGUAGE,
                  stop_words: list[str] | None = None) -> DataFrame:
    """Q2: templates of the target sites; a bad target URL gives no result.
    A language without a stop-word list needs ``stop_words`` (else an error).

    ``targets(url)`` lists sites; ``pages`` are the known pages (the crawl),
    restricted to those sites by a semi-join on the site root.
    """
    sites = targets.filter(url_valid("url")).select(site_root("url").alias("site")).distinct()
    known = pages.withColumn("site", site_root("url")).join(sites, "site", "left_semi").drop("site")
    return source_detect(known, sampling, language, stop_words)


def detect(pages: DataFrame, mode: str = "article", engine: str = "rule",
           targets: DataFrame | None = None, **kw) -> DataFrame:
    """Dispatch on mode; ``engine`` names the extraction engine (only
    ``rule`` exists: the reference's other engine names have no code)."""
    if engine not in ENGINES:
        raise ValueError(f"unknown engine {engine!r}; available: {ENGINES}")
    if mode == "article":
        return detect_article(pages, **kw)
    if mode == "source":
        if targets is None:
            from newsframe.sources import targets_from_pages
            targets = targets_from_pages(pages)
        return detect_source(targets, pages, **kw)
    raise ValueError(f"unknown mode {mode!r}")
