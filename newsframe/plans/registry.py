"""Registered queries (one per operator of the inventory) and their oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` and returns a DataFrame. Queries on fields run over the enriched
pages (``news_pages``: the plain pages carry no og/author/date markup), all of them;
only F7 and what contains it (F20, E, Q, items) keep the English ones. Column names match the
oracle SQL; arrays are rendered as ``|``-joined strings so both engines hash
the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsframe.functions import urls as U
from newsframe.functions.entities import REF_RE
from newsframe.operators import body as B
from newsframe.operators import dom as D
from newsframe.operators import fields as FL
from newsframe.operators import tokens as TK
from newsframe.plans import sqlparts as S
from newsframe.sources import (linked_pages, linked_pages_sql, load_pages, news_pages, reference_pages, reference_pages_sql,
                               table, table_files, targets_from_pages)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

LANG = "en"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _pages(spark, sf) -> DataFrame:
    return load_pages(spark, f"{sf}/pages.parquet")


def _news(spark, sf) -> DataFrame:
    return news_pages(_pages(spark, sf))


def _trees(spark, sf, news=True, keep_html=False) -> DataFrame:
    src = _news(spark, sf) if news else _pages(spark, sf)
    return D.page_trees(src.select("page_id", "html"), keep_html)


def _join(col) -> F.Column:
    return F.array_join(col, "|")


# ----------------------------------------------------------------------
# A: sources
# ----------------------------------------------------------------------

@register("load_targets", """
SELECT DISTINCT regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*)://', 1) || '://' ||
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) AS url
FROM pages WHERE contains(url, '://') AND starts_with(url, 'http')""")
def q_load_targets(spark, sf):
    return targets_from_pages(_pages(spark, sf))


@register("load_pages", "SELECT page_id, url, html FROM pages")
def q_load_pages(spark, sf):
    return _pages(spark, sf)


# ----------------------------------------------------------------------
# U: URLs
# ----------------------------------------------------------------------

_LINKS_SQL = ("lk AS (SELECT page_id, url, unnest(generate_series(0, len(h) - 1)) AS pos, unnest(h) AS href "
              "FROM (SELECT page_id, url, regexp_extract_all(html, '<a [^>]*href=\"([^\"]*)\"', 1) AS h FROM pages))")


def _raw_links(spark, sf) -> DataFrame:
    return _pages(spark, sf).select(
        "page_id", "url",
        F.posexplode(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), F.lit(1)))
        .alias("pos", "href"))


@register("url_valid", f"""
WITH {_LINKS_SQL}
SELECT page_id, CAST(-1 AS INTEGER) AS pos, url AS candidate,
       coalesce(contains(url, '://') AND starts_with(url, 'http'), false) AS is_valid FROM pages
UNION ALL
SELECT page_id, CAST(pos AS INTEGER) AS pos, href AS candidate,
       coalesce(contains(href, '://') AND starts_with(href, 'http'), false) AS is_valid FROM lk""")
def q_url_valid(spark, sf):
    pages = _pages(spark, sf).select("page_id", F.lit(-1).alias("pos"), F.col("url").alias("candidate"))
    links = _raw_links(spark, sf).select("page_id", "pos", F.col("href").alias("candidate"))
    both = pages.unionByName(links)
    return both.select("page_id", "pos", "candidate", U.url_valid("candidate").alias("is_valid"))


_SCHEME = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*)://', 1)"
_NETLOC = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1)"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)"
_SEG = f"CASE WHEN {_PATH} = '' THEN NULL ELSE split_part({_PATH}, '/', 2) END"


@register("url_parts", f"""
SELECT page_id, url, {_SCHEME} AS scheme, {_NETLOC} AS netloc, {_PATH} AS path,
       {_SEG} AS first_segment FROM pages""")
def q_url_parts(spark, sf):
    p = _pages(spark, sf)
    return p.select("page_id", "url", U.url_scheme("url").alias("scheme"),
                    U.url_netloc("url").alias("netloc"), U.url_path("url").alias("path"),
                    U.first_segment(U.url_path("url")).alias("first_segment"))


def _section_url(col: str = "url") -> F.Column:
    seg = U.first_segment(U.url_path(col))
    return F.when(seg.isNull(), U.site_root(col)).otherwise(
        F.concat(U.site_root(col), F.lit("/"), seg))


_SECTION_URL_SQL = (f"CASE WHEN {_SEG} IS NULL THEN {_SCHEME} || '://' || {_NETLOC} "
                    f"ELSE {_SCHEME} || '://' || {_NETLOC} || '/' || {_SEG} END")


@register("section_key", f"""
SELECT DISTINCT {_SECTION_URL_SQL} AS section_url,
  regexp_extract({_SECTION_URL_SQL}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) ||
  regexp_extract({_SECTION_URL_SQL}, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) AS section_key
FROM pages""")
def q_section_key(spark, sf):
    s = _pages(spark, sf).select(_section_url("url").alias("section_url")).distinct()
    return s.select("section_url", U.section_key("section_url").alias("section_key"))


@register("article_key", f"""
SELECT page_id, url, {_NETLOC} AS site_key,
  CASE WHEN {_SEG} IS NULL THEN NULL ELSE {_NETLOC} || '/' || {_SEG} END AS section_match_key
FROM pages""")
def q_article_key(spark, sf):
    p = _pages(spark, sf)
    return p.select("page_id", "url", U.article_key("url", False).alias("site_key"),
                    U.article_key("url", True).alias("section_match_key"))


@register("url_resolve", f"""
WITH {_LINKS_SQL}
SELECT page_id, CAST(pos AS INTEGER) AS pos, href,
  CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN href
       WHEN starts_with(href, '//') THEN {_SCHEME} || ':' || href
       WHEN starts_with(href, '/') THEN {_SCHEME} || '://' || {_NETLOC} || href
       ELSE {_SCHEME} || '://' || {_NETLOC} || '/' || href END AS abs_url
FROM lk""")
def q_url_resolve(spark, sf):
    lk = _raw_links(spark, sf)
    return lk.select("page_id", "pos", "href", U.url_resolve("href", "url").alias("abs_url"))


@register("link_filter", f"""
WITH {_LINKS_SQL}
SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM lk
WHERE href <> '' AND NOT contains(href, '#')""")
def q_link_filter(spark, sf):
    return _raw_links(spark, sf).filter(U.link_keep("href")).select("page_id", "pos", "href")


@register("link_hash", "SELECT page_id, url, md5(url) AS link_hash FROM pages")
def q_link_hash(spark, sf):
    return _pages(spark, sf).select("page_id", "url", U.link_hash("url").alias("link_hash"))


# ----------------------------------------------------------------------
# B: native token scans
# ----------------------------------------------------------------------

@register("html_tokens", f"""
WITH {S.TOKENS_CTE}
SELECT page_id, CAST(pos AS INTEGER) AS pos, token, {S.KIND_SQL} AS kind,
       lower(regexp_extract(token, '^</?([A-Za-z][A-Za-z0-9-]*)', 1)) AS tag FROM tk""")
def q_html_tokens(spark, sf):
    return TK.html_tokens(_pages(spark, sf))


@register("entity_decode", f"""
WITH {S.TOKENS_CTE}
SELECT page_id, CAST(pos AS INTEGER) AS pos, {S.ent('token')} AS text FROM tk
WHERE {S.KIND_SQL} = 'text' AND contains(token, '&')""")
def q_entity_decode(spark, sf):
    t = TK.html_tokens(_pages(spark, sf)).filter(F.col("token").contains("&"))
    return TK.decoded_text(t)


@register("attribute_values", f"""
WITH rp AS ({reference_pages_sql("pages")}), {S.TOKENS_CTE.replace("FROM pages", "FROM rp")},
     st AS (SELECT page_id, pos, lower(regexp_extract(token, '^<([A-Za-z][A-Za-z0-9-]*)', 1)) AS tag,
                   regexp_replace(token, {S.q(TK.TAG_HEAD_RE)}, '') AS x FROM tk WHERE {S.KIND_SQL} = 'start'),
     al AS (SELECT page_id, pos, tag, {", ".join(f"regexp_extract_all(x, {S.q(TK.ATTRIBUTE_RE)}, {k}) AS g{k}" for k in range(1, 5))} FROM st),
     av AS (SELECT page_id, pos, tag, unnest(generate_series(0, len(g1) - 1)) AS attr_pos, unnest(g1) AS name,
                   unnest(list_transform(generate_series(1, len(g1)), lambda i: concat(g2[i], g3[i], g4[i]))) AS raw FROM al),
     rf AS (SELECT *, regexp_extract_all(raw, {S.q(REF_RE)}, 0) AS refs, string_split_regex(raw, {S.q(REF_RE)}) AS gaps FROM av)
SELECT page_id, CAST(pos AS INTEGER) AS pos, CAST(attr_pos AS INTEGER) AS attr_pos, tag, lower(name) AS name,
       gaps[1] || coalesce(array_to_string(list_transform(generate_series(1, len(refs)), lambda i: {S.reference('refs[i]')} || gaps[i + 1]), ''), '') AS value
FROM rf""")
def q_attribute_values(spark, sf):
    """B1: the attributes of all start tags, in pages whose article tag carries references of every kind."""
    return TK.attributes(TK.html_tokens(reference_pages(_pages(spark, sf))))


@register("comments", f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, trim(c) AS comment FROM (
  SELECT page_id, unnest(generate_series(0, len(cs) - 1)) AS pos, unnest(cs) AS c FROM (
    SELECT page_id, regexp_extract_all(regexp_replace(html, {S.q(TK.RAW_BLOCK_RE)}, '', 'g'),
                                       {S.q(TK.COMMENT_RE)}, 1) AS cs FROM pages))""")
def q_comments(spark, sf):
    return TK.comments(_pages(spark, sf))


# ----------------------------------------------------------------------
# F6/F7 language
# ----------------------------------------------------------------------

@register("meta_lang", f"SELECT page_id, {S.root_lang()} AS meta_lang FROM pages")
def q_meta_lang(spark, sf):
    return _pages(spark, sf).select("page_id", TK.raw_meta_lang("html").alias("meta_lang"))


@register("language_gate", f"SELECT page_id, url FROM pages WHERE contains({S.root_lang()}, 'en')")
def q_language_gate(spark, sf):
    return TK.language_gate(_pages(spark, sf), LANG).select("page_id", "url")


@register("meta_lang_nodes", f"""
SELECT page_id, {S.root_lang()} AS meta_lang, '/html/@lang' AS lang_path FROM pages""")
def q_meta_lang_nodes(spark, sf):
    return FL.flat_fields(FL.page_facts(_trees(spark, sf, news=False))).select("page_id", "meta_lang", "lang_path")


# ----------------------------------------------------------------------
# C: DOM
# ----------------------------------------------------------------------

_BLANKED = ("regexp_replace(regexp_replace(html, " + S.q(TK.RAW_BLOCK_RE) + ", '<rawblock>', 'g'), "
            + S.q(TK.COMMENT_RE) + ", '', 'g')")


@register("dom_tag_counts", f"""
WITH b AS (SELECT regexp_replace(regexp_replace(html, '<(script|style)[^>]*>[\\s\\S]*?</(script|style)>', '<\\1>', 'g'),
                                 {S.q(TK.COMMENT_RE)}, '', 'g') AS h FROM pages),
     t AS (SELECT lower(unnest(regexp_extract_all(h, '<([A-Za-z][A-Za-z0-9-]*)', 1))) AS tag FROM b)
SELECT tag, count(*) AS n FROM t GROUP BY tag""")
def q_dom_tag_counts(spark, sf):
    tags = _trees(spark, sf, news=False).select(F.explode(F.transform("nodes", lambda n: n["tag"])).alias("tag"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


_SIMPLE_TEXT_TAGS = ["title", "h1", "a", "footer"]


@register("node_text", " UNION ALL ".join(
    f"""SELECT page_id, '{t}' AS tag, CAST(ord AS INTEGER) AS ord, {S.squash(S.ent('x'))} AS node_text FROM (
      SELECT page_id, unnest(generate_series(1, len(xs))) AS ord, unnest(xs) AS x FROM (
        SELECT page_id, regexp_extract_all(html, '<{t}\\b[^>]*>([^<]*)</{t}>', 1) AS xs FROM pages))"""
    for t in _SIMPLE_TEXT_TAGS))
def q_node_text(spark, sf):
    tg = D.node_rows(_trees(spark, sf, news=False), lambda n: n["tag"].isin(_SIMPLE_TEXT_TAGS), text=True)
    w = Window.partitionBy("page_id", "tag").orderBy("node_id")
    return tg.select("page_id", "tag", F.row_number().over(w).alias("ord"), "node_text")


@register("find_by_tag", """
SELECT page_id, href, ltext AS link_text FROM (
  SELECT page_id, unnest(hs) AS href, unnest(ts) AS ltext FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1) AS hs,
                    regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS ts FROM pages))
WHERE regexp_matches(href, '(?i)^/th')""")
def q_find_by_tag(spark, sf):
    hits = D.find_by_tag(_trees(spark, sf, news=False), "a", "href", "^/th")
    return hits.select("page_id", F.col("attrs")["href"].alias("href"), F.col("text").alias("link_text"))


# css_select: meta[property="og:url"] in the enriched pages; path index = metas before it + 1
_OGURL_POS = "strpos(html, '<meta property=\"og:url\"')"


@register("css_select", f"""
WITH np AS ({S.NEWS})
SELECT page_id, '/html/head/meta[' || CAST({S.count_before('html', '<meta', _OGURL_POS)} + 1 AS VARCHAR) || ']' AS path,
       regexp_extract(html, '<meta property="og:url" content="([^"]*)"', 1) AS content
FROM np WHERE {_OGURL_POS} > 0""")
def q_css_select(spark, sf):
    hit = D.css_select(_trees(spark, sf), "meta", "property", "og:url", "=")
    return hit.select("page_id", F.col("xpath").alias("path"), F.col("attrs")["content"].alias("content"))


@register("node_parent", """
WITH nv AS (SELECT page_id, regexp_extract(html, '<nav>([\\s\\S]*?)</nav>', 1) AS nav FROM pages),
     a AS (SELECT page_id, len(regexp_extract_all(nav, '<li>', 0)) AS n_li,
                  unnest(generate_series(1, len(regexp_extract_all(nav, '<li>', 0)))) AS k,
                  unnest(regexp_extract_all(nav, '<li><a href="([^"]*)"', 1)) AS href FROM nv)
SELECT page_id, href, 'li' AS parent_tag,
       '/html/body/nav/ul/li' || CASE WHEN n_li > 1 THEN '[' || CAST(k AS VARCHAR) || ']' ELSE '' END AS parent_path,
       '/html/body/nav/ul' || CASE WHEN n_li > 1 THEN '/li[' || CAST(k AS VARCHAR) || ']' ELSE '/li' END AS cut_path
FROM a""")
def q_node_parent(spark, sf):
    par = D.node_parent(_trees(spark, sf, news=False), lambda n: n["tag"] == "a").filter(F.col("xpath").startswith("/html/body/nav/"))
    return par.select("page_id", F.col("attrs")["href"].alias("href"), "parent_tag", "parent_xpath",
                      D.parent_path(F.concat("xpath", F.lit("/@href"))).alias("cut_path")) \
        .withColumnRenamed("parent_xpath", "parent_path")


_ARTICLE_INNER = "regexp_extract(html, '<article>([\\s\\S]*?)</article>', 1)"


@register("node_children", f"""
WITH a AS (SELECT page_id, len(regexp_extract_all({_ARTICLE_INNER}, '<p>', 0)) AS n_p FROM pages)
SELECT page_id, CAST(1 AS INTEGER) AS sib_pos, 'h1' AS tag FROM a
UNION ALL
SELECT page_id, CAST(k + 1 AS INTEGER) AS sib_pos, 'p' AS tag FROM (SELECT page_id, unnest(generate_series(1, n_p)) AS k FROM a)""")
def q_node_children(spark, sf):
    trees = _trees(spark, sf, news=False)
    kids = D.node_rows(trees, lambda n: F.get("nodes", n["parent"])["tag"] == "article")
    return kids.select("page_id", "sib_pos", "tag")


@register("text_runs", f"""
WITH b AS (SELECT page_id, unnest(generate_series(1, len(xs))) AS ord, unnest(xs) AS x FROM (
  SELECT page_id, regexp_extract_all(html, '<b>([^<]*)<br>', 1) AS xs FROM pages))
SELECT page_id, CAST(ord AS INTEGER) AS b_ord, CAST(0 AS INTEGER) AS run_pos, 'text' AS kind, {S.ent('x')} AS run_text FROM b WHERE x <> ''
UNION ALL
SELECT page_id, CAST(ord AS INTEGER) AS b_ord, CAST(1 AS INTEGER) AS run_pos, 'br' AS kind, '' AS run_text FROM b""")
def q_text_runs(spark, sf):
    trees = _trees(spark, sf, news=False)
    bs = D.node_rows(trees, lambda n: n["tag"] == "b").select(
        "page_id", F.col("node_id").alias("parent_id"),
        F.row_number().over(Window.partitionBy("page_id").orderBy("node_id")).alias("b_ord"))
    runs = D.text_runs(trees).join(bs, ["page_id", "parent_id"])
    return runs.select("page_id", "b_ord", "run_pos", "kind", "run_text")


@register("prev_sibling", f"""
WITH a AS (SELECT page_id, len(regexp_extract_all({_ARTICLE_INNER}, '<p>', 0)) AS n_p FROM pages)
SELECT page_id, CAST(k AS INTEGER) AS p_ord, CASE WHEN k = 1 THEN 'h1' ELSE 'p' END AS prev_tag
FROM (SELECT page_id, unnest(generate_series(1, n_p)) AS k FROM a)""")
def q_prev_sibling(spark, sf):
    ps = D.prev_sibling(_trees(spark, sf, news=False), lambda n: (n["tag"] == "p") & (F.get("nodes", n["parent"])["tag"] == "article"))
    w = Window.partitionBy("page_id").orderBy("node_id")
    return ps.select("page_id", F.row_number().over(w).alias("p_ord"), "prev_tag")


@register("drop_subtree", f"""
SELECT page_id, {S.squash(S.ent("regexp_replace(" + _ARTICLE_INNER + ", '<[^>]*>', ' ', 'g')"))} AS body_text FROM pages""")
def q_drop_subtree(spark, sf):
    kept = D.drop_subtree(_trees(spark, sf, news=False), lambda n: n["tag"].isin("nav", "footer", "div"))
    return D.node_rows(kept, lambda n: n["tag"] == "body", text=True).select("page_id", F.col("node_text").alias("body_text"))


@register("clean_doc", f"""
WITH b AS (SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
             '<nav>[\\s\\S]*?</nav>', '', 'g'), '<footer>[\\s\\S]*?</footer>', '', 'g'),
             '<div class="ad">[^<]*</div>', '', 'g'), {S.q(TK.RAW_BLOCK_RE)}, '', 'g'), {S.q(TK.COMMENT_RE)}, '', 'g') AS h
           FROM pages),
     t AS (SELECT lower(unnest(regexp_extract_all(h, '<([A-Za-z][A-Za-z0-9-]*)', 1))) AS tag FROM b)
SELECT tag, count(*) AS n FROM t GROUP BY tag""")
def q_clean_doc(spark, sf):
    cleaned = D.clean_doc(_trees(spark, sf, news=False))
    return cleaned.select(F.explode(F.transform("nodes", lambda n: n["tag"])).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@register("node_html", """
SELECT page_id, regexp_extract(html, '<article>[\\s\\S]*?</article>', 0) AS node_html
FROM pages WHERE contains(html, '<article>')""")
def q_node_html(spark, sf):
    """The source markup of each page's article element."""
    return D.node_html(_trees(spark, sf, news=False, keep_html=True), lambda n: n["tag"] == "article").select("page_id", "node_html")


@register("drop_tag")
def q_drop_tag(spark, sf):
    """Unwrap inline ``b`` elements; their children move to the parent."""
    out = D.node_rows(D.drop_tag(_trees(spark, sf, news=False), lambda n: n["tag"] == "b"))
    return out.select("page_id", "node_id", "parent_id", "sib_pos", "tag", "text", "tail")


@register("unwrapped_paragraphs", f"""
SELECT page_id, CAST(k AS INTEGER) AS p_ord, {S.ent("regexp_replace(x, '</?(b|i|em|strong|span|br)( [^>]*)?>', '', 'g')")} AS text FROM (
  SELECT page_id, unnest(generate_series(1, len(xs))) AS k, unnest(xs) AS x FROM (
    SELECT page_id, regexp_extract_all({_ARTICLE_INNER}, '<p>((?:[^<]|<[^p/]|</[^p])*)', 1) AS xs FROM pages))""")
def q_unwrapped_paragraphs(spark, sf):
    """C12 with all inline tags: the own text of each article paragraph, which then holds all of theirs."""
    out = D.drop_tag(_trees(spark, sf, news=False), lambda n: n["tag"].isin(D.CLEAN_UNWRAP_TAGS))
    ps = D.node_rows(out, lambda n: n["tag"] == "p", path=True).filter(F.col("xpath").startswith("/html/body/article/p"))
    w = Window.partitionBy("page_id").orderBy("node_id")
    return ps.select("page_id", F.row_number().over(w).alias("p_ord"), "text")


@register("xpath_select", S.field_ctes(gate=False) + """
SELECT page_id, text_path AS path,
  """ + S.ent("list_filter(string_split_regex(regexp_extract(html, '<article>([\\s\\S]*?)</article>', 1), '<[^>]*>'), lambda x: x <> '')[1]") + """ AS first_value,
  f19.text AS all_text
FROM f18 JOIN f19 USING (page_id) JOIN en USING (page_id)""")
def q_xpath_select(spark, sf):
    """C4: evaluate one expression per page, the body path of F18."""
    from newsframe.operators.sections import select_path
    return select_path(B.with_body(_trees(spark, sf), LANG, text=False), F.col("text_path"))


# ----------------------------------------------------------------------
# F: field extraction on all enriched pages (body queries count English stop words)
# ----------------------------------------------------------------------

_FC = S.field_ctes()  # pages passing the language gate
_ALL = S.field_ctes(gate=False)


def _flat(spark, sf) -> DataFrame:
    return FL.flat_fields(FL.page_facts(_trees(spark, sf)))


@register("title_select", _ALL + "\nSELECT page_id, title_path, title FROM f1v")
def q_title_select(spark, sf):
    return _flat(spark, sf).select("page_id", "title_path", "title")


@register("longest_h1", _ALL + "\nSELECT page_id, '/html/body/article/h1' AS h1_path, h AS h1_text FROM f1 WHERE has_h1")
def q_longest_h1(spark, sf):
    return _flat(spark, sf).filter(F.col("h1_path").isNotNull()).select("page_id", "h1_path", "h1_text")


@register("og_title", _ALL + "\nSELECT page_id, g AS og_title, og_path FROM f1")
def q_og_title(spark, sf):
    return _flat(spark, sf).select("page_id", "og_title", "og_path")


@register("authors", _ALL + "\nSELECT page_id, author_paths, authors FROM f4")
def q_authors(spark, sf):
    a = FL.authors(_trees(spark, sf))
    return a.select("page_id", _join("author_paths").alias("author_paths"), _join("authors").alias("authors"))


@register("byline_names", _ALL + """
SELECT page_id, path, text, array_to_string(names, '|') AS names FROM (
  SELECT DISTINCT page_id, path, text, names FROM an)""")
def q_byline_names(spark, sf):
    from newsframe.functions.text import byline_names
    c = FL.author_candidates(_trees(spark, sf)).filter(F.coalesce(F.col("text"), F.lit("")) != "")
    return c.select("page_id", "path", "text", _join(byline_names("text")).alias("names")).distinct()


@register("favicon", _ALL + """
SELECT en.page_id, coalesce(fav.path || '/@href', '') AS favicon_path, coalesce(fav.href, '') AS favicon
FROM en LEFT JOIN fav USING (page_id)""")
def q_favicon(spark, sf):
    return _flat(spark, sf).select("page_id", "favicon_path", "favicon")


@register("meta_content", _ALL + """
SELECT en.page_id, coalesce(d.path, '') AS description_path, coalesce(d.content, '') AS description,
       coalesce(kw.path, '') AS keywords_path, coalesce(kw.content, '') AS keywords
FROM en LEFT JOIN m_description d USING (page_id) LEFT JOIN m_keywords kw USING (page_id)""")
def q_meta_content(spark, sf):
    return _flat(spark, sf).select("page_id", "description_path", "description", "keywords_path", "keywords")


@register("canonical_link", _ALL + """
SELECT en.page_id,
  CASE WHEN coalesce(can.href, '') <> '' THEN can.path || '/@href'
       WHEN coalesce(ogu.content, '') <> '' THEN ogu.path || '/@content'
       WHEN coalesce(ogu.href, '') <> '' THEN ogu.path || '/@href' ELSE '' END AS canonical_path,
  CASE WHEN coalesce(can.href, '') <> '' THEN can.href
       WHEN coalesce(ogu.content, '') <> '' THEN ogu.content
       WHEN coalesce(ogu.href, '') <> '' THEN ogu.href ELSE '' END AS canonical_link
FROM en LEFT JOIN can USING (page_id) LEFT JOIN ogu USING (page_id)""")
def q_canonical_link(spark, sf):
    return _flat(spark, sf).select("page_id", "canonical_path", "canonical_link")


@register("page_tags", _ALL + """
SELECT en.page_id, coalesce(f11.tag_paths, '') AS tag_paths, coalesce(f11.tags, '') AS tags
FROM en LEFT JOIN f11 USING (page_id)""")
def q_page_tags(spark, sf):
    return _flat(spark, sf).select("page_id", _join("tag_paths").alias("tag_paths"), _join("tags").alias("tags"))


_META_LONG = """,
mv AS (SELECT page_id, k, trim(CASE WHEN prop <> '' THEN prop ELSE nm END) AS key,
        CASE WHEN content <> '' THEN '/html/head/meta[' || CAST(k AS VARCHAR) || ']/@content'
             WHEN val <> '' THEN '/html/head/meta[' || CAST(k AS VARCHAR) || ']/@value' END AS vpath
       FROM (SELECT page_id, k, regexp_extract(tag, '\\sproperty="([^"]*)"', 1) AS prop,
                    regexp_extract(tag, '\\sname="([^"]*)"', 1) AS nm,
                    regexp_extract(tag, '\\scontent="([^"]*)"', 1) AS content,
                    regexp_extract(tag, '\\svalue="([^"]*)"', 1) AS val FROM mt)),
e2 AS (SELECT page_id, k, len(string_split(key, ':')) AS np, string_split(key, ':')[1] AS head,
        CASE WHEN len(string_split(key, ':')) = 2 THEN string_split(key, ':')[2] END AS sub,
        len(string_split(key, ':')) = 1 AS plain,
        CASE WHEN len(string_split(key, ':')) = 1 THEN '/html/head/meta[' || CAST(k AS VARCHAR) || ']' ELSE vpath END AS value
       FROM mv WHERE key <> '' AND vpath IS NOT NULL),
lp AS (SELECT page_id, head, max(CASE WHEN plain THEN k END) AS last_plain FROM e2 GROUP BY page_id, head),
af AS (SELECT e2.*, lp.last_plain FROM e2 JOIN lp USING (page_id, head) WHERE NOT plain AND k > coalesce(lp.last_plain, -1)),
na AS (SELECT lp.page_id, lp.head, lp.last_plain, count(af.k) AS n_after, count(af.sub) AS n_two
       FROM lp LEFT JOIN af USING (page_id, head) GROUP BY lp.page_id, lp.head, lp.last_plain),
rowsm AS (
  SELECT na.page_id, na.head, '' AS sub, e2.value, -1 AS ord FROM na JOIN e2 ON e2.page_id = na.page_id AND e2.head = na.head AND e2.k = na.last_plain
   WHERE na.n_after = 0
  UNION ALL
  SELECT na.page_id, na.head, na.head AS sub, e2.value, -1 AS ord FROM na JOIN e2 ON e2.page_id = na.page_id AND e2.head = na.head AND e2.k = na.last_plain
   WHERE na.n_after > 0
  UNION ALL
  SELECT page_id, head, sub, value, k AS ord FROM af WHERE sub IS NOT NULL
  UNION ALL
  SELECT page_id, head, NULL AS sub, NULL AS value, -1 AS ord FROM na WHERE last_plain IS NULL AND n_two = 0)
"""


@register("meta_map", _ALL + _META_LONG + """
SELECT page_id, head, sub, arg_max(value, ord) AS value FROM rowsm GROUP BY page_id, head, sub""")
def q_meta_map(spark, sf):
    return FL.meta_rows(_trees(spark, sf))


@register("publish_date", _ALL + """
SELECT en.page_id, coalesce(f13.date_path, '') AS date_path, coalesce(f13.publish_date, '') AS publish_date
FROM en LEFT JOIN f13 USING (page_id)""")
def q_publish_date(spark, sf):
    return _flat(spark, sf).select("page_id", "date_path", "publish_date")


@register("page_links", _ALL + """
SELECT page_id, href, link_text FROM (
  SELECT page_id, """ + S.ent("unnest(hs)") + """ AS href, nullif(""" + S.ent("unnest(ts)") + """, '') AS link_text FROM (
    SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>[^<]*', 1) AS hs,
                    regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>([^<]*)', 1) AS ts FROM en))
WHERE href <> '' AND NOT contains(href, '#')""")
def q_page_links(spark, sf):
    return FL.page_links(_trees(spark, sf)).select("page_id", "href", "link_text")


# F15 under the body node of F18 (the article element)
_BODY_VIDEOS = """SELECT page_id, string_agg(src, '|' ORDER BY k) AS videos FROM (
  SELECT page_id, unnest(vs) AS src, unnest(generate_series(1, len(vs))) AS k FROM (
    SELECT page_id, regexp_extract_all(regexp_extract(html, '<article>([\\s\\S]*?)</article>', 1), '<iframe data-src="([^"]*)"', 1) AS vs
    FROM en JOIN f18 USING (page_id)))
GROUP BY page_id"""


@register("video_src", _ALL + """
SELECT page_id, string_agg(src, '|') AS videos FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<iframe data-src="([^"]*)"', 1)) AS src FROM en)
GROUP BY page_id""")
def q_video_src(spark, sf):
    v = FL.video_sources(_trees(spark, sf))
    return v.select("page_id", _join("videos").alias("videos"))


@register("body_videos", _ALL + "\n" + _BODY_VIDEOS)
def q_body_videos(spark, sf):
    """F15 restricted to each page's best node."""
    v = B.with_body(_trees(spark, sf), LANG, text=False).select("page_id", FL.videos_in("top").alias("videos"))
    return v.filter("videos IS NOT NULL").select("page_id", _join("videos").alias("videos"))


@register("text_blocks", _ALL + """
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) AS INTEGER) AS block_ord,
       CAST(stopwords AS INTEGER) AS stopwords, CAST(link_density AS DOUBLE) AS link_density FROM pk2 WHERE kept""")
def q_text_blocks(spark, sf):
    b = B.text_blocks(_trees(spark, sf), LANG)
    w = Window.partitionBy("page_id").orderBy("node_id")
    return b.select("page_id", F.row_number().over(w).alias("block_ord"),
                    F.col("stopwords").cast("int").alias("stopwords"),
                    F.col("link_density").cast("double").alias("link_density"))


@register("block_scores", _ALL + "\nSELECT page_id, i, boostable, upscore FROM f17")
def q_block_scores(spark, sf):
    return B.block_scores(_trees(spark, sf), LANG).select("page_id", F.col("i").cast("int").alias("i"), "boostable", "upscore")


@register("best_node", _ALL + "\nSELECT page_id, text_path, top_score FROM f18")
def q_best_node(spark, sf):
    return B.best_node(_trees(spark, sf), LANG).select("page_id", "text_path", F.col("top_score").cast("double").alias("top_score"))


@register("body_text", _ALL + "\nSELECT page_id, text FROM f19")
def q_body_text(spark, sf):
    return B.body_text(_trees(spark, sf), LANG)


@register("article_extract", _FC + """
SELECT en.page_id, en.url, md5(en.url) AS link_hash, 'en' AS meta_lang, f1v.title_path, f1v.title,
  coalesce(f4.author_paths, '') AS author_paths,
  coalesce(m_description.path, '') AS description_path, coalesce(m_keywords.path, '') AS keywords_path,
  coalesce(f13.date_path, '') AS date_path, coalesce(f13.publish_date, '') AS publish_date,
  coalesce(f11.tag_paths, '') AS tag_paths, f18.text_path, f1v.title_path <> '' AS is_parsed,
  coalesce(f4.authors, '') AS authors, f19.text, coalesce(fav.href, '') AS favicon,
  CASE WHEN coalesce(can.href, '') <> '' THEN can.href WHEN coalesce(ogu.content, '') <> '' THEN ogu.content
       ELSE coalesce(ogu.href, '') END AS canonical_link, bv.videos
FROM en JOIN f1v USING (page_id) LEFT JOIN f4 USING (page_id) LEFT JOIN m_description USING (page_id)
  LEFT JOIN m_keywords USING (page_id) LEFT JOIN f13 USING (page_id) LEFT JOIN f11 USING (page_id)
  LEFT JOIN f18 USING (page_id) LEFT JOIN f19 USING (page_id) LEFT JOIN fav USING (page_id)
  LEFT JOIN can USING (page_id) LEFT JOIN ogu USING (page_id) LEFT JOIN (""" + _BODY_VIDEOS + """) bv USING (page_id)""")
def q_article_extract(spark, sf):
    from newsframe.plans.article import article_extract
    return _article_projection(article_extract(_news(spark, sf), LANG))


def _article_projection(a: DataFrame) -> DataFrame:
    return a.select("page_id", "url", "link_hash", "meta_lang", "title_path", "title",
                    _join("author_paths").alias("author_paths"), "description_path", "keywords_path",
                    "date_path", "publish_date", _join("tag_paths").alias("tag_paths"), "text_path",
                    "is_parsed", F.coalesce(_join("authors"), F.lit("")).alias("authors"), "text", "favicon",
                    "canonical_link", _join("videos").alias("videos"))


# ----------------------------------------------------------------------
# E: sections and templates (enriched pages, sampling 3 as in the
# reference's functional run)
# ----------------------------------------------------------------------

SAMPLING = 3

_SEC_CTES_T = f""",
vp AS (SELECT page_id, url FROM np WHERE contains(url, '://') AND starts_with(url, 'http')),
su AS (SELECT page_id, url, {_SECTION_URL_SQL} AS section_url, {_SCHEME} || '://' || {_NETLOC} AS site,
              {_NETLOC} AS netloc, {_SEG} AS seg FROM vp),
e1 AS (SELECT site, section_url, min(page_id) AS pos FROM su GROUP BY site, section_url),
e2 AS (SELECT section_url, url, min(page_id) AS page_id FROM su GROUP BY section_url, url),
sec AS (SELECT section_url, pos AS spos,
          regexp_extract(section_url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) ||
          regexp_extract(section_url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) AS key,
          regexp_extract(section_url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) <> '' AS has_path FROM e1),
lpos AS (SELECT e2.url, min(sec.spos) AS l_spos, min(e2.page_id) AS l_apos FROM e2 JOIN sec USING (section_url) GROUP BY e2.url),
akeys AS (SELECT e2.url, e2.page_id, su.netloc AS key, false AS has_path FROM e2 JOIN su USING (page_id)
       UNION ALL
       SELECT e2.url, e2.page_id, su.netloc || '/' || su.seg AS key, true AS has_path FROM e2 JOIN su USING (page_id)
       WHERE su.seg IS NOT NULL),
e3 AS (SELECT * FROM (SELECT sec.key, sec.section_url, sec.spos, akeys.url, akeys.page_id,
          CAST(row_number() OVER (PARTITION BY sec.section_url ORDER BY lpos.l_spos, lpos.l_apos, akeys.page_id) AS INTEGER) AS rank
        FROM sec JOIN akeys ON sec.key = akeys.key AND sec.has_path = akeys.has_path JOIN lpos ON lpos.url = akeys.url)
       WHERE rank <= @SAMPLING@)"""


def _sec_ctes(sampling: int = SAMPLING) -> str:
    return _SEC_CTES_T.replace("@SAMPLING@", str(int(sampling)))


_SEC_CTES = _sec_ctes(SAMPLING)


def _e_sql(select: str) -> str:
    return S.field_ctes() + _SEC_CTES + "\n" + select


def _sections_pages(spark, sf):
    return _news(spark, sf)


@register("section_urls", _e_sql("SELECT site, section_url, pos FROM e1"))
def q_section_urls(spark, sf):
    from newsframe.operators.sections import section_urls
    return section_urls(_sections_pages(spark, sf))


@register("section_articles", _e_sql("SELECT section_url, url, page_id FROM e2"))
def q_section_articles(spark, sf):
    from newsframe.operators.sections import section_articles
    return section_articles(_sections_pages(spark, sf)).select("section_url", "url", "page_id")


@register("linked_articles", _ALL + _SEC_CTES + f"""
SELECT section_url, url, arg_min(title, pos) AS title, min(page_id) AS page_id FROM (
  SELECT l.section_url, l.title, l.page_id, l.page_id * 1000000 + l.k AS pos,
    CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN href
         WHEN starts_with(href, '//') THEN scheme || ':' || href
         WHEN starts_with(href, '/') THEN site || href ELSE site || '/' || href END AS url
  FROM (SELECT x.*, su.section_url, su.site, split_part(su.site, ':', 1) AS scheme FROM (
          SELECT page_id, unnest(generate_series(1, len(hs))) AS k, {S.ent("unnest(hs)")} AS href,
                 {S.ent("unnest(ts)")} AS title FROM (
            SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>[^<]*', 1) AS hs,
                   regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>([^<]*)', 1) AS ts FROM en)) x
        JOIN su USING (page_id) WHERE href <> '' AND NOT contains(href, '#')) l)
WHERE contains(url, '://') AND starts_with(url, 'http') GROUP BY section_url, url""")
def q_linked_articles(spark, sf):
    """E2 over the links of each section's pages; an article linked from two sections is in both."""
    from newsframe.operators.sections import linked_articles
    pages = _news(spark, sf)
    out = linked_articles(D.page_trees(pages))
    return out.select("section_url", "url", F.coalesce("title", F.lit("")).alias("title"), "page_id")


@register("section_sample", _e_sql("SELECT key, section_url, spos, url, page_id, rank FROM e3"))
def q_section_sample(spark, sf):
    from newsframe.operators.sections import section_sample
    return section_sample(_sections_pages(spark, sf), SAMPLING)


_E4_SQL = """SELECT e3.key, e3.section_url, e3.url, e3.page_id, e3.rank,
       f1v.page_id IS NOT NULL AS is_parsed, f1v.title_path
FROM e3 LEFT JOIN f1v USING (page_id)"""


@register("section_process_all", _e_sql(_E4_SQL))
def q_section_process_all(spark, sf):
    from newsframe.operators.sections import section_process_all, section_sample
    pages = _sections_pages(spark, sf)
    out = section_process_all(pages, section_sample(pages, SAMPLING), LANG)
    return out.select("key", "section_url", "url", "page_id", "rank", "is_parsed", "title_path")


_E5_CTES = """, e4 AS (""" + _E4_SQL + """),
firsts AS (SELECT * FROM (SELECT e4.*, e3.spos, row_number() OVER (PARTITION BY e4.key ORDER BY e3.spos, e4.rank) AS rn
           FROM e4 JOIN e3 USING (key, section_url, page_id, rank) WHERE is_parsed) WHERE rn = 1),
tmpl AS (SELECT firsts.key, firsts.page_id, firsts.title_path, f18.text_path,
       CASE WHEN f4.author_paths IS NULL THEN NULL ELSE split_part(f4.author_paths, '|', 1) END AS author_path,
       coalesce(f13.date_path, '') AS date_path
FROM firsts LEFT JOIN f18 USING (page_id) LEFT JOIN f4 USING (page_id) LEFT JOIN f13 USING (page_id))"""
_E5_SQL = _E5_CTES + "\nSELECT key, page_id, title_path, text_path, author_path, date_path FROM tmpl"

# E6 oracle: the template paths of the data (title, h1, og, article text,
# head meta attributes, article div) evaluated on the raw markup of every
# other valid page of the section
_ART_ANY = "regexp_extract(html, '<article>([\\s\\S]*?)</article>', 1)"
_E6_CTES = _E5_CTES + f""",
npv AS (SELECT page_id, url, html FROM np WHERE contains(url, '://') AND starts_with(url, 'http')),
tkeys AS (SELECT page_id, {_NETLOC} AS key FROM npv
          UNION SELECT page_id, {_NETLOC} || '/' || {_SEG} AS key FROM npv WHERE {_SEG} IS NOT NULL),
tg AS (SELECT tkeys.page_id, tkeys.key, tmpl.title_path, tmpl.text_path, tmpl.author_path, tmpl.date_path
       FROM tkeys JOIN tmpl ON tkeys.key = tmpl.key WHERE tkeys.page_id <> tmpl.page_id),
mta AS (SELECT page_id, unnest(generate_series(1, len(ms))) AS k, unnest(ms) AS tag
        FROM (SELECT page_id, regexp_extract_all(html, '<meta [^>]*>', 0) AS ms FROM npv)),
pv AS (SELECT page_id,
    CASE WHEN contains(html, '<title>') THEN {S.squash(S.ent("regexp_extract(html, '<title>([^<]*)</title>', 1)"))} END AS v_title,
    CASE WHEN contains({_ART_ANY}, '<h1>') THEN {S.squash(S.ent("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))} END AS v_h1,
    CASE WHEN contains(html, '<meta property="og:title" content=') THEN {S.ent("regexp_extract(html, '<meta property=" + '"og:title"' + " content=" + '"([^"]*)"' + "', 1)")} END AS v_ogp,
    CASE WHEN contains(html, '<meta name="og:title" content=') THEN {S.ent("regexp_extract(html, '<meta name=" + '"og:title"' + " content=" + '"([^"]*)"' + "', 1)")} END AS v_ogn,
    CASE WHEN regexp_matches({_ART_ANY}, '<div [^>]*>') THEN {S.squash(S.ent("regexp_extract(" + _ART_ANY + ", '<div [^>]*>([^<]*)</div>', 1)"))} END AS v_div,
    CASE WHEN contains(html, '<article>') THEN nullif(array_to_string(list_transform(list_filter(
      string_split_regex({_ART_ANY}, '<[^>]*>'), lambda x: x <> ''), lambda x: {S.ent('x')} || chr(10)), ''), '') END AS v_text
  FROM npv),
ma AS (SELECT page_id, k,
    CASE WHEN regexp_matches(tag, '\\scontent="') THEN {S.ent("regexp_extract(tag, '\\scontent=" + '"([^"]*)"' + "', 1)")} END AS a_content,
    CASE WHEN regexp_matches(tag, '\\sdatetime="') THEN {S.ent("regexp_extract(tag, '\\sdatetime=" + '"([^"]*)"' + "', 1)")} END AS a_datetime
  FROM mta),
tgk AS (SELECT tg.*,
    CASE WHEN regexp_matches(author_path, '^/html/head/meta') THEN coalesce(TRY_CAST(regexp_extract(author_path, 'meta\\[(\\d+)\\]', 1) AS INTEGER), 1) END AS k_author,
    CASE WHEN regexp_matches(date_path, '^/html/head/meta') THEN coalesce(TRY_CAST(regexp_extract(date_path, 'meta\\[(\\d+)\\]', 1) AS INTEGER), 1) END AS k_date
  FROM tg),
e6 AS (SELECT tgk.page_id, tgk.key,
    CASE tgk.title_path WHEN '/html/head/title' THEN pv.v_title WHEN '/html/body/article/h1' THEN pv.v_h1
         WHEN '//meta[@property="og:title"]/@content' THEN pv.v_ogp
         WHEN '//meta[@name="og:title"]/@content' THEN pv.v_ogn END AS title,
    CASE WHEN tgk.text_path = '/html/body/article//text()' THEN pv.v_text END AS text,
    CASE WHEN tgk.author_path = '/html/body/article/div' THEN pv.v_div
         WHEN tgk.k_author IS NOT NULL AND ends_with(tgk.author_path, '/@content') THEN ma1.a_content END AS author,
    CASE WHEN tgk.k_date IS NOT NULL AND ends_with(tgk.date_path, '/@content') THEN ma2.a_content
         WHEN tgk.k_date IS NOT NULL AND ends_with(tgk.date_path, '/@datetime') THEN ma2.a_datetime END AS publish_date
  FROM tgk JOIN pv USING (page_id)
  LEFT JOIN ma ma1 ON ma1.page_id = tgk.page_id AND ma1.k = tgk.k_author
  LEFT JOIN ma ma2 ON ma2.page_id = tgk.page_id AND ma2.k = tgk.k_date)"""


@register("section_template", S.field_ctes() + _SEC_CTES + _E5_SQL)
def q_section_template(spark, sf):
    from newsframe.operators.sections import source_detect
    return source_detect(_sections_pages(spark, sf), SAMPLING, LANG)


@register("source_detect", S.field_ctes() + _sec_ctes(1) + _E5_SQL)
def q_source_detect(spark, sf):
    """E8 with the default sampling of 1."""
    from newsframe.operators.sections import source_detect
    return source_detect(_sections_pages(spark, sf), 1, LANG)


def _applied(spark, sf):
    from newsframe.operators.sections import apply_template, source_detect
    pages = _sections_pages(spark, sf)
    return apply_template(pages, source_detect(pages, SAMPLING, LANG))


@register("apply_template", S.field_ctes() + _SEC_CTES + _E6_CTES + """
SELECT page_id, key, title, text, author, publish_date FROM e6""")
def q_apply_template(spark, sf):
    """The learned templates read the other pages of their sections."""
    return _applied(spark, sf)


@register("template_report", S.field_ctes() + _SEC_CTES + _E6_CTES + """
SELECT key, count(*) AS pages,
  count(*) FILTER (WHERE title IS NOT NULL AND text IS NOT NULL AND author IS NOT NULL AND publish_date IS NOT NULL) AS complete,
  count(*) FILTER (WHERE title IS NULL) AS missing_title, count(*) FILTER (WHERE text IS NULL) AS missing_text,
  count(*) FILTER (WHERE author IS NULL) AS missing_author,
  count(*) FILTER (WHERE publish_date IS NULL) AS missing_publish_date
FROM e6 GROUP BY key""")
def q_template_report(spark, sf):
    """Per section key, pages tried and per-field misses."""
    from newsframe.operators.sections import template_report
    return template_report(_applied(spark, sf))


# ----------------------------------------------------------------------
# E3-E7 over the articles that sections link to (pages with links between them)
# ----------------------------------------------------------------------

# the links of each section's pages, made absolute; an article's place is that of its first link
_LINKED_E2 = f""",
lkh AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS hs FROM np),
lku AS (SELECT page_id, unnest(generate_series(1, len(hs))) AS k, {S.ent("unnest(hs)")} AS href FROM lkh),
lka AS (SELECT su.section_url, lku.page_id * 1000000 + lku.k AS pos,
    CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*://') THEN href
         WHEN starts_with(href, '//') THEN split_part(su.site, ':', 1) || ':' || href
         WHEN starts_with(href, '/') THEN su.site || href ELSE su.site || '/' || href END AS url
  FROM lku JOIN su USING (page_id) WHERE href <> '' AND NOT contains(href, '#')),
le2 AS (SELECT section_url, url, min(pos) AS apos FROM lka WHERE contains(url, '://') AND starts_with(url, 'http') GROUP BY section_url, url),
le2p AS (SELECT le2.*, known.page_id FROM le2 LEFT JOIN (SELECT url, min(page_id) AS page_id FROM vp GROUP BY url) known USING (url)),
lk_ AS (SELECT le2p.*, sec.spos AS l_spos, {_NETLOC.replace('(url,', '(le2p.url,')} AS netloc, {_SEG.replace('(url,', '(le2p.url,')} AS seg
        FROM le2p JOIN sec USING (section_url)),
lkeys AS (SELECT url, page_id, l_spos, apos, netloc AS key, false AS has_path FROM lk_
          UNION ALL SELECT url, page_id, l_spos, apos, netloc || '/' || seg AS key, true AS has_path FROM lk_ WHERE seg IS NOT NULL),
e3 AS (SELECT * FROM (SELECT sec.key, sec.section_url, sec.spos, lkeys.url, lkeys.page_id,
          CAST(row_number() OVER (PARTITION BY sec.section_url ORDER BY l_spos, apos, lkeys.url) AS INTEGER) AS rank
        FROM sec JOIN lkeys ON sec.key = lkeys.key AND sec.has_path = lkeys.has_path) WHERE rank <= {SAMPLING})"""
_LINKED_CTES = (S.field_ctes() + _SEC_CTES.replace("e3 AS (", "e3_known AS (") + _LINKED_E2).replace(S.NEWS, linked_pages_sql("pages"))


def _linked_samples(spark, sf):
    from newsframe.operators.sections import linked_articles, resolved_articles, section_sample
    pages = linked_pages(_pages(spark, sf))
    return pages, section_sample(pages, SAMPLING, resolved_articles(linked_articles(D.page_trees(pages)), pages))


@register("resolved_links", _LINKED_CTES + "\nSELECT section_url, url, page_id FROM le2p")
def q_resolved_links(spark, sf):
    """The articles that sections link to with their known pages; links that lead to none are kept."""
    from newsframe.operators.sections import linked_articles, resolved_articles
    pages = linked_pages(_pages(spark, sf))
    return resolved_articles(linked_articles(D.page_trees(pages)), pages).select("section_url", "url", "page_id")


@register("linked_sample", _LINKED_CTES + "\nSELECT key, section_url, spos, url, page_id, rank FROM e3")
def q_linked_sample(spark, sf):
    """E3 over linked articles."""
    return _linked_samples(spark, sf)[1]


@register("linked_process_all", _LINKED_CTES + "\n" + _E4_SQL)
def q_linked_process_all(spark, sf):
    """E4 over linked articles: those without a known page stay listed unparsed."""
    from newsframe.operators.sections import section_process_all
    pages, samples = _linked_samples(spark, sf)
    return section_process_all(pages, samples, LANG).select("key", "section_url", "url", "page_id", "rank", "is_parsed", "title_path")


@register("linked_template", _LINKED_CTES + _E5_SQL)
def q_linked_template(spark, sf):
    """E5/E8 over linked articles."""
    from newsframe.operators.sections import source_detect
    return source_detect(linked_pages(_pages(spark, sf)), SAMPLING, LANG, linked=True)


_REPORT_SQL = """
SELECT key, count(*) AS pages,
  count(*) FILTER (WHERE title IS NOT NULL AND text IS NOT NULL AND author IS NOT NULL AND publish_date IS NOT NULL) AS complete,
  count(*) FILTER (WHERE title IS NULL) AS missing_title, count(*) FILTER (WHERE text IS NULL) AS missing_text,
  count(*) FILTER (WHERE author IS NULL) AS missing_author,
  count(*) FILTER (WHERE publish_date IS NULL) AS missing_publish_date
FROM e6 GROUP BY key"""


@register("linked_report", _LINKED_CTES + _E6_CTES.replace(S.NEWS, linked_pages_sql("pages")) + _REPORT_SQL)
def q_linked_report(spark, sf):
    """E6 and E7 with the templates learned from linked articles."""
    from newsframe.operators.sections import apply_template, source_detect, template_report
    pages = linked_pages(_pages(spark, sf))
    return template_report(apply_template(pages, source_detect(pages, SAMPLING, LANG, linked=True)))


# ----------------------------------------------------------------------
# items
# ----------------------------------------------------------------------

def _items(spark, sf):
    from newsframe.operators.items import news_items
    from newsframe.operators.sections import section_of
    from newsframe.plans.article import article_extract
    art = article_extract(_news(spark, sf), LANG, with_meta=False) \
        .withColumn("category", U.section_key(section_of("url")))
    return news_items(art, "category")


_EPOCH_SQL = ("CAST(epoch(TRY_CAST(CASE WHEN regexp_matches(d, '^\\d{4}-\\d{2}-\\d{2}$') THEN d || 'T00:00:00Z' "
              "WHEN regexp_matches(d, '(Z|[+-]\\d{2}:?\\d{2})$') THEN d ELSE d || 'Z' END AS TIMESTAMPTZ)) AS BIGINT)")

_ITEMS_SQL = f""",
it AS (SELECT en.page_id, nullif(f1v.title, '') AS title,
         nullif(replace(coalesce(an2.authors, ''), '|', ', '), '') AS author,
         (SELECT {_EPOCH_SQL} FROM (SELECT nullif(f13.publish_date, '') AS d)) AS publish_date,
         {_NETLOC.replace('url', 'en.url')} || CASE WHEN {_SEG.replace('url', 'en.url')} IS NULL THEN '' ELSE '/' || {_SEG.replace('url', 'en.url')} END AS category,
         nullif(m_description.content, '') AS summary, nullif(f19.text, '') AS content,
         en.url AS url_page, 'en' AS language, coalesce(f11.tags, '') AS tags
       FROM en JOIN f1v USING (page_id) LEFT JOIN f4 an2 USING (page_id) LEFT JOIN f13 USING (page_id)
         LEFT JOIN m_description USING (page_id) LEFT JOIN f19 USING (page_id) LEFT JOIN f11 USING (page_id)),
itf AS (SELECT *, CAST(CASE WHEN content IS NOT NULL AND row_number() OVER (PARTITION BY md5(lower(trim(regexp_replace(content, '\\s+', ' ', 'g'))))
          ORDER BY page_id) > 1 THEN 1 ELSE 0 END AS INTEGER) AS aflag FROM it)"""


def _items_flat(df):
    return df.select("page_id", "title", "author", "aflag", "publish_date", "category", "summary",
                     "content", "url_page", "language", F.coalesce(_join("tags"), F.lit("")).alias("tags"))


@register("news_items", S.field_ctes() + _ITEMS_SQL + """
SELECT page_id, title, author, aflag, publish_date, category, summary, content, url_page, language, tags FROM itf""")
def q_news_items(spark, sf):
    return _items_flat(_items(spark, sf))


@register("items_rejected", S.field_ctes() + _ITEMS_SQL + """
SELECT page_id, array_to_string(list_filter([CASE WHEN title IS NULL THEN 'title' END,
         CASE WHEN publish_date IS NULL THEN 'publish_date' END, CASE WHEN content IS NULL THEN 'content' END,
         CASE WHEN url_page IS NULL THEN 'url_page' END], lambda x: x IS NOT NULL), '|') AS reasons
FROM itf WHERE title IS NULL OR publish_date IS NULL OR content IS NULL OR url_page IS NULL""")
def q_items_rejected(spark, sf):
    from newsframe.operators.items import items_rejected
    return items_rejected(_items(spark, sf)).select("page_id", _join("reasons").alias("reasons"))


@register("items_json", S.field_ctes() + _ITEMS_SQL + """
SELECT page_id, to_json({'title': title, 'author': author, 'aflag': aflag, 'publish_date': publish_date,
  'category': category, 'summary': summary, 'content': content, 'url_image': NULL::VARCHAR,
  'tags': CASE WHEN tags = '' THEN []::VARCHAR[] ELSE string_split(tags, '|') END, 'url_page': url_page,
  'language': language, 'ratings': NULL::DOUBLE, 'comments': NULL::VARCHAR[]}) AS message FROM itf""")
def q_items_json(spark, sf):
    """A5: one JSON message per item."""
    from newsframe.operators.items import items_json
    return items_json(_items(spark, sf))


@register("clone_flags", """
SELECT doc_id, md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS content_hash,
       CAST(CASE WHEN text IS NOT NULL AND row_number() OVER (PARTITION BY md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))))
            ORDER BY doc_id) > 1 THEN 1 ELSE 0 END AS INTEGER) AS aflag
FROM documents""")
def q_clone_flags(spark, sf):
    from newsframe.operators.items import clone_flags
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return clone_flags(docs, "text", "doc_id").select("doc_id", "content_hash", "aflag")


# ----------------------------------------------------------------------
# Q: detect API and stream
# ----------------------------------------------------------------------

@register("detect_article", S.field_ctes() + """
SELECT np.page_id, coalesce(f1v.title_path, '') AS title_path, f1v.page_id IS NOT NULL AS is_parsed,
       CASE WHEN NOT (contains(np.url, '://') AND starts_with(np.url, 'http')) THEN 'bad_url'
            WHEN f1v.page_id IS NULL THEN 'language' END AS error
FROM np LEFT JOIN f1v USING (page_id)""")
def q_detect_article(spark, sf):
    from newsframe.plans.detect import detect
    d = detect(_news(spark, sf), mode="article", language=LANG)
    return d.select("page_id", F.coalesce("title_path", F.lit("")).alias("title_path"), "is_parsed", "error")


@register("detect_source", S.field_ctes() + _SEC_CTES + _E5_SQL)
def q_detect_source(spark, sf):
    """Q2: templates for the sites listed in the targets (here: every site
    of the crawl, so the result equals E5)."""
    from newsframe.plans.detect import detect
    pages = _news(spark, sf)
    return detect(pages, mode="source", targets=targets_from_pages(pages), sampling=SAMPLING, language=LANG)


@register("detect_stream", ORACLE["article_extract"])
def q_detect_stream(spark, sf):
    """Q3: the pages folder read as a stream (available-now trigger), each
    micro-batch enriched and extracted by F20 into a Parquet sink; returns
    the sink, which must equal the batch result (same oracle as F20)."""
    import uuid
    from newsframe.session import checkpoint_dir
    from newsframe.streaming.detect import detect_stream
    base = f"{checkpoint_dir(spark)}/detect-stream-{uuid.uuid4().hex}"
    q = detect_stream(spark, table_files(sf, "pages"), f"{base}/sink", LANG, checkpoint=f"{base}/ckpt", prepare=news_pages)
    q.awaitTermination()
    return _article_projection(spark.read.parquet(f"{base}/sink"))


@register("template_stream", ORACLE["apply_template"])
def q_template_stream(spark, sf):
    """E6 + Q3: the pages folder read as a stream and each micro-batch read
    with the templates learned in batch (stream-static); equals E6."""
    import uuid
    from newsframe.operators.sections import source_detect
    from newsframe.session import checkpoint_dir
    from newsframe.streaming.detect import template_stream
    base = f"{checkpoint_dir(spark)}/template-stream-{uuid.uuid4().hex}"
    templates = source_detect(_sections_pages(spark, sf), SAMPLING, LANG)
    q = template_stream(spark, table_files(sf, "pages"), templates, f"{base}/sink", checkpoint=f"{base}/ckpt", prepare=news_pages)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink").select("page_id", "key", "title", "text", "author",
                                                   "publish_date")


@register("learning_stream", ORACLE["section_template"])
def q_learning_stream(spark, sf):
    """E5 + Q3: templates learned while the pages arrive, in four parts of interleaved ids, the stream restarted for each;
    what is learned in the end equals E5 in batch over all pages."""
    import uuid
    from newsframe.session import checkpoint_dir
    from newsframe.streaming.learning import learned_templates, learning_stream
    base = f"{checkpoint_dir(spark)}/learning-stream-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64("page_id"), F.lit(4))
    for k in range(4):
        _pages(spark, sf).filter(part == k).write.mode("append").parquet(f"{base}/pages")
        learning_stream(spark, f"{base}/pages", f"{base}/sink", LANG, SAMPLING, checkpoint=f"{base}/ckpt", prepare=news_pages).awaitTermination()
    return learned_templates(spark, f"{base}/sink")


# Q3 with targets as messages: every page and every site is asked for, some messages come twice, some URLs are bad or unknown
_MESSAGES_SQL = """
SELECT concat('p', cast(page_id AS string)) AS message_id, url, true AS is_article, page_id AS at FROM {pages}
UNION ALL SELECT concat('x', cast(page_id AS string)) AS message_id, concat(url, '/unknown') AS url, true AS is_article, page_id AS at FROM {pages} WHERE page_id % 10 = 0
UNION ALL SELECT concat('b', cast(page_id AS string)) AS message_id, replace(url, '://', ':') AS url, page_id % 2 = 0 AS is_article, page_id AS at FROM {pages} WHERE page_id % 10 = 1
UNION ALL SELECT concat('s', cast(page_id AS string)) AS message_id, regexp_extract(url, '^[A-Za-z]+://[^/?#]*', 0) AS url, false AS is_article, page_id AS at
          FROM {pages} WHERE page_id % 3 = 0"""


@register("target_stream", S.field_ctes() + _SEC_CTES + _E5_CTES + """,
msg AS (""" + _MESSAGES_SQL.replace("{pages}", "pages") + """),
host AS (SELECT split_part(key, '/', 1) AS host, string_agg(key || '=' || title_path, ' ' ORDER BY key) AS templates FROM tmpl GROUP BY 1),
ans AS (SELECT message_id, msg.url, is_article, first.page_id, f1v.title_path, f13.publish_date, host.templates,
         contains(msg.url, '://') AND starts_with(msg.url, 'http') AS ok
  FROM msg LEFT JOIN (SELECT url, min(page_id) AS page_id FROM np GROUP BY url) first ON is_article AND first.url = msg.url
    LEFT JOIN f1v ON f1v.page_id = first.page_id LEFT JOIN f13 ON f13.page_id = first.page_id
    LEFT JOIN host ON NOT is_article AND host.host = """ + _NETLOC.replace("(url,", "(msg.url,") + """)
SELECT message_id, url, is_article,
  CASE WHEN NOT ok THEN 'bad_url' WHEN is_article AND page_id IS NULL THEN 'no_page' WHEN is_article AND title_path IS NULL THEN 'language'
       WHEN NOT is_article AND templates IS NULL THEN 'no_template' END AS error,
  CASE WHEN ok AND is_article THEN title_path END AS title_path, CASE WHEN ok AND is_article AND title_path IS NOT NULL THEN coalesce(publish_date, '') END AS publish_date,
  CASE WHEN ok AND NOT is_article THEN templates END AS templates FROM ans""")
def q_target_stream(spark, sf):
    """Q3: target messages answered as a stream, with repeated deliveries; equals Q1 and Q2 over the same targets."""
    import uuid
    from newsframe.session import checkpoint_dir
    from newsframe.streaming.targets import target_stream
    base = f"{checkpoint_dir(spark)}/target-stream-{uuid.uuid4().hex}"
    pages = _pages(spark, sf)
    messages = spark.sql(_MESSAGES_SQL, pages=pages).select("message_id", "url", "is_article", F.timestamp_seconds(F.col("at") + 1_700_000_000).alias("sent"))
    (messages.repartition(2, "message_id").union(messages.filter("message_id LIKE '%7'").coalesce(1)).write.json(f"{base}/messages"))
    q = target_stream(spark, f"{base}/messages", news_pages(pages), f"{base}/sink", LANG, SAMPLING, checkpoint=f"{base}/ckpt", delay="3650 days")
    q.awaitTermination()
    got = spark.read.text(f"{base}/sink").select(F.from_json("value", (
        "message_id string, url string, is_article boolean, error string, article struct<title_path:string,publish_date:string>, "
        "templates array<struct<key:string,title_path:string>>")).alias("m")).select("m.*")
    return got.select("message_id", "url", "is_article", "error", "article.title_path", "article.publish_date",
                      F.array_join(F.transform("templates", lambda t: F.concat(t["key"], F.lit("="), t["title_path"])), " ").alias("templates"))
