"""Per-page field extraction from page trees.

Everything is a projection of a page's own row (``dom.page_trees``): no shuffle, no join. One
pass over the nodes keeps the few that any field may read (title, headings, metas, links,
tag links, elements named like an author); paths are built for these only, with one
look-up for each of their parents. ``page_facts`` picks each field's raw candidates from them and
``flat_fields`` decides between the candidates.

Every field yields the XPath the reference stores (``*_path``) and, where it
is cheap, the value that path selects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsframe.functions.memo import per_session
from newsframe.functions.text import byline_names, inner_trim, title_filter
from newsframe.operators.dom import AUTHOR_MARK, KEYED_MARK, attr, carried, inner_text, parent_paths, step_of, text_of


def _irx(n: Column, name: str, pattern: str) -> Column:
    """Unanchored, case-insensitive regex test on an attribute."""
    return F.coalesce(attr(n, name).rlike("(?i)" + pattern), F.lit(False))


def _eq(n: Column, name: str, value: str) -> Column:
    return F.coalesce(attr(n, name) == value, F.lit(False))


def _has(n: Column, name: str) -> Column:
    return F.map_contains_key(n["attrs"], F.lit(name))


def _marked(n: Column, mark: int) -> Column:
    return n["marks"].bitwiseAND(mark) > 0


# Author probes, attribute-major.
AUTHOR_ATTRS = ["name", "rel", "itemprop", "class", "id"]
AUTHOR_VALUES = ["author", "byline", "dc.creator"]

# Publish-date probes in priority order (attribute, pattern,
# attribute holding the date).
DATE_PROBES = [
    ("property", "rnews:datePublished", "content"),
    ("property", "article:modified_time", "content"),
    ("property", "article:published_time", "content"),
    ("name", "OriginalPublicationDate", "content"),
    ("itemprop", "datePublished", "content"),
    ("itemprop", "datePublished", "datetime"),
    ("property", "og:published_time", "content"),
    ("name", "article_date_original", "content"),
    ("name", "publication_date", "content"),
    ("name", "sailthru.date", "content"),
    ("name", "PublishDate", "content"),
]

# Href fragments of the second tag tier.
TAG_HREF_PARTS = ["/tag/", "/tags/", "/topic/", "?keyword="]

# The paths stored for an og title.
OG_TITLE_PROPERTY_PATH = '//meta[@property="og:title"]/@content'
OG_TITLE_NAME_PATH = '//meta[@name="og:title"]/@content'


def _tag_tier(n: Column) -> Column:
    """1 for links marked as tags, 2 for links into tag pages, else null."""
    into = F.lit(False)
    for part in TAG_HREF_PARTS:
        into = into | F.coalesce(attr(n, "href").contains(part), F.lit(False))
    return F.when(n["tag"] == "a", F.when(_eq(n, "rel", "tag"), 1).when(into, 2))


def _author_hits(n: Column) -> Column:
    probes = [(a, v) for a in AUTHOR_ATTRS for v in AUTHOR_VALUES]
    return F.array_compact(F.array(*[F.when(_irx(n, a, v), F.lit(i)) for i, (a, v) in enumerate(probes)]))


def _meta_event(n: Column) -> Column:
    """One F12 update event of a meta element with a key and a value, else null."""
    key = F.trim(F.coalesce(F.nullif(attr(n, "property"), F.lit("")), attr(n, "name")))
    vpath = (F.when(F.coalesce(attr(n, "content"), F.lit("")) != "", F.concat(n["path"], F.lit("/@content")))
             .when(F.coalesce(attr(n, "value"), F.lit("")) != "", F.concat(n["path"], F.lit("/@value"))))
    parts = F.split(key, ":")
    plain = F.size(parts) == 1
    return F.when(key.isNotNull() & (key != "") & vpath.isNotNull(), F.struct(
        F.when(plain, key).otherwise(parts[0]).alias("head"), n["id"].alias("node_id"), plain.alias("plain"),
        F.when(F.size(parts) == 2, parts[1]).alias("sub"), F.when(plain, n["path"]).otherwise(vpath).alias("value")))


@per_session
def _candidate_columns() -> tuple[Column, Column, Column, Column]:
    """Of a page's row: the root's language, the nodes that a field may read, their parents' paths (``_found``), and these nodes with path, text and tag
    tier (``_found``, ``_paths``)."""
    def wanted(n):
        inner = n["parent"] >= 0
        return ((n["tag"].isin("title", "link", "h1") & inner) | (n["tag"] == "meta") | (n["marks"] > 0) | _tag_tier(n).isNotNull())

    def cand(n):
        read = n["tag"].isin("title", "h1", "a") | _marked(n, AUTHOR_MARK)
        return F.struct(n["id"].alias("id"), n["parent"].alias("parent"), n["tag"].alias("tag"), n["attrs"].alias("attrs"), n["marks"].alias("marks"),
                        F.concat(F.element_at("_paths", n["parent"]), F.lit("/"), step_of(n)).alias("path"),
                        F.when(read, inner_text(n)).alias("text"), _tag_tier(n).alias("tier"))
    return (F.coalesce(attr(F.get("nodes", F.lit(0)), "lang"), F.lit("")).alias("root_lang"), F.filter("nodes", wanted).alias("_found"),
            parent_paths(F.col("_found")), F.transform("_found", cand).alias("cands"))


def _candidates(trees: DataFrame) -> DataFrame:
    """Adds ``cands``: the nodes that a field may read, in document order, with path, text and tag tier."""
    root_lang, found, paths, cands = _candidate_columns()
    src = trees.select(*carried(trees), F.size("nodes").alias("n_nodes"), root_lang, "nodes", "runs", found).withColumn("_paths", paths)
    return src.select(*carried(trees), "n_nodes", "root_lang", cands)


@per_session
def _kinds() -> list[Column]:
    return [F.filter("cands", lambda n: n["tag"] == "meta").alias("metas"),
            F.filter("cands", lambda n: (n["tag"] == "link") & (n["parent"] >= 0)).alias("links")]


def page_facts(trees: DataFrame, keep_empty: bool = False) -> DataFrame:
    """The raw candidates of F1, F3, F4, F6, F8-F13 of every page that has elements (of all pages on request), as one row of arrays and structs."""
    c = _candidates(trees)
    c = c if keep_empty else c.filter("n_nodes > 0")
    keep = carried(trees) + ["n_nodes", "root_lang"]
    return c.select(*keep, "cands", *_kinds()).select(*keep, *_fact_columns())


@per_session
def _fact_columns() -> list[Column]:
    def first(found: str, test, value):
        return F.get(F.transform(F.filter(found, test), value), 0)

    def inner(n):
        return n["parent"] >= 0

    def titled(n):
        return F.struct(n["path"].alias("path"), n["text"].alias("text"))

    def valued(name):
        return lambda n: F.struct(n["path"].alias("path"), attr(n, name).alias("value"))

    def author(n):
        is_meta = n["tag"] == "meta"
        return F.struct(_author_hits(n).alias("hits"), n["id"].alias("node_id"),
                        F.when(is_meta, F.concat(n["path"], F.lit("/@content"))).otherwise(n["path"]).alias("path"),
                        F.when(is_meta, attr(n, "content")).otherwise(n["text"]).alias("text"))

    def dates(n):
        return F.array_compact(F.array(*[
            F.when(_irx(n, a, v), F.struct(F.lit(i).alias("probe"), n["id"].alias("node_id"), n["path"].alias("path"), F.lit(k).alias("cattr"), attr(n, k).alias("value")))
            for i, (a, v, k) in enumerate(DATE_PROBES)]))

    # the longest heading, the first of equals
    h1s = F.transform(F.filter("cands", lambda n: (n["tag"] == "h1") & inner(n)),
                      lambda n: F.struct(F.length(n["text"]).alias("len"), (-n["id"]).alias("neg"), n["path"].alias("path"), n["text"].alias("text")))
    return [
        first("cands", lambda n: (n["tag"] == "title") & inner(n), titled).alias("title_el"),
        F.array_max(h1s).alias("h1_el"),
        first("metas", lambda n: inner(n) & _eq(n, "property", "og:title") & _has(n, "content"), lambda n: attr(n, "content")).alias("og_prop"),
        first("metas", lambda n: inner(n) & _eq(n, "name", "og:title") & _has(n, "content"), lambda n: attr(n, "content")).alias("og_name"),
        first("metas", lambda n: inner(n) & _irx(n, "http-equiv", "content-language"), valued("content")).alias("lang_eq"),
        first("metas", lambda n: inner(n) & _irx(n, "name", "lang"), valued("content")).alias("lang_nm"),
        first("links", lambda n: _irx(n, "rel", "icon"), valued("href")).alias("favicon_el"),
        first("metas", lambda n: _eq(n, "name", "description"), valued("content")).alias("desc_el"),
        first("metas", lambda n: _eq(n, "name", "keywords"), valued("content")).alias("kw_el"),
        first("links", lambda n: _irx(n, "rel", "canonical"), valued("href")).alias("canon_el"),
        first("metas", lambda n: _eq(n, "property", "og:url"), lambda n: F.struct(
            n["path"].alias("path"), attr(n, "content").alias("content"), attr(n, "href").alias("href"))).alias("ogurl_el"),
        F.transform(F.filter("cands", lambda n: n["tier"].isNotNull()), lambda n: F.struct(
            n["tier"].alias("tier"), n["path"].alias("path"), F.coalesce(n["text"], F.lit("")).alias("text"))).alias("tag_cands"),
        F.flatten(F.transform(F.filter("cands", lambda n: _marked(n, KEYED_MARK)), dates)).alias("date_cands"),
        F.transform(F.filter("cands", lambda n: _marked(n, AUTHOR_MARK) & ((n["tag"] != "meta") | _has(n, "content"))), author).alias("author_cands"),
        F.array_compact(F.transform("metas", _meta_event)).alias("meta_events")]


# ----------------------------------------------------------------------
# F4 and F12 rules on the per-page candidate arrays
# ----------------------------------------------------------------------

def author_hits(cands: Column) -> Column:
    """Each author candidate once per probe it hits, with its names."""
    expanded = F.flatten(F.transform(cands, lambda c: F.transform(
        c["hits"], lambda p: F.struct(p.alias("probe"), c["node_id"].alias("node_id"), c["path"].alias("path"), c["text"].alias("text")))))
    return F.filter(expanded, lambda x: F.coalesce(x["text"], F.lit("")) != "")


def authors_from(cands: Column):
    """F4 on one page's author candidates: ``(author_paths, authors)``.

    Each candidate is listed once per probe it hits (attribute-major probe
    order, then document order); it counts iff its byline yields a name;
    the list is unique by the lower-cased text, first occurrence kept: hits sorted by that
    text and their order keep the first of each, then the order is restored.
    """
    named = F.filter(F.transform(author_hits(cands), lambda x: F.struct(
        F.lower(x["text"]).alias("key"), x["probe"].alias("probe"), x["node_id"].alias("node_id"),
        x["path"].alias("path"), byline_names(x["text"]).alias("names"))), lambda x: F.size(x["names"]) > 0)

    def firsts(by_key):
        once = F.filter(by_key, lambda x, i: (i == 0) | (F.get(by_key, i - 1)["key"] != x["key"]))
        return F.sort_array(F.transform(once, lambda x: F.struct(x["probe"], x["node_id"], x["path"], x["names"])))
    return _let(F.sort_array(named), lambda s: _let(firsts(s), lambda f: F.struct(
        F.transform(f, lambda x: x["path"]).alias("paths"), F.array_distinct(F.flatten(F.transform(f, lambda x: x["names"]))).alias("names"))))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), 0)


META_ENTRY = "struct<head:string,sub:string,ord:int,value:string>"


def meta_entries(events: Column) -> Column:
    """F12 on one page's meta events: entries (head, sub, ord, value) after the update rules.

    Plain keys are stored under sub ``''`` (their value is the element path);
    ``head:sub`` keys under ``sub`` (value path ``/@content`` or ``/@value``).
    A plain key resets the head; a later two-part key turns a plain value into
    ``{head: old}``; three-part keys only create the head (sub null).

    The events are sorted by head and order once; a head's events are a slice between
    neighbouring positions, and of equal subs the last one is the one before a change.
    """
    def of_head(ev):
        last_plain = F.array_max(F.transform(ev, lambda e: F.when(e["plain"], e["node_id"])))
        after = F.filter(ev, lambda e: ~e["plain"] & (e["node_id"] > F.coalesce(last_plain, F.lit(-1))))
        plain = F.get(F.filter(ev, lambda e: e["node_id"] == last_plain), 0)
        head = F.get(ev, 0)["head"]

        def entry(sub, order, value):
            return F.struct(head.alias("head"), sub.alias("sub"), order.alias("ord"), value.alias("value"))
        none = F.array().cast(f"array<{META_ENTRY}>")
        two = F.transform(F.filter(after, lambda e: e["sub"].isNotNull()), lambda e: entry(e["sub"], e["node_id"], e["value"]))
        old = F.when(last_plain.isNotNull(), F.array(entry(F.when(F.size(after) == 0, F.lit("")).otherwise(head), F.lit(-1), plain["value"]))).otherwise(none)

        def latest(x):
            return F.filter(x, lambda e, i: F.coalesce(F.get(x, i + 1)["sub"] != e["sub"], F.lit(True)))
        made = _let(F.sort_array(F.concat(old, two)), latest)
        return F.when(F.size(made) > 0, made).otherwise(F.array(entry(F.lit(None).cast("string"), F.lit(-1), F.lit(None).cast("string"))))

    def of_page(ev):
        starts = F.filter(F.transform(ev, lambda e, i: F.when((i == 0) | (F.get(ev, i - 1)["head"] != e["head"]), i)), lambda i: i.isNotNull())
        return _let(starts, lambda st: F.flatten(F.transform(st, lambda a, k: _let(
            F.slice(ev, a + 1, F.coalesce(F.get(st, k + 1), F.size(ev)) - a), of_head))))
    return _let(F.sort_array(events), of_page)


def meta_map_from(entries: Column) -> Column:
    """F12 folded: ``map<head, map<sub, path>>`` from ``meta_entries`` (an empty inner map for heads
    that only had three-part keys)."""
    def fold(en):
        starts = F.filter(F.transform(en, lambda e, i: F.when((i == 0) | (F.get(en, i - 1)["head"] != e["head"]), i)), lambda i: i.isNotNull())
        return _let(starts, lambda st: F.map_from_entries(F.transform(st, lambda a, k: F.struct(
            F.get(en, a)["head"], F.map_from_entries(F.transform(
                F.filter(F.slice(en, a + 1, F.coalesce(F.get(st, k + 1), F.size(en)) - a), lambda e: e["sub"].isNotNull()),
                lambda e: F.struct(e["sub"], e["value"])))))))
    return _let(entries, fold)


# ----------------------------------------------------------------------
# rules on the one-row-per-page facts
# ----------------------------------------------------------------------

def title_rule(t_text: Column, t_path: Column, h_text: Column, h_path: Column,
               g_text: Column, g_path: Column) -> Column:
    """the ordered title rules; returns the chosen path."""
    ft, fh, fg = title_filter(t_text), title_filter(h_text), title_filter(g_text)
    return (F.when(t_path.isNull(), F.lit(""))
            .when(h_text == t_text, t_path)
            .when((fh != "") & (fh == fg), h_path)
            .when((fh != "") & F.contains(ft, fh) & (fg != "") & F.contains(ft, fg)
                  & (F.length(h_text) > F.length(g_text)), h_path)
            .when((fg != "") & (fg != ft) & F.startswith(ft, fg), g_path)
            .otherwise(t_path))


def flat_fields(facts: DataFrame) -> DataFrame:
    """F1-F4, F6, F8-F13 from ``page_facts``."""
    fixed = {"n_nodes", "root_lang", "title_el", "h1_el", "og_prop", "og_name", "lang_eq", "lang_nm", "favicon_el", "desc_el", "kw_el",
             "canon_el", "ogurl_el", "tag_cands", "date_cands", "author_cands", "meta_events"}
    kept = [c for c in facts.columns if c not in fixed]
    return facts.withColumn("_authors", _author_column()).select(*kept, *_flat_columns())


@per_session
def _author_column() -> Column:
    return authors_from(F.col("author_cands"))


@per_session
def _entry_column() -> Column:
    return meta_entries(F.col("meta_events"))


@per_session
def _flat_columns() -> list[Column]:
    h1_text = F.coalesce(inner_trim(F.col("h1_el.text")), F.lit(""))
    og_text = F.coalesce(F.col("og_prop"), F.col("og_name"), F.lit(""))
    og_path = (F.when(F.col("og_prop").isNotNull(), F.lit(OG_TITLE_PROPERTY_PATH))
               .when(F.col("og_name").isNotNull(), F.lit(OG_TITLE_NAME_PATH)))
    t_text = F.coalesce(F.col("title_el.text"), F.lit(""))
    title_path = title_rule(t_text, F.col("title_el.path"), h1_text, F.col("h1_el.path"),
                            og_text, og_path)
    title_value = (F.when(title_path == F.col("title_el.path"), t_text)
                   .when(title_path == F.col("h1_el.path"), h1_text)
                   .when(title_path == og_path, og_text)
                   .otherwise(F.lit("")))
    # root lang, else the first content-language meta, else name~lang
    lang_meta = F.when(F.col("lang_eq").isNotNull(), F.col("lang_eq")) \
        .otherwise(F.col("lang_nm"))
    meta_lang = (F.when(F.col("root_lang") != "", F.lower("root_lang"))
                 .when(lang_meta.isNotNull(), F.lower(F.coalesce(lang_meta["value"], F.lit(""))))
                 .otherwise(F.lit("")))
    lang_path = (F.when(F.col("root_lang") != "", F.lit("/html/@lang"))
                 .when(lang_meta.isNotNull(), F.concat(lang_meta["path"], F.lit("/@content")))
                 .otherwise(F.lit("")))
    # canonical link with an href, else og:url content, else its href
    canon_ok = F.coalesce(F.col("canon_el.value"), F.lit("")) != ""
    og_content = F.coalesce(F.col("ogurl_el.content"), F.lit(""))
    og_href = F.coalesce(F.col("ogurl_el.href"), F.lit(""))
    canonical_path = (F.when(canon_ok, F.concat(F.col("canon_el.path"), F.lit("/@href")))
                      .when(og_content != "", F.concat(F.col("ogurl_el.path"), F.lit("/@content")))
                      .when(og_href != "", F.concat(F.col("ogurl_el.path"), F.lit("/@href")))
                      .otherwise(F.lit("")))
    canonical = (F.when(canon_ok, F.col("canon_el.value"))
                 .when(og_content != "", og_content)
                 .when(og_href != "", og_href).otherwise(F.lit("")))
    # first tier with any element; the set of their paths
    min_tier = F.array_min(F.transform("tag_cands", lambda x: x["tier"]))
    chosen = F.array_distinct(F.sort_array(F.filter("tag_cands", lambda x: x["tier"] == min_tier)))
    empty = F.array().cast("array<string>")
    tags = F.when(F.col("n_nodes") <= 1, empty).otherwise(
        F.array_distinct(F.transform(chosen, lambda x: x["path"])))
    tag_texts = F.when(F.col("n_nodes") <= 1, empty).otherwise(
        F.array_distinct(F.filter(F.transform(chosen, lambda x: x["text"]), lambda t: t != "")))
    # per probe only its first element counts; first probe with a value
    dates = F.sort_array(F.col("date_cands"))
    firsts = F.filter(dates, lambda x, i: (i == 0) | (F.get(dates, i - 1)["probe"] != x["probe"]))
    date_hit = F.get(F.filter(firsts, lambda x: F.coalesce(x["value"], F.lit("")) != ""), 0)
    return [
        F.col("_authors.paths").alias("author_paths"), F.col("_authors.names").alias("authors"),
        meta_map_from(_entry_column()).alias("meta_map"),
        meta_lang.alias("meta_lang"), lang_path.alias("lang_path"),
        title_path.alias("title_path"), title_value.alias("title"),
        F.col("h1_el.path").alias("h1_path"), h1_text.alias("h1_text"),
        og_text.alias("og_title"), og_path.alias("og_path"),
        F.coalesce(F.concat(F.col("favicon_el.path"), F.lit("/@href")), F.lit("")).alias("favicon_path"),
        F.coalesce(F.col("favicon_el.value"), F.lit("")).alias("favicon"),
        F.coalesce(F.concat(F.col("desc_el.path"), F.lit("/@content")), F.lit("")).alias("description_path"),
        F.coalesce(F.col("desc_el.value"), F.lit("")).alias("description"),
        F.coalesce(F.concat(F.col("kw_el.path"), F.lit("/@content")), F.lit("")).alias("keywords_path"),
        F.coalesce(F.col("kw_el.value"), F.lit("")).alias("keywords"),
        canonical_path.alias("canonical_path"), canonical.alias("canonical_link"),
        tags.alias("tag_paths"), tag_texts.alias("tags"),
        F.coalesce(F.concat(date_hit["path"], F.lit("/@"), date_hit["cattr"]), F.lit("")).alias("date_path"),
        F.coalesce(date_hit["value"], F.lit("")).alias("publish_date"),
    ]


# ----------------------------------------------------------------------
# F4/F5 authors and F12 meta map by themselves
# ----------------------------------------------------------------------

def author_candidates(trees: DataFrame) -> DataFrame:
    """Every (probe, element) hit of the 15 author probes with its text.

    A node can hit several probes; it is listed once per hit, probes in
    attribute-major order. Meta elements read ``content`` (a meta without one
    is skipped), others their subtree text (C1).
    """
    return page_facts(trees).select("page_id", F.inline(author_hits(F.col("author_cands"))))


def authors(trees: DataFrame) -> DataFrame:
    """``(page_id, author_paths, authors)`` for pages with any author;
    order kept, unique by the lower-cased text; an element counts iff its
    byline yields a name."""
    found = page_facts(trees).select("page_id", _author_column().alias("a"))
    return found.select("page_id", F.col("a.paths").alias("author_paths"), F.col("a.names").alias("authors")).filter(F.size("author_paths") > 0)


def meta_rows(trees: DataFrame) -> DataFrame:
    """F12 long form: ``(page_id, head, sub, value)``, the entries that ``meta_map`` holds."""
    return page_facts(trees).select("page_id", F.inline(_entry_column())).select("page_id", "head", "sub", "value")


def meta_map(trees: DataFrame) -> DataFrame:
    """F12 folded, for pages with any meta entry."""
    return page_facts(trees).filter(F.size("meta_events") > 0).select("page_id", meta_map_from(_entry_column()).alias("meta_map"))


# ----------------------------------------------------------------------
# F14 / F15
# ----------------------------------------------------------------------

def page_links(trees: DataFrame) -> DataFrame:
    """``(page_id, node_id, href, link_text)`` of ``a`` elements with a
    non-empty href without ``#``, in document order, with the columns the trees carry; text is the element's own leading text
    (NULL when the link starts with a child element)."""
    def kept(n):
        href = attr(n, "href")
        return (n["tag"] == "a") & (n["parent"] >= 0) & F.coalesce((href != "") & ~href.contains("#"), F.lit(False))
    links = F.transform(F.filter("nodes", kept), lambda n: F.struct(
        n["id"].alias("node_id"), attr(n, "href").alias("href"), F.nullif(text_of(n), F.lit("")).alias("link_text")))
    return trees.select(*carried(trees), F.inline(links))


# Fixed values (ours): elements that carry an embedded video.
VIDEO_TAGS = ["iframe", "embed", "object", "video", "source"]


@per_session
def videos_in(top: str | None = None) -> Column:
    """F15 of a page's row: ``src``, else ``data-src``, of its video elements (inside the node in column ``top`` when given), in
    document order; null when there is none."""
    def test(n):
        cond = n["tag"].isin(VIDEO_TAGS)
        return cond if top is None else cond & F.coalesce((n["id"] >= F.col(top)["id"]) & (n["id"] <= F.col(top)["end"]), F.lit(False))
    src = F.array_compact(F.transform(F.filter("nodes", test), lambda n: F.coalesce(F.nullif(attr(n, "src"), F.lit("")), attr(n, "data-src"))))
    return _let(src, lambda v: F.when(F.size(v) > 0, v))


def video_sources(trees: DataFrame) -> DataFrame:
    """F15 over whole pages: ``(page_id, videos)`` of pages with any."""
    return trees.select("page_id", videos_in().alias("videos")).filter("videos IS NOT NULL")
