"""Sections, sampling, template learning and application.

* Sections (E1) are the distinct ``scheme://netloc/first-segment`` of the
  known pages; the article list (E2) is the pages grouped by section, unique
  by URL within a section, in (section position, page id) order.
* Sampling (E3) is an equi-join on the match key + ``row_number() <= k`` per
  section; Spark plans the rank filter as a ``WindowGroupLimit`` on both
  sides of the shuffle, so a hot section ships at most ``k`` rows per task.
* Only sampled pages are parsed to learn templates (E4/E5), bounded by
  ``k x sections``.
* Templates are applied (E6) by giving each page row its section's template and walking the
  template's paths down the page's own tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsframe.functions import urls as U
from newsframe.functions.aggs import first_by
from newsframe.functions.memo import per_session
from newsframe.operators.dom import inner_text, page_trees
from newsframe.operators.fields import _let, page_links

# ----------------------------------------------------------------------
# Path expressions on a page's row
# ----------------------------------------------------------------------

_SUFFIX_RE = r"(//text\(\)|/@[^/\[\]]+)$"
_DESC_ATTR_RE = r'^//([A-Za-z][A-Za-z0-9-]*)\[@([A-Za-z][A-Za-z0-9:_-]*)="([^"]*)"\]'


def path_kind(path: Column) -> Column:
    return (F.when(path.endswith("//text()"), F.lit("text"))
            .when(path.rlike(r"/@[^/\[\]]+$"), F.lit("attr"))
            .otherwise(F.lit("elem")))


def path_attr(path: Column) -> Column:
    return F.regexp_extract(path, r"/@([^/\[\]]+)$", 1)


def path_steps(path: Column) -> Column:
    """Stored absolute path -> its steps as (depth, tag, index); the index is null where the path
    has none: an XPath step without a predicate selects every such sibling."""
    steps = F.filter(F.split(F.regexp_replace(path, _SUFFIX_RE, ""), "/"), lambda s: s != "")
    return F.transform(steps, lambda s, i: F.struct(
        i.alias("depth"), F.regexp_replace(s, r"\[\d+\]$", "").alias("tag"),
        F.try_to_number(F.nullif(F.regexp_extract(s, r"\[(\d+)\]$", 1), F.lit("")), F.lit("999999999")).cast("int").alias("index")))


def matched(path: Column) -> Column:
    """The nodes of a page's row that a path selects, in document order; ``nodes`` must be a raw tree.

    An absolute path keeps the nodes that meet the step of their own depth and stand below such nodes only (``_chained``):
    each node is looked at once, however many steps there are. ``//tag[@a="v"]`` forms (the fixed og
    expressions) test tag and attribute.
    """
    def walked(steps):
        def meets(n):
            step = F.get(steps, n["depth"])
            return (n["tag"] == step["tag"]) & (step["index"].isNull() | (n["tag_pos"] == step["index"]))
        found = _let(F.filter("nodes", meets), lambda met: _chained(met, F.size(steps) - 1))
        return F.when(F.size(steps) == 0, F.array(F.lit(-1))).when(steps.isNotNull(), found)
    tag, name, value = (F.regexp_extract(path, _DESC_ATTR_RE, k) for k in (1, 2, 3))
    anywhere = F.filter("nodes", lambda n: (n["tag"] == tag) & F.coalesce(n["attrs"][name] == value, F.lit(False)))
    ids = _let(path_steps(path), walked)
    return F.when(tag != "", anywhere).otherwise(_let(ids, lambda found: F.transform(found, lambda i: F.get("nodes", i))))


def _chained(met: Column, depth: Column) -> Column:
    """The ids of the nodes at ``depth`` all of whose ancestors are among ``met`` too (some nodes in document order).

    Their starts and ends are sorted into one list, an end behind the starts inside. The ``k``-th start stands at place ``i`` of it:
    ``k`` nodes have started before it, ``i - k`` of them have ended, and the other ``2k - i`` are its ancestors.
    """
    starts = F.transform(met, lambda n: F.struct(n["id"].alias("at"), F.lit(0).alias("ends"), n["depth"].alias("depth")))
    ends = F.transform(met, lambda n: F.struct(n["end"].alias("at"), F.lit(1).alias("ends"), n["depth"].alias("depth")))
    placed = F.transform(F.sort_array(F.concat(starts, ends)), lambda e, i: F.struct(e["at"].alias("id"), e["ends"].alias("ends"), e["depth"].alias("depth"), i.alias("i")))
    held = F.transform(F.filter(placed, lambda e: e["ends"] == 0), lambda e, k: F.struct(e["id"].alias("id"), e["depth"].alias("depth"), (2 * k - e["i"]).alias("above")))
    return F.transform(F.filter(held, lambda n: (n["depth"] == depth) & (n["above"] == depth)), lambda n: n["id"])


def evaluated(path: Column) -> Column:
    """C4: struct (first_value, all_text) of a path on a page's row; ``nodes`` must be a raw tree.

    For ``/@a`` the attribute of the first match; for an element its subtree text (C1); for
    ``//text()`` every text run under every match, each followed by a
    newline (``all_text``), and the first run as ``first_value``. A run below several matches counts once.
    """
    return _let(matched(path), lambda found: _value(path, found))


def _value(path: Column, found: Column) -> Column:
    """What a path reads at the nodes that it selects."""
    kind = path_kind(path)
    first = F.get(found, 0)
    places = F.array_distinct(F.flatten(F.transform(F.filter(found, lambda n: n["hi"] > n["lo"]), lambda n: F.sequence(n["lo"], n["hi"] - 1))))
    texts = F.when(kind == "text", F.transform(F.sort_array(places), lambda i: F.get("runs", i)))
    return _let(texts, lambda t: F.struct(
        F.when(first.isNull(), F.lit(None)).when(kind == "attr", first["attrs"][path_attr(path)])
        .when(kind == "elem", inner_text(first)).otherwise(F.get(t, 0)).alias("first_value"),
        F.when(F.size(t) > 0, F.array_join(F.transform(t, lambda r: F.concat(r, F.lit("\n"))), "")).alias("all_text")))


def select_path(trees: DataFrame, path: Column) -> DataFrame:
    """C4 as rows: ``(page_id, path, first_value, all_text)`` of the pages on which the ``path`` (a column of ``trees``) matches.

    The rows come from a generator, which computes its array once. A filter on the path or on its matches would
    be pushed down with all that computes them (a body path: the scoring of the page) copied into it for each mention.
    """
    out = trees.select("page_id", path.alias("path"), "nodes", "runs")
    rows = _let(matched(F.col("path")), lambda found: F.when(F.size(found) > 0, F.array(_value(F.col("path"), found))))
    return out.select("page_id", "path", F.inline(rows))


# ----------------------------------------------------------------------
# Sections, article lists, samples
# ----------------------------------------------------------------------

def section_of(url_col: str = "url") -> Column:
    """Section URL of a page: ``scheme://netloc/first-segment`` (site root
    when the path has no segment)."""
    seg = U.first_segment(U.url_path(url_col))
    return F.when(seg.isNull() | (seg == ""), U.site_root(url_col)).otherwise(
        F.concat(U.site_root(url_col), F.lit("/"), seg))


def section_urls(pages: DataFrame) -> DataFrame:
    """``(site, section_url, pos)``; duplicates removed, first position
    (smallest page id) kept. Invalid URLs (U1) are skipped."""
    p = pages.filter(U.url_valid("url"))
    return (p.select(U.site_root("url").alias("site"), section_of("url").alias("section_url"), "page_id")
            .groupBy("site", "section_url").agg(F.min("page_id").alias("pos")))


def section_articles(pages: DataFrame) -> DataFrame:
    """``(section_url, url, page_id, apos)``: each section's article URLs,
    unique by URL within the section (first page id wins)."""
    p = pages.filter(U.url_valid("url")).select(section_of("url").alias("section_url"), "url", "page_id")
    return p.groupBy("section_url", "url").agg(F.min("page_id").alias("page_id")) \
        .withColumn("apos", F.col("page_id"))


def linked_articles(trees: DataFrame) -> DataFrame:
    """E2 from links: ``(section_url, url, title, page_id, node_id)``, the articles that the pages
    of each section link to (F14, U6), made absolute (U5), unique by URL within a section
    and kept across sections; title, page_id and node_id are those of the first link
    (by page id, then document order). Links without a valid URL (U1) are skipped. The trees carry ``url``."""
    links = page_links(trees.filter(U.url_valid("url"))).select(
        section_of("url").alias("section_url"), U.url_resolve("href", "url").alias("url"), "page_id", "node_id", "link_text")
    # one bounded buffer for each (section, url), combined map-side: a link on every page is no hot group
    first = links.filter(U.url_valid("url")).groupBy("section_url", "url") \
        .agg(F.min(F.struct("page_id", "node_id", "link_text")).alias("f"))
    return first.select("section_url", "url", F.col("f.link_text").alias("title"), F.col("f.page_id").alias("page_id"), F.col("f.node_id").alias("node_id"))


#: Under so many salts the rows that share one key are spread.
SALTS = 32


def spread_join(rows: DataFrame, found: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` left-joined with ``found`` (unique by ``key``) without a hot key: rows of one key are
    spread by a hash of column ``by``. The distinct (key, salt) pairs, at most ``SALTS`` for each key and combined
    map-side, are looked up in ``found`` and joined back under both."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    looked_up = salted.select(key, "_salt").distinct().join(found, key)
    return salted.join(looked_up, [key, "_salt"], "left").drop("_salt")


def resolved_articles(linked: DataFrame, pages: DataFrame) -> DataFrame:
    """The articles of ``linked`` with the known page of their URL: ``(section_url, url, page_id, apos)``.

    ``page_id`` is the first known page with that very URL, null for a link that leads to none; such an article stays in
    the list, as one whose download failed. ``apos`` orders a section's articles by their links.

    A URL that a third of the sections link to is no hot key (``spread_join``).
    """
    known = pages.filter(U.url_valid("url")).groupBy("url").agg(F.min("page_id").alias("found"))
    return spread_join(linked, known, "url", "section_url").select(
        "section_url", "url", F.col("found").alias("page_id"), F.struct(F.col("page_id").cast("long").alias("page"), F.col("node_id").cast("long").alias("node")).alias("apos"))


def section_sample(pages: DataFrame, sampling: int = 1, articles: DataFrame | None = None) -> DataFrame:
    """``(key, section_url, spos, url, page_id, rank)``.

    ``articles`` (section_url, url, page_id, apos) is the list to sample: the known pages themselves (E2), or what the
    sections link to (``resolved_articles``), where an article listed by two sections counts twice and one
    without a known page counts too.

    Section key = netloc + path; an article matches a section with a path
    through ``netloc/first-segment`` and a section without one through its
    netloc. Each section keeps its first ``sampling`` matches in article
    order; sections sharing a key both contribute (so an article can be
    listed twice under that key, as in the reference).
    """
    if sampling < 1:
        raise ValueError("sampling must be >= 1")
    secs = section_urls(pages).select(
        "section_url", F.col("pos").alias("spos"),
        U.section_key("section_url").alias("key"),
        (U.url_path("section_url") != "").alias("has_path"))
    # A key takes the articles of a section in the section's order, so only the first
    # ``sampling`` of each section and key can be among its first: the rank limit runs
    # before any join (map-side first), and a hot section or site ships k rows per task.
    first = Window.partitionBy("section_url", F.coalesce("k2", U.article_key("url", False))).orderBy("apos", "url")
    arts = (section_articles(pages) if articles is None else articles).withColumn("k2", U.article_key("url", True)) \
        .withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= sampling)
    # list position of an article: (position of its section, its own)
    al = arts.join(secs.select("section_url", F.col("spos").alias("a_spos")), "section_url")
    # every article under both of its keys: (netloc, no path) and (netloc/seg, path)
    keys = F.array(
        F.struct(U.article_key("url", False).alias("key"), F.lit(False).alias("has_path")),
        F.struct(F.col("k2").alias("key"), F.lit(True).alias("has_path")))
    ak = al.select("url", "page_id", F.struct("a_spos", "apos").alias("lpos"),
                   F.explode(keys).alias("k")) \
        .select("url", "page_id", "lpos", "k.key", "k.has_path").filter(F.col("key").isNotNull())
    # all sections of a key see the same list, so the rank is the key's
    w = Window.partitionBy("key", "has_path").orderBy("lpos", "url")
    ak = ak.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= sampling)
    ranked = secs.join(ak, ["key", "has_path"])
    return ranked.select("key", "section_url", "spos", "url", "page_id", "rank")


# ----------------------------------------------------------------------
# E4-E8
# ----------------------------------------------------------------------

def section_process_all(pages: DataFrame, samples: DataFrame, language: str | None = "en",
                        full: bool = False, stop_words: list[str] | None = None) -> DataFrame:
    """Extract every sampled article; failures stay listed unparsed.

    By default only what a template stores is extracted (title, body,
    author and date paths); ``full=True`` extracts the whole article.
    """
    from newsframe.plans.article import article_extract
    from newsframe.session import materialize
    # The sample ids are written first so Catalyst knows their exact size:
    # when small (k x sections) the semi-join is a broadcast hash join and the
    # HTML of the pages is never shuffled; otherwise Spark sort-merge joins.
    ids = materialize(samples.select("page_id").filter("page_id IS NOT NULL").distinct(), "sample-ids")
    todo = pages.join(ids, "page_id", "left_semi")
    art = article_extract(todo, language, stop_words, with_meta=full, with_text=full)
    return samples.join(art.drop("url"), "page_id", "left").withColumn(
        "is_parsed", F.coalesce("is_parsed", F.lit(False)))


TEMPLATE_SCHEMA_COLS = ["key", "page_id", "title_path", "text_path", "author_path", "date_path"]


def section_template(processed: DataFrame) -> DataFrame:
    """E5: per key, the first sampled article (in list order) that parsed;
    keys with none left disappear."""
    ok = processed.filter("is_parsed")
    tmpl = F.struct("page_id", "title_path", "text_path",
                    F.get(F.col("author_paths"), 0).alias("author_path"), "date_path")
    agg = ok.groupBy("key").agg(first_by(tmpl, F.struct("spos", "rank")).alias("t"))
    return agg.select("key", "t.page_id", "t.title_path", "t.text_path", "t.author_path", "t.date_path")


def template_targets(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Pages a template applies to: every valid page whose match key equals
    the template key (the template page itself excluded)."""
    keys = F.array(U.article_key("url", False), U.article_key("url", True))
    p = pages.filter(U.url_valid("url")).select("page_id", "url", F.explode(keys).alias("key")) \
        .filter(F.col("key").isNotNull())
    t = templates.withColumnRenamed("page_id", "template_page_id")
    j = p.join(t, "key").filter(F.col("page_id") != F.col("template_page_id"))
    # a page's two keys differ and template keys are unique: rows are
    # already one per (page, key); distinct is a hash aggregate on them
    return j.distinct()


FIELDS = {"title": "title_path", "text": "text_path", "author": "author_path", "publish_date": "date_path"}


def apply_template(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """``(page_id, key, title, text, author, publish_date)`` of the
    other pages of each section, read with the template's paths.

    title / author / date: first match; text: every ``//text()`` run plus a
    newline. Missing matches stay NULL; empty template fields do no lookup.

    Each page row is given the templates that apply to it (two at most) and carries them through the parser, so the
    paths are walked on the page's own row. The narrow (page, templates) rows are written first: Spark then knows
    their exact size and broadcasts a few, or shuffles the pages on their id for many.
    """
    from newsframe.session import materialize
    # templates: at most one row per section key, reused by several branches
    targets = template_targets(pages, materialize(templates, "templates"))
    own = materialize(targets.groupBy("page_id").agg(F.collect_list(F.struct("key", *FIELDS.values())).alias("templates")), "template-pages")
    trees = page_trees(pages.select("page_id", "html").join(own, "page_id"))
    return trees.select("page_id", F.inline(_reading()))


@per_session
def _reading() -> Column:
    """What a page's ``templates`` read on it."""
    def read(t):
        def value(path, part):
            return F.when(F.coalesce(path, F.lit("")) != "", evaluated(path)[part])
        return F.struct(t["key"].alias("key"), *[value(t[v], "all_text" if k == "text" else "first_value").alias(k) for k, v in FIELDS.items()])
    return F.transform("templates", read)


def template_report(applied: DataFrame) -> DataFrame:
    """Per key, pages tried, pages with every field, misses per field."""
    fields = ["title", "text", "author", "publish_date"]
    complete = F.lit(True)
    for f in fields:
        complete = complete & F.col(f).isNotNull()
    return applied.groupBy("key").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(complete).alias("complete"),
        *[F.count_if(F.col(f).isNull()).alias(f"missing_{f}") for f in fields])


def source_detect(pages: DataFrame, sampling: int = 1, language: str | None = "en",
                  stop_words: list[str] | None = None, linked: bool = False) -> DataFrame:
    """The whole site query (E1, E2, E3, E4, E5): templates per key. With ``linked`` the sections' articles are those that
    their pages link to, else the known pages themselves."""
    articles = resolved_articles(linked_articles(page_trees(pages.select("page_id", "url", "html"))), pages) if linked else None
    samples = section_sample(pages, sampling, articles)
    return section_template(section_process_all(pages, samples, language, stop_words=stop_words))
