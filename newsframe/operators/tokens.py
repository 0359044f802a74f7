"""B0, B1, C9 and the native language gate: scans over raw HTML with no
parser.

These run entirely in the JVM (``regexp_extract_all`` + ``posexplode``) and
are the cheap path for flat facts. The regular expressions avoid
back-references and look-around so RE2 (the DuckDB oracle) and Java agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsframe.functions.entities import unescape

# The token grammar. Comments and script/style blocks are single
# tokens so markup inside them is not split.
TOKEN_RE = (r"<!--[\s\S]*?-->|<script[^>]*>[\s\S]*?</script>"
            r"|<style[^>]*>[\s\S]*?</style>|<[^>]*>|[^<]+")
RAW_BLOCK_RE = r"<script[^>]*>[\s\S]*?</script>|<style[^>]*>[\s\S]*?</style>"
COMMENT_RE = r"<!--([\s\S]*?)-->"
# attribute value in any of the three quoting styles (groups 1..3)
_ATTR_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# one attribute behind the tag name: name, then the value in one of the quoting styles
ATTRIBUTE_RE = r"""([^\s"'<>/=]+)(?:""" + _ATTR_VALUE + ")?"
TAG_HEAD_RE = r"^<[A-Za-z][^\s/>]*"
ROOT_TAG_RE = r"(?i)<html\b[^>]*>"
META_HTTP_EQUIV_LANG_RE = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?[^"'>]*content-language[^>]*>"""
META_NAME_LANG_RE = r"""(?i)<meta\b[^>]*\bname\s*=\s*["']?[^"'>]*lang[^>]*>"""


def attr_of_tag(tag_col: Column, attr: str) -> Column:
    """Value of ``attr`` in a raw start tag; NULL when absent."""
    pat = r"(?i)\s" + attr + _ATTR_VALUE
    found = tag_col.rlike(pat)
    val = F.concat(F.regexp_extract(tag_col, pat, 1), F.regexp_extract(tag_col, pat, 2),
                   F.regexp_extract(tag_col, pat, 3))
    return F.when(found, unescape(val))


def html_tokens(pages: DataFrame) -> DataFrame:
    """One row per token ``(page_id, pos, token, kind, tag)``.

    Kinds are decided by prefix tests (no per-token regex); only markup
    tokens run the tag-name extraction.
    """
    toks = pages.select(
        "page_id",
        F.posexplode(F.regexp_extract_all("html", F.lit(TOKEN_RE), F.lit(0))).alias("pos", "token"))
    t = F.col("token")
    second = F.substring(t, 2, 1)
    is_letter = ((second >= "A") & (second <= "Z")) | ((second >= "a") & (second <= "z"))
    kind = (F.when(~t.startswith("<"), "text")
            .when(t.startswith("<!--"), "comment")
            .when(t.startswith("<script") | t.startswith("<style"), "raw")
            .when((second == "!") & F.substring(t, 3, 1).rlike("[A-Za-z]"), "doctype")
            .when(t.startswith("</"), "end")
            .when(is_letter, "start")
            .otherwise("text"))
    tag = F.when(t.startswith("<"), F.lower(F.regexp_extract(t, r"^</?([A-Za-z][A-Za-z0-9-]*)", 1))) \
        .otherwise(F.lit(""))
    return toks.select("page_id", "pos", "token", kind.alias("kind"), tag.alias("tag"))


def decoded_text(tokens: DataFrame) -> DataFrame:
    """B1: text tokens with entities decoded."""
    return tokens.filter(F.col("kind") == "text").select(
        "page_id", "pos", unescape("token").alias("text"))


def attributes(tokens: DataFrame) -> DataFrame:
    """B1: one row per attribute of the start tags, ``(page_id, pos, attr_pos, tag, name, value)``.

    Names are in lower case, values have their character references decoded once; an attribute
    without a value has an empty one, a repeated attribute a row each time. No shuffle.
    """
    inner = F.regexp_replace("token", TAG_HEAD_RE, "")
    parts = F.arrays_zip(*[F.regexp_extract_all(inner, F.lit(ATTRIBUTE_RE), F.lit(k)).alias(f"g{k}") for k in range(1, 5)])
    rows = tokens.filter(F.col("kind") == "start").select("page_id", "pos", "tag", F.posexplode(parts).alias("attr_pos", "a"))
    rows = rows.select("page_id", "pos", "attr_pos", "tag", F.lower("a.g1").alias("name"), F.concat("a.g2", "a.g3", "a.g4").alias("value"))
    return rows.withColumn("value", unescape("value"))


def comments(pages: DataFrame) -> DataFrame:
    """All comments (script/style blocks blanked first), trimmed."""
    blanked = F.regexp_replace("html", RAW_BLOCK_RE, "")
    return pages.select(
        "page_id",
        F.posexplode(F.regexp_extract_all(blanked, F.lit(COMMENT_RE), F.lit(1)))
        .alias("pos", "comment")).select("page_id", "pos", F.trim("comment").alias("comment"))


def _simple_attr(tag_col: Column, attr: str) -> Column:
    """Value of ``attr`` in a raw start tag (any quoting), NULL when absent.
    Used for short code-like values (language tags)."""
    pat = r"""(?i)\s""" + attr + r"""\s*=\s*["']?([^"'\s>]*)"""
    return F.when(tag_col.rlike(pat), F.regexp_extract(tag_col, pat, 1))


def raw_meta_lang(html_col="html") -> Column:
    """F6 on raw HTML: root ``lang``, else the first content-language meta,
    else the first ``name~lang`` meta (its content even if empty), lower-cased;
    empty string when none."""
    h = F.col(html_col) if isinstance(html_col, str) else html_col
    root_lang = _simple_attr(F.regexp_extract(h, ROOT_TAG_RE, 0), "lang")
    eq_tag = F.regexp_extract(h, META_HTTP_EQUIV_LANG_RE, 0)
    nm_tag = F.regexp_extract(h, META_NAME_LANG_RE, 0)
    meta = (F.when(eq_tag != "", F.coalesce(_simple_attr(eq_tag, "content"), F.lit("")))
            .when(nm_tag != "", F.coalesce(_simple_attr(nm_tag, "content"), F.lit(""))))
    return F.lower(F.coalesce(F.nullif(root_lang, F.lit("")), meta, F.lit("")))


def language_gate(pages: DataFrame, language: str | None) -> DataFrame:
    """F7 before parsing: keep pages whose language contains ``language``.

    Catalyst cannot push a filter through the parser, so the gate is applied
    on the raw HTML and only surviving pages are parsed. A page without a
    language is dropped. ``language=None`` keeps every page.
    """
    with_lang = pages.withColumn("meta_lang", raw_meta_lang("html"))
    if language is None:
        return with_lang
    return with_lang.filter(F.col("meta_lang").contains(language))
