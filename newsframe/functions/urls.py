"""URL operators as column expressions.

``regexp_extract`` is used instead of ``parse_url``: with ANSI mode on,
``parse_url`` raises on malformed input and ``try_parse_url`` returns NULL
for paths with characters such as ``|``; the regular expressions below give
the split a browser (and Python's ``urlparse``) gives for these parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The URL grammar pieces used below.
SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
NETLOC_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
PATH_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def url_valid(col) -> Column:
    """Non-null, contains ``://`` and starts with ``http``."""
    c = _c(col)
    return F.coalesce(c.contains("://") & c.startswith("http"), F.lit(False))


def url_scheme(col) -> Column:
    return F.regexp_extract(_c(col), SCHEME_RE, 1)


def url_netloc(col) -> Column:
    """Network location (host and port, case kept)."""
    return F.regexp_extract(_c(col), NETLOC_RE, 1)


def url_path(col) -> Column:
    return F.regexp_extract(_c(col), PATH_RE, 1)


def first_segment(path_col) -> Column:
    """First path segment: ``/en/12`` -> ``en``; empty path -> NULL."""
    p = _c(path_col)
    return F.when(p == "", F.lit(None)).otherwise(F.split_part(p, F.lit("/"), F.lit(2)))


def site_root(col) -> Column:
    """``scheme://netloc`` of a URL (the site a page belongs to)."""
    return F.concat(url_scheme(col), F.lit("://"), url_netloc(col))


def section_key(col) -> Column:
    """Key of a section: netloc + path, verbatim."""
    return F.concat(url_netloc(col), url_path(col))


def article_key(col, with_segment: bool) -> Column:
    """U4: key of an article: netloc, plus ``/`` + first path segment when the
    section it is matched against has a path. An article with an empty path
    has no key in that case (the reference aborts the site)."""
    if not with_segment:
        return url_netloc(col)
    seg = first_segment(url_path(col))
    return F.when(seg.isNull(), F.lit(None)).otherwise(
        F.concat(url_netloc(col), F.lit("/"), seg))


def url_resolve(href_col, base_col) -> Column:
    """A link made absolute against its site ``scheme://netloc``."""
    h = _c(href_col)
    b = _c(base_col)
    root = site_root(b)
    return (F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), h)
            .when(h.startswith("//"), F.concat(url_scheme(b), F.lit(":"), h))
            .when(h.startswith("/"), F.concat(root, h))
            .otherwise(F.concat(root, F.lit("/"), h)))


def link_keep(href_col) -> Column:
    """Links with a non-empty href and no ``#``."""
    h = _c(href_col)
    return F.coalesce((h != "") & ~h.contains("#"), F.lit(False))


def link_hash(col) -> Column:
    """MD5 identity of an article URL."""
    return F.md5(_c(col))
