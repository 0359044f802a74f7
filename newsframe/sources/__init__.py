"""A1/A2 sources: site lists and raw pages.

Everything is read with ``spark.read``; Parquet scans get column pruning and
predicate push-down from Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsframe.functions.urls import site_root, url_valid

PAGES_SCHEMA = "page_id long, url string, html string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_pages(spark: SparkSession, path: str) -> DataFrame:
    """A2: raw pages ``(page_id, url, html)`` from Parquet."""
    return spark.read.parquet(path).select(
        F.col("page_id").cast("long"), "url", "html")


def table_files(sf_dir: str, name: str) -> str:
    """A stream's path to a table that is one file or a folder of part files: a pattern, because a path that is none must be a folder."""
    return f"{sf_dir}/{name}[.]parquet"


def load_html_files(spark: SparkSession, pattern: str) -> DataFrame:
    """A2 for a folder of ``.html`` files: one page per file; the file URI is
    the url and its 64-bit hash the page id."""
    raw = spark.read.text(pattern, wholetext=True)
    return raw.select(
        F.xxhash64(F.input_file_name()).alias("page_id"),
        F.input_file_name().alias("url"),
        F.col("value").alias("html"))


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    """A1: a site list, one URL per line, stripped; blank lines skipped."""
    return (spark.read.text(path)
            .select(F.trim("value").alias("url"))
            .filter(F.col("url") != ""))


def targets_from_pages(pages: DataFrame) -> DataFrame:
    """A1 on the driver tables: the distinct valid sites of ``pages.url``."""
    return (pages.filter(url_valid("url"))
            .select(site_root("url").alias("url")).distinct())


# The enriched fixture of FIXTURES.md section 2: head metadata, bylines, tags
# and a video are added to the plain pages by one SQL text that runs unchanged
# in Spark SQL and DuckDB.
NEWS_PAGES_SQL = """
SELECT page_id, url,
 replace(replace(replace(replace(html,
  '</title>', concat(
    CASE WHEN page_id % 5 = 0 OR page_id % 5 = 3 THEN '' ELSE ' - Site' END, '</title>',
    CASE page_id % 5
      WHEN 1 THEN concat('<meta property="og:title" content="', h1, '">')
      WHEN 2 THEN concat('<meta name="og:title" content="', substring(h1, 1, 10), '">')
      WHEN 3 THEN concat('<meta property="og:title" content="', substring(title, 1, 8), '">')
      ELSE '' END,
    CASE page_id % 3
      WHEN 0 THEN concat('<link rel="canonical" href="', regexp_extract(url, '^[^?#]*', 0), '">')
      WHEN 1 THEN concat('<meta property="og:url" content="', url, '">')
      ELSE '' END,
    CASE page_id % 4
      WHEN 0 THEN '<meta name="author" content="By: Foo Bar, Far Boo">'
      WHEN 1 THEN '<meta name="byline" content="fake_text">'
      ELSE '' END,
    CASE WHEN page_id % 6 = 0 THEN '<meta property="article:modified_time" content="2017-04-01T10:00:00Z">' ELSE '' END,
    CASE page_id % 3
      WHEN 0 THEN '<meta property="article:published_time" content="2017-03-25">'
      WHEN 1 THEN '<meta itemprop="datePublished" content="2017-03-26">'
      ELSE '' END,
    '<meta name="description" content="page ', cast(page_id AS string), '">',
    '<meta name="keywords" content="k', cast(page_id % 7 AS string), ',k">',
    CASE WHEN page_id % 2 = 0 THEN '<link rel="shortcut icon" href="/f.ico">' ELSE '' END,
    '<meta name="site" content="s"><meta property="site:name" content="n"><meta property="a:b:c" content="x">')),
  '<h1>', CASE WHEN page_id % 5 = 3 THEN '<h1>Other ' ELSE '<h1>' END),
  '<article>', CASE WHEN page_id % 4 = 2
    THEN '<article><div class="author-box">From Ana Lopez and Kim Lee</div>' ELSE '<article>' END),
  '</article>', concat(
    CASE WHEN page_id % 2 = 0 THEN '<a rel="tag" href="/tag/x">x</a><a rel="tag" href="/t/y">y</a>'
         ELSE '<a href="/topic/z">z</a>' END,
    CASE WHEN page_id % 3 = 0 THEN '<iframe data-src="https://v.example.org/1"></iframe>' ELSE '' END,
    '</article>')) AS html
FROM (SELECT page_id, url, html,
        regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
        regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h1 FROM {pages}) s
"""


def news_pages(pages: DataFrame) -> DataFrame:
    """The enriched pages (same SQL text as the DuckDB oracle)."""
    return pages.sparkSession.sql(NEWS_PAGES_SQL, pages=pages)


def news_pages_sql(pages_relation: str = "pages") -> str:
    return NEWS_PAGES_SQL.replace("{pages}", pages_relation)


# The enriched pages with a list of links behind the article, again one SQL text for both engines: to the next
# page of the same section (site-relative on every other page), to the next page of the same
# host, and to a page that does not exist. The links are found on narrow rows and joined back by page.
LINKED_PAGES_SQL = """
SELECT p.page_id, p.url, replace(p.html, '</article>', concat('</article><div class="more">',
   CASE WHEN l.in_section IS NULL THEN '' ELSE concat('<a href="', l.in_section, '">next ', cast(p.page_id % 9 AS string), '</a>') END,
   CASE WHEN l.on_host IS NULL THEN '' ELSE concat('<a href="', l.on_host, '">more</a>') END,
   '<a href="', l.segment, '/missing-', cast(p.page_id % 50 AS string), '">old</a></div>')) AS html
FROM {pages} p JOIN (
  SELECT page_id, segment,
         replace(CASE WHEN page_id % 2 = 0 THEN substring(s_next, length(host) + 1) ELSE s_next END, '&', '&amp;') AS in_section,
         replace(lead(url) OVER (PARTITION BY host ORDER BY page_id), '&', '&amp;') AS on_host
  FROM (SELECT page_id, url, host, segment, lead(url) OVER (PARTITION BY host, segment ORDER BY page_id) AS s_next
        FROM (SELECT page_id, url, regexp_extract(url, '^[A-Za-z]+://[^/?#]*', 0) AS host,
                     regexp_extract(url, '^[A-Za-z]+://[^/?#]*(/[^/?#]*)', 1) AS segment FROM {pages}) h) s) l
ON p.page_id = l.page_id
"""


def linked_pages(pages: DataFrame) -> DataFrame:
    """The enriched pages with links between them (same SQL text as the DuckDB oracle)."""
    return pages.sparkSession.sql(LINKED_PAGES_SQL, pages=news_pages(pages))


def linked_pages_sql(pages_relation: str = "pages") -> str:
    return LINKED_PAGES_SQL.replace("{pages}", f"({news_pages_sql(pages_relation)})")


# Pages whose article tag carries character references: decimal, hexadecimal, named with and
# without a semicolon, doubly escaped, unknown, and one in an unquoted value.
REFERENCE_PAGES_SQL = """
SELECT page_id, replace(html, '<article>', concat('<article data-q="', replace(replace(url, '/', '&#47;'), 't', '&#x74;'),
       '&amp;lt;&eacute&amp;copy; &unknown; & &notit;" Data-N=', CAST(page_id AS STRING), '&hellip;&#8364 hidden>')) AS html
FROM {pages}"""


def reference_pages(pages: DataFrame) -> DataFrame:
    """The pages with character references in attributes (same SQL text as the DuckDB oracle)."""
    return pages.sparkSession.sql(REFERENCE_PAGES_SQL, pages=pages)


def reference_pages_sql(pages_relation: str = "pages") -> str:
    return REFERENCE_PAGES_SQL.replace("{pages}", pages_relation)
