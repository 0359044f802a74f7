"""SQL text fragments for the DuckDB oracle of the registered queries.

The oracle re-derives every checked result from the raw ``pages`` table by
regular expressions, independently of the Spark plan (which goes through the
parsed node table). All patterns are RE2-safe.
"""

from __future__ import annotations

from newsframe.functions.stopwords import ENGLISH
from newsframe.functions.text import (BYLINE_DIGIT_RE, BYLINE_LEAD_RE, BYLINE_SPLIT_RE,
                                     BYLINE_TAG_RE, ENTITIES, WS_CLASS)
from newsframe.operators.tokens import TOKEN_RE
from newsframe.sources import news_pages_sql


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def ent(expr: str) -> str:
    out = expr
    for e, ch in ENTITIES:
        out = f"replace({out}, {q(e)}, {q(ch)})"
    return out


def reference(r: str) -> str:
    """One character reference (a column) decoded: numbers, and the names that the test pages hold."""
    names = " ".join(f"WHEN {q(e)} THEN {q(ch)}" for e, ch in [*ENTITIES, ("&eacute", "é"), ("&notit;", "¬it;")] if "#" not in e)
    return (f"CASE WHEN regexp_matches({r}, '^&#[xX]') THEN chr(CAST('0x' || regexp_extract({r}, '([0-9a-fA-F]+);?$', 1) AS INTEGER)) "
            f"WHEN starts_with({r}, '&#') THEN chr(CAST(regexp_extract({r}, '[0-9]+', 0) AS INTEGER)) "
            f"ELSE CASE {r} {names} ELSE {r} END END")


def squash(expr: str) -> str:
    return f"trim(regexp_replace({expr}, {q(WS_CLASS + '+')}, ' ', 'g'))"


def tfilter(expr: str) -> str:
    return f"lower(regexp_replace({expr}, '[^a-zA-Z0-9 ]', '', 'g'))"


def root_lang(html: str = "html") -> str:
    root = f"regexp_extract({html}, '(?i)<html\\b[^>]*>', 0)"
    return ("lower(regexp_extract(" + root + ", " +
            q(r"""(?i)\slang\s*=\s*["']?([^"'\s>]*)""") + ", 1))")


def byline(expr: str) -> str:
    """F5 in SQL: the token fold written with ``list_reduce``."""
    inner = (f"regexp_replace(regexp_replace({expr}, {q(BYLINE_TAG_RE)}, '', 'g'), "
             f"{q(BYLINE_LEAD_RE)}, '', 'g')")
    cleaned = f"regexp_replace({inner}, {q('^' + WS_CLASS + '+|' + WS_CLASS + '+$')}, '', 'g')"
    toks = f"string_split_regex({cleaned}, {q(BYLINE_SPLIT_RE)})"
    step = ("lambda acc, tok: CASE WHEN tok IN ('and', ',', '') THEN "
            "{'names': CASE WHEN len(acc.cur) > 0 THEN list_append(acc.names, array_to_string(acc.cur, ' ')) "
            "ELSE acc.names END, 'cur': []::VARCHAR[]} "
            f"WHEN regexp_matches(tok, {q(BYLINE_DIGIT_RE)}) THEN acc "
            "ELSE {'names': acc.names, 'cur': list_append(acc.cur, tok)} END")
    init = "{'names': []::VARCHAR[], 'cur': []::VARCHAR[]}"
    r = f"list_reduce({toks}, {step}, {init})"
    return (f"(SELECT CASE WHEN len(r.cur) >= 2 THEN list_append(r.names, array_to_string(r.cur, ' ')) "
            f"ELSE r.names END FROM (SELECT {r} AS r))")


def sw_list() -> str:
    """The English words as literals; the engine's own look-up is not asked."""
    return "[" + ", ".join(q(w) for w in ENGLISH) + "]"


NEWS = news_pages_sql("pages")


def en_news(gate: bool = True) -> str:
    """CTE prefix: ``np`` = enriched pages, ``en`` = those passing the gate
    (all of them with ``gate=False``)."""
    passing = f"WHERE contains({root_lang()}, 'en')" if gate else ""
    return f"WITH np AS ({NEWS}), en AS (SELECT page_id, url, html FROM np {passing})"


TOKENS_CTE = (f"tk AS (SELECT page_id, unnest(generate_series(0, len(toks) - 1)) AS pos, "
              f"unnest(toks) AS token FROM (SELECT page_id, regexp_extract_all(html, {q(TOKEN_RE)}, 0) "
              f"AS toks FROM pages))")

KIND_SQL = ("CASE WHEN starts_with(token, '<!--') THEN 'comment' "
            "WHEN regexp_matches(token, '^<(script|style)') THEN 'raw' "
            "WHEN regexp_matches(token, '^<![A-Za-z]') THEN 'doctype' "
            "WHEN starts_with(token, '</') THEN 'end' "
            "WHEN regexp_matches(token, '^<[A-Za-z]') THEN 'start' ELSE 'text' END")


def count_before(html: str, needle: str, pos_expr: str) -> str:
    """Occurrences of ``needle`` in ``html`` before 1-based ``pos_expr``."""
    pre = f"substring({html}, 1, {pos_expr} - 1)"
    return f"((length({pre}) - length(replace({pre}, {q(needle)}, ''))) // {len(needle)})"


# ----------------------------------------------------------------------
# Field CTEs over the enriched pages (``en``: those passing the gate, or all)
# ----------------------------------------------------------------------

def _attr_sql(tag: str, attr: str) -> str:
    """Double-quoted attribute value of a raw start tag ('' when absent)."""
    return f"regexp_extract({tag}, {q(r'\s' + attr + r'="([^"]*)"')}, 1)"


def _has_attr_sql(tag: str, attr: str) -> str:
    return f"regexp_matches({tag}, {q(r'\s' + attr + '=\"')})"


def field_ctes(gate: bool = True) -> str:
    from newsframe.operators.fields import AUTHOR_ATTRS, AUTHOR_VALUES, DATE_PROBES
    sw = sw_list()
    art = "regexp_extract(html, '<article>([\\s\\S]*?)</article>', 1)"
    ctes = [en_news(gate)[len("WITH "):]]
    # head metas / links with their 1-based index
    ctes.append("mt AS (SELECT page_id, unnest(generate_series(1, len(ms))) AS k, unnest(ms) AS tag "
                "FROM (SELECT page_id, regexp_extract_all(html, '<meta [^>]*>', 0) AS ms FROM en))")
    ctes.append("lt AS (SELECT page_id, len(ls) AS n, unnest(generate_series(1, len(ls))) AS k, unnest(ls) AS tag "
                "FROM (SELECT page_id, regexp_extract_all(html, '<link [^>]*>', 0) AS ls FROM en))")
    # F1-F3
    t = squash(ent("regexp_extract(html, '<title>([^<]*)</title>', 1)"))
    h = squash(ent("regexp_extract(html, '<h1>([^<]*)</h1>', 1)"))
    ogp = "regexp_extract(html, '<meta property=\"og:title\" content=\"([^\"]*)\"', 1)"
    ogn = "regexp_extract(html, '<meta name=\"og:title\" content=\"([^\"]*)\"', 1)"
    has_ogp = "contains(html, '<meta property=\"og:title\" content=')"
    has_ogn = "contains(html, '<meta name=\"og:title\" content=')"
    ctes.append(f"""tt AS (SELECT page_id, {t} AS t, {h} AS h,
        CASE WHEN {has_ogp} THEN {ent(ogp)} WHEN {has_ogn} THEN {ent(ogn)} ELSE '' END AS g,
        CASE WHEN {has_ogp} THEN {q('//meta[@property="og:title"]/@content')}
             WHEN {has_ogn} THEN {q('//meta[@name="og:title"]/@content')} END AS og_path,
        contains(html, '<h1>') AS has_h1 FROM en)""")
    ctes.append(f"""tr AS (SELECT page_id, t, h, g, og_path, has_h1, {tfilter('t')} AS ft, {tfilter('h')} AS fh,
        {tfilter('g')} AS fg FROM tt)""")
    ctes.append("""f1 AS (SELECT page_id, og_path, g, has_h1, h, CASE
        WHEN h = t THEN '/html/head/title'
        WHEN fh <> '' AND fh = fg THEN '/html/body/article/h1'
        WHEN fh <> '' AND contains(ft, fh) AND fg <> '' AND contains(ft, fg) AND length(h) > length(g)
             THEN '/html/body/article/h1'
        WHEN fg <> '' AND fg <> ft AND starts_with(ft, fg) THEN og_path
        ELSE '/html/head/title' END AS title_path, t FROM tr)""")
    ctes.append("""f1v AS (SELECT page_id, title_path, CASE WHEN title_path = '/html/head/title' THEN t
        WHEN title_path = '/html/body/article/h1' THEN h ELSE g END AS title FROM f1)""")
    # F4/F5 author candidates: head metas and divs of the article
    branches = []
    probe = 0
    for a in AUTHOR_ATTRS:
        for v in AUTHOR_VALUES:
            branches.append(
                f"SELECT page_id, {probe} AS probe, k AS ord, '/html/head/meta[' || CAST(k AS VARCHAR) || ']/@content' AS path, "
                f"{ent(_attr_sql('tag', 'content'))} AS text FROM mt "
                f"WHERE regexp_matches({_attr_sql('tag', a)}, {q('(?i)' + v)}) AND {_has_attr_sql('tag', 'content')}")
            branches.append(
                f"SELECT page_id, {probe} AS probe, 1000 + k AS ord, '/html/body/article/div' || "
                f"CASE WHEN n > 1 THEN '[' || CAST(k AS VARCHAR) || ']' ELSE '' END AS path, "
                f"{squash(ent('dtext'))} AS text FROM dv WHERE regexp_matches({_attr_sql('dtag', a)}, {q('(?i)' + v)})")
            probe += 1
    ctes.append(f"""dv AS (SELECT page_id, len(ds) AS n, unnest(generate_series(1, len(ds))) AS k,
        unnest(ds) AS dtag, unnest(dt) AS dtext FROM (
        SELECT page_id, regexp_extract_all({art}, '<div [^>]*>', 0) AS ds,
               regexp_extract_all({art}, '<div [^>]*>([^<]*)</div>', 1) AS dt FROM en))""")
    ctes.append("ac AS (" + " UNION ALL ".join(branches) + ")")
    ctes.append(f"an AS (SELECT page_id, probe, ord, path, text, {byline('text')} AS names FROM ac WHERE text <> '')")
    ctes.append("""ak AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, lower(text) ORDER BY probe, ord) AS rn
        FROM an WHERE len(names) > 0) WHERE rn = 1)""")
    ctes.append("""anm AS (SELECT page_id, probe, ord, unnest(generate_series(1, len(names))) AS npos, unnest(names) AS name FROM ak)""")
    ctes.append("""anu AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id, name ORDER BY probe, ord, npos) AS rn FROM anm) WHERE rn = 1)""")
    ctes.append("""f4 AS (SELECT p.page_id, p.author_paths, n.authors FROM
        (SELECT page_id, string_agg(path, '|' ORDER BY probe, ord) AS author_paths FROM ak GROUP BY page_id) p
        JOIN (SELECT page_id, string_agg(name, '|' ORDER BY probe, ord, npos) AS authors FROM anu GROUP BY page_id) n
        USING (page_id))""")
    # F8 favicon, F10 canonical
    ctes.append(f"""fav AS (SELECT page_id, path, href FROM (SELECT page_id,
        '/html/head/link' || CASE WHEN n > 1 THEN '[' || CAST(k AS VARCHAR) || ']' ELSE '' END AS path,
        {ent(_attr_sql('tag', 'href'))} AS href,
        row_number() OVER (PARTITION BY page_id ORDER BY k) AS rn FROM lt
        WHERE regexp_matches({_attr_sql('tag', 'rel')}, '(?i)icon')) WHERE rn = 1)""")
    ctes.append(f"""can AS (SELECT page_id, path, href FROM (SELECT page_id,
        '/html/head/link' || CASE WHEN n > 1 THEN '[' || CAST(k AS VARCHAR) || ']' ELSE '' END AS path,
        {ent(_attr_sql('tag', 'href'))} AS href,
        row_number() OVER (PARTITION BY page_id ORDER BY k) AS rn FROM lt
        WHERE regexp_matches({_attr_sql('tag', 'rel')}, '(?i)canonical')) WHERE rn = 1)""")
    ctes.append(f"""ogu AS (SELECT page_id, path, content, href FROM (SELECT page_id,
        '/html/head/meta[' || CAST(k AS VARCHAR) || ']' AS path,
        {ent(_attr_sql('tag', 'content'))} AS content, {ent(_attr_sql('tag', 'href'))} AS href,
        row_number() OVER (PARTITION BY page_id ORDER BY k) AS rn FROM mt
        WHERE {_attr_sql('tag', 'property')} = 'og:url') WHERE rn = 1)""")
    # F9 description / keywords
    for name in ("description", "keywords"):
        ctes.append(f"""m_{name} AS (SELECT page_id, path, content FROM (SELECT page_id,
            '/html/head/meta[' || CAST(k AS VARCHAR) || ']/@content' AS path,
            {ent(_attr_sql('tag', 'content'))} AS content,
            row_number() OVER (PARTITION BY page_id ORDER BY k) AS rn FROM mt
            WHERE {_attr_sql('tag', 'name')} = '{name}') WHERE rn = 1)""")
    # F11 tags: links of the article
    # links of the article; when the last paragraph is left open
    # (``<p><b>text<br>`` + links) the links sit inside that paragraph's <b>
    ctes.append(f"""aa AS (SELECT page_id, len(xs) AS n, unnest(generate_series(1, len(xs))) AS k,
        unnest(xs) AS tag, unnest(ts) AS txt, pre FROM (
        SELECT page_id, regexp_extract_all({art}, '<a [^>]*>', 0) AS xs,
               regexp_extract_all({art}, '<a [^>]*>([^<]*)</a>', 1) AS ts,
               CASE WHEN regexp_matches({art}, '<p><b>[^<]*<br><a ')
                    THEN '/html/body/article/p' || CASE WHEN len(regexp_extract_all({art}, '<p>', 0)) > 1
                         THEN '[' || CAST(len(regexp_extract_all({art}, '<p>', 0)) AS VARCHAR) || ']' ELSE '' END || '/b'
                    ELSE '/html/body/article' END AS pre FROM en))""")
    tier = (f"CASE WHEN {_attr_sql('tag', 'rel')} = 'tag' THEN 1 WHEN contains({_attr_sql('tag', 'href')}, '/tag/') "
            f"OR contains({_attr_sql('tag', 'href')}, '/tags/') OR contains({_attr_sql('tag', 'href')}, '/topic/') "
            f"OR contains({_attr_sql('tag', 'href')}, '?keyword=') THEN 2 END")
    ctes.append(f"""at1 AS (SELECT page_id, {tier} AS tier,
        pre || '/a' || CASE WHEN n > 1 THEN '[' || CAST(k AS VARCHAR) || ']' ELSE '' END AS path,
        {squash(ent('txt'))} AS txt FROM aa)""")
    ctes.append("""f11 AS (SELECT page_id, string_agg(path, '|' ORDER BY path) AS tag_paths,
        string_agg(txt, '|' ORDER BY path) FILTER (WHERE txt <> '') AS tags FROM (
        SELECT *, min(tier) OVER (PARTITION BY page_id) AS mt FROM at1 WHERE tier IS NOT NULL)
        WHERE tier = mt GROUP BY page_id)""")
    # F13 dates
    dbr = []
    for i, (a, v, c) in enumerate(DATE_PROBES):
        dbr.append(f"SELECT page_id, {i} AS probe, k, '/html/head/meta[' || CAST(k AS VARCHAR) || ']/@{c}' AS path, "
                   f"CASE WHEN {_has_attr_sql('tag', c)} THEN {ent(_attr_sql('tag', c))} ELSE '' END AS value "
                   f"FROM mt WHERE regexp_matches({_attr_sql('tag', a)}, {q('(?i)' + v)})")
    ctes.append("dh AS (" + " UNION ALL ".join(dbr) + ")")
    ctes.append("""f13 AS (SELECT page_id, path AS date_path, value AS publish_date FROM (
        SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY probe) AS r2 FROM (
          SELECT *, row_number() OVER (PARTITION BY page_id, probe ORDER BY k) AS r1 FROM dh)
        WHERE r1 = 1 AND value <> '') WHERE r2 = 1)""")
    # F16-F19 blocks: the paragraphs of the article
    ctes.append(f"""pp AS (SELECT page_id, unnest(generate_series(1, len(ps))) AS k, unnest(ps) AS pinner FROM (
        SELECT page_id, regexp_extract_all({art}, '<p>((?:[^<]|<[^p/]|</[^p])*)', 1) AS ps FROM en))""")
    word_n = "CASE WHEN trim({0}) = '' THEN 0 ELSE len(string_split_regex(trim({0}), '\\s+')) END"
    ctes.append(f"""pw AS (SELECT page_id, k, txt,
        len(list_filter(string_split_regex(lower(txt), {q(r"[^\p{L}\p{N}']+")}), lambda w: list_contains({sw}, w))) AS stopwords,
        {word_n.format('txt')} AS words,
        coalesce(list_sum(list_transform(regexp_extract_all(pinner, '<a [^>]*>([^<]*)</a>', 1),
                 lambda a: {word_n.format(squash(ent('a')))})), 0) AS link_words
        FROM (SELECT page_id, k, pinner, {squash(ent("regexp_replace(pinner, '<[^>]*>', ' ', 'g')"))} AS txt FROM pp))""")
    ctes.append("""pk AS (SELECT *, CASE WHEN words = 0 THEN 1.0 ELSE link_words / words END AS link_density FROM pw)""")
    ctes.append("""pk2 AS (SELECT *, stopwords > 2 AND link_density < 0.5 AS kept FROM pk)""")
    ctes.append("""pb AS (SELECT *, coalesce(lag(kept) OVER (PARTITION BY page_id ORDER BY k), false) AS boostable FROM pk2)""")
    ctes.append("""kb AS (SELECT page_id, k, stopwords, boostable,
        CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INTEGER) AS i,
        count(*) OVER (PARTITION BY page_id) AS n,
        sum(CASE WHEN boostable THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS kk
        FROM pb WHERE kept)""")
    ctes.append("""ks AS (SELECT *, CASE WHEN n > 15 AND (n - i) <= n * 0.25 THEN
            CASE WHEN (n * 0.25 - (n - i)) * (n * 0.25 - (n - i)) > 40 THEN 5.0
                 ELSE -((n * 0.25 - (n - i)) * (n * 0.25 - (n - i))) END
          WHEN boostable THEN 50.0 / kk ELSE 0.0 END AS boost FROM kb)""")
    ctes.append("""f17 AS (SELECT page_id, i, boostable, CAST(trunc(stopwords + boost) AS INTEGER) AS upscore FROM ks)""")
    ctes.append("""f18 AS (SELECT page_id, '/html/body/article//text()' AS text_path,
        CAST(sum(upscore) AS DOUBLE) AS top_score FROM f17 GROUP BY page_id)""")
    ctes.append(f"""f19 AS (SELECT page_id, array_to_string(list_transform(list_filter(
        string_split_regex({art}, '<[^>]*>'), lambda x: x <> ''), lambda x: {ent('x')} || chr(10)), '') AS text
        FROM en WHERE page_id IN (SELECT page_id FROM f18))""")
    return "WITH " + ",\n".join(ctes)
