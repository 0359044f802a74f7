"""Property checks: Spark column rules against plain-Python statements of
the same rules, on many seeded random inputs (one Spark job each)."""

import random
import re
from urllib.parse import urlsplit

import duckdb
from pyspark.sql import functions as F

from newsframe.functions import urls as U
from newsframe.functions.text import byline_names, title_filter
from newsframe.plans import sqlparts as S

PIECES = ["By", "by:", "BY ", "From ", "from:", "Foo", "Bar", "Zoë", "O'Neil", "Ann-Marie", "J.", "and",
          ",", " ", "  ", "\t", "\n", " ", "2nd", "x1", "٣", "<b>", "</b>", "<a href='x'>", "Derby ",
          "Smith", "Lee", ";", "|", "&", "_", "Kim", "and,", "fake_text"]


def spec_byline(s: str) -> list[str]:
    """The F5 rule in plain Python."""
    s = re.sub(r"<[^<]+?>", "", s)
    s = re.sub(r"[bB][yY][:\s]|[fF]rom[:\s]", "", s)
    s = s.strip()
    names, cur = [], []
    for tok in (t.strip() for t in re.split(r"[^\w'\-.]", s)):
        if tok in ("and", ",", ""):
            if cur:
                names.append(" ".join(cur))
                cur = []
        elif not re.search(r"\d", tok):
            cur.append(tok)
    if len(cur) >= 2:
        names.append(" ".join(cur))
    return names


def _samples(n=400, seed=7):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 9))) for _ in range(n)]


def test_byline_spark_equals_rule(spark):
    xs = _samples()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, s string")
    got = {r.i: list(r.n) for r in df.select("i", byline_names(F.col("s")).alias("n")).collect()}
    bad = [(xs[i], got[i], spec_byline(xs[i])) for i in range(len(xs)) if got[i] != spec_byline(xs[i])]
    assert not bad, bad[:5]


def test_byline_oracle_sql_equals_rule():
    xs = _samples(seed=11)
    con = duckdb.connect()
    for x in xs:
        got = con.execute(f"SELECT {S.byline('?')}", [x]).fetchone()[0]
        assert list(got) == spec_byline(x), (x, got)


def test_title_filter_equals_rule(spark):
    rnd = random.Random(3)
    alphabet = "abcXYZ 019_-éñ!?.\t"
    xs = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, s string")
    got = {r.i: r.f for r in df.select("i", title_filter(F.col("s")).alias("f")).collect()}
    for i, x in enumerate(xs):
        assert got[i] == re.sub(r"[^a-zA-Z0-9 ]", "", x).lower()


def test_url_parts_equal_urlsplit(spark):
    rnd = random.Random(5)
    hosts = ["foo.bar", "Foo.Bar:8080", "a.b.c", "x-y.example.org:80"]
    paths = ["", "/", "/en", "/en/12", "/a/b/c.html", "/p|q", "/é/ü"]
    tails = ["", "?q=1", "#frag", "?a=b#c"]
    xs = [f"{rnd.choice(['http', 'https'])}://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(tails)}"
          for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "url string")
    rows = df.select("url", U.url_scheme("url").alias("s"), U.url_netloc("url").alias("n"),
                     U.url_path("url").alias("p")).collect()
    for r in rows:
        sp = urlsplit(r.url)
        assert (r.s, r.n, r.p) == (sp.scheme, sp.netloc, sp.path), r.url
