"""B1: character references against the standard library's decoder."""

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from newsframe.functions.entities import unescape


def test_unescape_equals_the_standard_decoder(spark):
    rng = random.Random(4)
    names = sorted(html5)
    texts = [None, "", "&", "&&", "a&b", "&;", "&#;", "&#x;", "&amp;lt;", "&amp;amp;lt;", "&#x41;", "&#X41", "&#65", "&eacute", "&eacutes;", "&notit;", "&notin;",
             "&copy=2&reg=3", "x&ampy", "&#0;", "&#13;", "&#x0D;", "&#128;", "&#x9f;", "&#x81;", "&#11;", "&#x7f;", "&#xD800;", "&#xFDD0;", "&#x1FFFE;", "&#x10FFFF;",
             "&#xFEFF;a", "&#x110000;", "&#99999999999999999999999;", "&#x000000000000041;", "&#00065;", "&#128512;&#x1F600;", "&CounterClockwiseContourIntegral;",
             "&" + "a" * 40 + ";", "&amp" * 9, "&lt;b&gt; & &quot;q&quot;", "tail &amp;", "&NotEqualTilde;", "q" * 5000 + "&hellip;" + "z" * 5000, "&#32;&nbsp;", "\n&\n", "&lt\n;", "&é;", "&ltimes;&ltime;"]
    texts += [f"&{n}" for n in names]
    pieces = ["&", "#", "x", ";", "amp", "lt", "eacute", "4", "1", "f", " ", "not", "in", "<", "copy", "é"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    texts += [f"&#{rng.randrange(0x120000)};&#x{rng.randrange(0x120000):x}" for _ in range(500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.out for r in rows.select("i", unescape("text").alias("out")).collect()}
    wrong = [(t, got[i]) for i, t in enumerate(texts) if got[i] != (None if t is None else html.unescape(t))]
    assert not wrong, wrong[:10]


def test_unescape_of_an_expression_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "a&lt;"), (2, None)], "i int, text string")
    out = rows.select("i", unescape(F.concat(F.lit("&amp;"), "text")).alias("out"))
    assert sorted((r.i, r.out) for r in out.collect()) == [(1, "&a<"), (2, None)]
    assert out.filter("i > 5").collect() == []
