"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The entities of the test pages, for the SQL that B1 is compared with;
# ``&amp;`` goes last so an escaped entity such as ``&amp;lt;`` decodes once.
ENTITIES = [
    ("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&copy;", "©"),
    ("&reg;", "®"), ("&middot;", "·"), ("&ndash;", "–"),
    ("&mdash;", "—"), ("&hellip;", "…"), ("&amp;", "&"),
]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def inner_trim(col) -> Column:
    """Collapse whitespace runs (Unicode, as the parser's) to one space, then
    trim."""
    return F.trim(F.regexp_replace(_c(col), WS_CLASS + "+", " "))


def title_filter(col) -> Column:
    """F1's loose comparison form: keep ``[a-zA-Z0-9 ]``, lower-case."""
    return F.lower(F.regexp_replace(_c(col), r"[^a-zA-Z0-9 ]", ""))


# whitespace as Python's str.strip() and re's \s see it, in a form Java and
# RE2 share (their \s differ on the vertical tab and are ASCII only)
WS_CLASS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"

# Byline clean-up patterns.
BYLINE_TAG_RE = r"<[^<]+?>"
BYLINE_LEAD_RE = r"[bB][yY](?::|" + WS_CLASS + r")|[fF]rom(?::|" + WS_CLASS + r")"
# Python's \w is Unicode; this class gives the same tokens in Java and RE2.
BYLINE_SPLIT_RE = r"[^\p{L}\p{N}_'.\-]"
BYLINE_DELIMS = ["and", ",", ""]
BYLINE_DIGIT_RE = r"\p{Nd}"


def byline_names(col) -> Column:
    """names in a byline as ``array<string>``.

    Tags and ``by``/``from`` markers are removed, the rest is split on every
    character outside word characters, apostrophe, hyphen and dot. Walking the
    tokens, a delimiter (``and``, ``,`` or empty) emits the current name if it
    has a token; tokens with a digit are skipped; at the end a name needs two
    tokens. Expressed as one ``aggregate`` fold over the token array.
    """
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(_c(col), BYLINE_TAG_RE, ""),
                                          BYLINE_LEAD_RE, ""),
                         "^" + WS_CLASS + "+|" + WS_CLASS + "+$", "")
    tokens = F.split(s, BYLINE_SPLIT_RE)
    init = F.struct(F.array().cast("array<string>").alias("names"),
                    F.array().cast("array<string>").alias("cur"))

    def step(acc, tok):
        is_delim = tok.isin(*BYLINE_DELIMS)
        emit = is_delim & (F.size(acc["cur"]) > 0)
        names = F.when(emit, F.concat(acc["names"], F.array(F.array_join(acc["cur"], " ")))) \
            .otherwise(acc["names"])
        cur = (F.when(is_delim, F.array().cast("array<string>"))
               .when(tok.rlike(BYLINE_DIGIT_RE), acc["cur"])
               .otherwise(F.concat(acc["cur"], F.array(tok))))
        return F.struct(names.alias("names"), cur.alias("cur"))

    def finish(acc):
        return F.when(F.size(acc["cur"]) >= 2,
                      F.concat(acc["names"], F.array(F.array_join(acc["cur"], " ")))) \
            .otherwise(acc["names"])

    return F.aggregate(tokens, init, step, finish)
