"""Multipart credential linking (operator 9).

Base spans are assigned secrets, access identifiers and long hexadecimal strings. Weaker
candidates are parts that alone say little: an account (``user = ...``), a bare token of mixed
characters, an endpoint (an URL's host or a ``host = ...``). They are reported only where complementary parts
meet: an identifier, a secret and an endpoint whose positions lie within ``scope`` code points
of each other in one text; a base access identifier counts as an identifier, a base
assigned secret or hex string as a secret.

The parts meet in an interval join: positions are dealt to cells of ``scope`` code points, a
window to the two cells that it may touch and its possible partners to those that they touch. Parts do
not overlap their own kind, so a cell holds a bounded number of them, and the joins are
semi-joins: whether there is a partner of a role is kept, not the pairs. Only members of
complete triples are reported.

Everything is DataFrame expressions. Defined results: null and empty texts have no spans;
rows are told apart by their place, so null and repeated ids come back each with
their own spans; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsframe.llm.common import materialize, release
from newsframe.llm.native import matches, placed, span_list

VALUE = "A-Za-z0-9+/_.=-"
_KEYWORD = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
# a blank run before the mark and one after it, each tried once
ASSIGN = rf"{_KEYWORD}[\"']?\x20*+[:=]\x20*+[\"']?[{VALUE}]++"
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]++"
KINDS = ["assign", "access", "hex"]

# keywords in either case, also behind an underscore (DB_USER)
ACCOUNT = r"(?<![A-Za-z0-9])(?i:user|username|login|account|client_id|access_key_id|key_id)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9_.@-]{3,}+"
TOKEN = rf"(?<![{VALUE}])[{VALUE}]{{20,}}+"
ENDPOINT = r"(?i:https?|postgres|mysql|mongodb|redis|ftp|ssh)://[A-Za-z0-9._~:@-]{3,}+|(?<![A-Za-z0-9])(?i:host|endpoint|server)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9._-]{3,}+"
WEAK = {"account": ACCOUNT, "weak": TOKEN, "endpoint": ENDPOINT}
ROLE = {"access": "id", "account": "id", "assign": "secret", "hex": "secret", "weak": "secret", "endpoint": "end"}


def secret_matches(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, found): one row per row of ``docs``, its candidate matches as an array."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<struct<kind:string,k:int,gap:int,len:int,value:string,left:string,right:string>>")
    # a hex string of 32 or more is there to be found before shorter runs are counted
    hexes = F.coalesce(F.when(text.rlike("[0-9a-f]{32}"), matches(text, "hex", HEX)), none)
    hexes = F.coalesce(hexes, none)
    found = F.concat(matches(text, "assign", ASSIGN), matches(text, "access", ACCESS), hexes, *[matches(text, k, p) for k, p in WEAK.items()])
    return docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", found.alias("found"))


def _valid():
    kind, value = F.col("kind"), F.col("value")
    secret = F.regexp_extract(value, rf"^{_KEYWORD}[\"']?\x20*[:=]\x20*[\"']?([{VALUE}]+)$", 1)
    return (F.when(kind == "assign", F.length(secret) >= 8).when(kind == "access", F.length(value) >= 16)
            .when(kind == "hex", F.length(value) >= 32)
            .when(kind == "weak", value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")).otherwise(True))


def _cells(frame: DataFrame, scope: int, reach: int) -> DataFrame:
    low, high = F.floor((F.col("start") - reach) / scope), F.floor((F.col("end") + reach) / scope)
    return frame.withColumn("cell", F.explode(F.sequence(low, high)))


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """The parts (rid, kind, role, start, end) that belong to a complete triple: an identifier, a secret and an endpoint, each
    within ``scope`` of the two others.

    Three parts are that close exactly if, from the end x of the one that ends first, the others end at x or later and
    start at x + scope or before. So a part is the first of a triple if its window [x, x + scope] touches parts of
    both other roles, and then all such parts belong to triples with it.
    """
    parts = materialize(parts.filter(F.col("role").isNotNull()), "sec-linkable")
    touched = _cells(parts, scope, 0).select(F.col("rid").alias("orid"), F.col("cell").alias("ocell"), F.col("role").alias("other"),
                                             F.col("start").alias("os"), F.col("end").alias("oe"))
    window = parts.withColumn("cell", F.explode(F.sequence(F.floor(F.col("end") / scope), F.floor((F.col("end") + scope) / scope))))

    def near(role):
        return ((F.col("rid") == F.col("orid")) & (F.col("cell") == F.col("ocell")) & (F.col("oe") >= F.col("end"))
                & (F.col("os") <= F.col("end") + scope) & (F.col("other") == role))
    columns = ["rid", "kind", "role", "start", "end"]
    # a window lies in two cells at most, the part that it looks for in either of them; it must meet both other roles
    met = [window.filter(F.col("role") != role).join(touched, near(role), "left_semi").select(*columns, F.lit(role).alias("seen")) for role in ("id", "secret", "end")]
    seen = met[0].unionByName(met[1]).unionByName(met[2]).groupBy(*columns).agg(F.count_distinct("seen").alias("seen"))
    firsts = materialize(seen.filter("seen = 2").select(*columns), "sec-firsts")
    reach = firsts.select(F.col("rid").alias("frid"), F.col("role").alias("first"), F.col("end").alias("x")) \
        .withColumn("fcell", F.explode(F.sequence(F.floor(F.col("x") / scope), F.floor((F.col("x") + scope) / scope))))
    joined = _cells(parts, scope, 0).join(reach, (F.col("rid") == F.col("frid")) & (F.col("cell") == F.col("fcell")) & (F.col("role") != F.col("first"))
                                          & (F.col("end") >= F.col("x")) & (F.col("start") <= F.col("x") + scope), "left_semi")
    return joined.select(*columns).unionByName(firsts).distinct()


def secret_spans(docs: DataFrame, scope: int = 240) -> tuple[DataFrame, DataFrame]:
    """The rows (rid, doc_id) of ``docs``, and their spans (rid, kind, start, end, base)."""
    found = materialize(secret_matches(docs), "sec-found")
    rows = found.filter(F.size("found") > 0).select("rid", F.explode("found").alias("m")).select("rid", "m.*")
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])
    parts = materialize(placed(rows).filter(_valid()).select("rid", "kind", role[F.col("kind")].alias("role"), "start", "end"), "sec-parts")
    base = parts.filter(F.col("kind").isin(KINDS)).select("rid", "kind", "start", "end", F.lit(True).alias("base"))
    # weak parts that lie inside a base span say nothing new
    solid = _cells(base, scope, 0).select("rid", "cell", F.col("start").alias("bs"), F.col("end").alias("be"))
    weak = _cells(parts.filter(~F.col("kind").isin(KINDS)), scope, 0)
    inside = weak.join(solid, (weak.rid == solid.rid) & (weak.cell == solid.cell) & (weak.start < solid.be) & (solid.bs < weak.end), "left_semi")
    weak = parts.filter(~F.col("kind").isin(KINDS)).join(inside.select("rid", "kind", "start").distinct(), ["rid", "kind", "start"], "left_anti")
    candidates = weak.unionByName(parts.filter(F.col("kind").isin(KINDS)))
    extra = linked(candidates, scope).filter(~F.col("kind").isin(KINDS))
    spans = materialize(base.unionByName(extra.select("rid", "kind", "start", "end", F.lit(False).alias("base"))), "sec-spans")
    ids = materialize(found.select("rid", "doc_id"), "sec-rows")
    release(found, parts)
    return ids, spans


def secret_report(docs: DataFrame, scope: int = 240) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and all spans of every row of ``docs``."""
    rows, spans = secret_spans(docs, scope)
    order = [*KINDS, *WEAK]
    count = lambda k: F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}")
    per = spans.groupBy("rid").agg(*[count(k) for k in KINDS], F.count(F.when(~F.col("base"), 1)).alias("n_linked"),
                                   span_list(KINDS, F.col("base")).alias("b"), span_list(order).alias("spans"))
    zero = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in [*KINDS, "linked"]]
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.join(per, "rid", "left").select("doc_id", *zero[:3], F.sha2(text("b"), 256).alias("base_sha256"), text("spans").alias("spans"), zero[3])
